"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 16
_ITEM_BYTES = {"int": 4, "bigint": 8, "double": 8}


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, from one aggregate over ``df``. Meant for written tables."""
    width = F.lit(_ROW_OVERHEAD * len(df.columns)).cast("bigint")
    for name, type_ in df.dtypes:
        if type_ in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
        elif type_.startswith("array<"):
            item = type_.removeprefix("array<").removesuffix(">")
            fields = 1 + item.count(",")
            each = _ITEM_BYTES.get(item, _ROW_OVERHEAD * (1 + fields))
            width = width + each * F.coalesce(F.size(F.col(f"`{name}`")), F.lit(0))
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it measures at most ``limit`` bytes.

    Beyond that ``df`` comes back as it is: the join then shuffles, and adaptive
    execution splits the partitions of a hot key.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df
