"""Tables laid out for joins without a shuffle.

Fact and places share buckets by place. As one place may hold a large share of the
fact rows, a place beyond one bucket's fair share is cut into slices: its fact rows
are dealt out over the slices, and its places row is repeated once per slice. Joining
on place and slice then gives each fact row its place exactly once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.operators.sizing import measured_bytes
from reviewtide.session import concurrently

SLICED_KEY = ["gPlusPlaceId", "slice"]
BUCKET_BYTES = 256 << 20
MIN_BUCKETS = 2


def place_slices(fact: DataFrame, buckets: int) -> DataFrame:
    """Places with more than a bucket's fair share of rows, and their slice counts.

    Each of them has more than 1/buckets of all rows, so there are fewer than
    ``buckets`` of them: small enough to broadcast by construction.
    """
    fair_share = max(1, -(-fact.count() // buckets))
    counts = fact.groupBy("gPlusPlaceId").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") > fair_share).select(
        "gPlusPlaceId", F.ceil(F.col("n") / fair_share).cast("int").alias("slices")
    )


def slice_fact(fact: DataFrame, slices: DataFrame) -> DataFrame:
    """Deal rows of hot places out in turn. ``fact`` has to scan a written table.

    The row number of a file scan is the same when a lost task runs again, and it
    differs between equal rows, so copies spread as well.
    """
    dealt = fact.withColumn("_row", F.monotonically_increasing_id())
    turn = F.coalesce(F.pmod("_row", "slices"), F.lit(0)).cast("int")
    return (
        dealt.join(F.broadcast(slices), "gPlusPlaceId", "left")
        .withColumn("slice", turn)
        .drop("_row", "slices")
    )


def slice_places(places: DataFrame, slices: DataFrame) -> DataFrame:
    last = F.coalesce(F.col("slices"), F.lit(1)) - 1
    return (
        places.join(F.broadcast(slices), "gPlusPlaceId", "left")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), last)))
        .drop("slices")
    )


def replace_bucketed(
    df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None
) -> DataFrame:
    """Write a bucketed, sorted table with one file per bucket (below ``path``, if given)."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer = (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table, format="parquet")
    return spark.table(table)


def buckets_for(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """As many buckets as keep one at about ``bucket_bytes``, by the measured size."""
    return max(MIN_BUCKETS, -(-measured_bytes(df) // bucket_bytes))


@dataclass(frozen=True)
class Laid:
    """How a table is laid out."""

    rows: DataFrame
    keys: list[str]
    buckets: int


def plan_layout(star: dict[str, DataFrame], buckets: int | None = None) -> dict[str, Laid]:
    """Each star table with its keys and its number of buckets.

    ``star`` has to come from a written staging table, see :func:`slice_fact`.
    ``reviews`` and ``places`` get the column ``slice``, and share the fact's number of
    buckets, by default one that follows from the fact's size; users and population have
    unique keys, so no bucket of theirs is hot, and numbers by their own sizes.
    """
    shared = buckets or buckets_for(star["reviews"])
    slices = place_slices(star["reviews"], shared)
    return {
        "reviews": Laid(slice_fact(star["reviews"], slices), SLICED_KEY, shared),
        "places": Laid(slice_places(star["places"], slices), SLICED_KEY, shared),
        "users": Laid(star["users"], ["gPlusUserId"], buckets_for(star["users"])),
        "population": Laid(star["population"], ["postcode"], buckets_for(star["population"])),
    }


def write_layout(
    star: dict[str, DataFrame], prefix: str, buckets: int | None = None
) -> dict[str, DataFrame]:
    """Write the star tables in their layout; ``prefix`` is put before each name."""
    plan = plan_layout(star, buckets)
    tables = concurrently(
        star["reviews"].sparkSession,
        *(
            lambda n=n, t=t: replace_bucketed(t.rows, prefix + n, t.keys, t.buckets)
            for n, t in plan.items()
        ),
    )
    return dict(zip(plan, tables))


def without_slices(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables as they are outside the layout: one row per place, no ``slice``."""
    return {
        **tables,
        "reviews": tables["reviews"].drop("slice"),
        "places": tables["places"].filter(F.col("slice") == 0).drop("slice"),
    }


def join_colocated(tables: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with their place, bucket by bucket."""
    return tables["reviews"].join(tables["places"], SLICED_KEY).drop("slice")
