"""What several operators of this subpackage need."""

from __future__ import annotations

import atexit
import os
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.session import Workspace

# The characters that count as white space in texts.
SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

ARROW_BATCH_BYTES = 4 << 20

_workspaces: dict[str, Workspace] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def visible_to_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver found it, if it is there, and
    bound their Arrow batches in bytes, not only in rows.

    On a cluster the package comes with ``--py-files``, as usual. A batch still has one whole
    text at least.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


def workspace_of(spark: SparkSession) -> Workspace:
    """Tables that have to live until a lazy result is collected: gone at exit."""
    app = visible_to_workers(spark).sparkContext.applicationId
    if app not in _workspaces:
        _workspaces[app] = Workspace(spark)
        atexit.register(_drop, app)
    return _workspaces[app]


def _drop(app: str) -> None:
    context = SparkContext._active_spark_context
    if context is not None and context.applicationId == app:
        _workspaces.pop(app).drop()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda word: word != "")


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda s, x: s + x)


def free(docs: DataFrame, *names: str) -> list[str]:
    """``names``, changed where ``docs`` has columns of that name."""
    taken = {c.lower() for c in docs.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def packed(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns beside ``needed`` in one, safe from others of their names,
    and the columns that bring ``docs`` back."""
    (rest,) = free(docs, "_rest")
    others = [c for c in docs.columns if c not in needed]
    if not others:
        return docs, [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(*needed, F.struct(*(F.col(f"`{c}`") for c in others)).alias(rest))
    back = [F.col(c) if c in needed else F.col(f"`{rest}`.`{c}`").alias(c) for c in docs.columns]
    return whole, back
