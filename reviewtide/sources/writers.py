"""Writers. All overwrite, so a run can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.functions.times import iso_text
from reviewtide.operators.sizing import checked_broadcast
from reviewtide.schemas import STAGING, conform

MAX_RECORDS_PER_FILE = 2_000_000
ROWS_PER_SLICE = 500_000


def write_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """Null fields are left out of the lines."""
    df.write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def category_slices(counts: DataFrame, column: str, rows: int) -> DataFrame:
    """Values with more than ``rows`` rows, and into how many slices they are dealt."""
    return counts.filter(F.col("num_reviews") > rows).select(
        F.col(column).alias("_hot"), F.ceil(F.col("num_reviews") / rows).alias("_slices")
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    counts: DataFrame,
    column: str = "category",
    touched_only: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> None:
    """One folder per value of ``column``; null and '' share the default folder.

    Rows are brought together by value so that a folder gets few files. ``counts``, a
    written table (``column``, num_reviews), tells how many rows there are: a value with
    many is dealt into slices by a hash of its rows, so that one with a third of all rows
    is written by many tasks, and the number of tasks follows from all rows. Adaptive
    execution leaves such a partitioning as it is, and no session setting is changed.

    The value itself stays in the data as ``<column>Value``, as folders do not tell null
    from ''. ``touched_only`` replaces just the folders that occur in ``df``.
    """
    total = counts.agg(F.coalesce(F.sum("num_reviews"), F.lit(0))).first()[0]
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-total // rows_per_slice))
    hot = checked_broadcast(category_slices(counts, column, rows_per_slice))
    turn = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.coalesce("_slices", F.lit(1)))
    (
        df.join(hot, F.col(column).eqNullSafe(F.col("_hot")), "left")
        .withColumn("_slice", turn)
        .drop("_hot", "_slices")
        .repartition(tasks, column, "_slice")
        .drop("_slice")
        .withColumn(f"{column}Value", F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if touched_only else "static")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(column)
        .parquet(path)
    )


def project_staging(lake: DataFrame) -> DataFrame:
    """The 15 staging columns: no review text, the time as ISO text."""
    return conform(lake.withColumn("reviewTime", iso_text(lake["reviewTime"])), STAGING)


def write_projected(lake: DataFrame, path: str) -> None:
    write_parquet(project_staging(lake), path)
