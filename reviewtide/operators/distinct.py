"""Exact distinct counts that add up over batches.

A dictionary gives each value a number, once; a batch's values are kept as bitmaps of these
numbers, per group. Bitmaps of several batches are united by Spark's bitmap aggregates, so the
distinct count over all of them needs neither their rows nor their values. A batch reads the
dictionary and its own rows, and writes its bitmaps and the numbers it has added.

Numbers are given within parts that a hash deals the values to, so no task numbers all of
them; a part's numbers are dense, which keeps the bitmaps few: one has 32,768 numbers. Null
values count in no group, as in SQL; null is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PARTS = 16
PART_NUMBERS = 1 << 40  # that a part may give
DICTIONARY = "value string, id bigint"


def _part(value: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(parts))


def new_ids(values: DataFrame, known: DataFrame, parts: int = PARTS) -> DataFrame:
    """Numbers (value, id) of the values, a string column ``value``, that ``known`` lacks.

    ``known`` holds the numbers given so far, with the same ``parts``.
    """
    fresh = values.filter("value IS NOT NULL").select("value").distinct()
    fresh = fresh.join(known.select("value"), "value", "left_anti")
    part = _part(F.col("value"), parts).alias("part")
    given = known.groupBy(F.expr(f"id div {PART_NUMBERS}").alias("part")).agg(
        F.max(F.col("id") % PART_NUMBERS).alias("last")
    )
    turn = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    number = F.coalesce(F.col("last") + 1, F.lit(0)) + F.col("turn") - 1
    return (
        fresh.select("value", part)
        .withColumn("turn", turn)
        .join(F.broadcast(given), "part", "left")  # a row a part
        .select("value", (F.col("part") * PART_NUMBERS + number).alias("id"))
    )


def bitmaps(rows: DataFrame, ids: DataFrame, *groups: str) -> DataFrame:
    """Per group and ``bucket`` of numbers the bitmap of those that occur. ``rows``: the groups and
    ``value``."""
    numbered = rows.filter("value IS NOT NULL").select(*groups, "value").distinct().join(ids, "value")
    bucket = F.bitmap_bucket_number("id").alias("bucket")
    return numbered.groupBy(*groups, bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")
    )


def distinct_counts(kept: DataFrame, *groups: str) -> DataFrame:
    """Per group the number of different values, from the bitmaps of any number of batches.

    Of the groups the bitmaps have, fewer may be asked for.
    """
    united = kept.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias("num_values"))
