"""Checks as rows: check, table, column, severity, expected, actual, passed."""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.operators.categories import MIN_REVIEWS, has_categories

ERROR = "error"
WARNING = "warning"


class CheckFailed(ValueError):
    """At least one check of severity error did not pass."""


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _check(
    one_row: DataFrame,
    check: str,
    table: str,
    column: str | None,
    expected: str,
    actual: str,
    passed: str,
    severity: str = ERROR,
) -> DataFrame:
    """A report row; the last three before ``severity`` are SQL over ``one_row``."""
    return one_row.selectExpr(
        f"'{check}' AS check",
        f"'{table}' AS table",
        "CAST(NULL AS STRING) AS column" if column is None else f"'{column}' AS column",
        f"'{severity}' AS severity",
        f"CAST({expected} AS BIGINT) AS expected",
        f"CAST({actual} AS BIGINT) AS actual",
        f"{passed} AS passed",
    )


def guard_join_fanout(reviews: DataFrame, places: DataFrame) -> DataFrame:
    """The join must not add rows (error), and a place id should occur once (warning).

    Both sides are counted per place first, so the joined rows are never built and a
    hot place is one row.
    """
    by_place = has_categories(reviews).groupBy("gPlusPlaceId").agg(F.count("*").alias("n"))
    copies = places.groupBy("gPlusPlaceId").agg(F.count("*").alias("copies"))
    sizes = by_place.join(copies, "gPlusPlaceId", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("before"),
        F.coalesce(F.sum(F.col("n") * F.col("copies")), F.lit(0)).alias("after"),
    )
    fanout = _check(
        sizes,
        "join_fanout",
        "lake",
        "gPlusPlaceId",
        "before",
        "after",
        "after <= before",
    )
    return fanout.unionByName(
        check_unique_key(places, "places", "gPlusPlaceId", WARNING)
    )


def guard_filter_effective(counts: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    """Categories before and after the rare filter; equal numbers are worth a warning."""
    kept = F.coalesce(F.col("num_reviews") > min_reviews, F.lit(False))
    sizes = counts.agg(F.count("*").alias("before"), F.count_if(kept).alias("after"))
    return _check(
        sizes,
        "filter_effective",
        "lake",
        "category",
        "before",
        "after",
        "after < before",
        WARNING,
    )


def check_non_empty(df: DataFrame, table: str, check: str = "non_empty") -> DataFrame:
    return check_counted(df.agg(F.count("*").alias("rows")), table, check)


def check_counted(counted: DataFrame, table: str, check: str = "non_empty") -> DataFrame:
    """``counted``: one row, with the number of ``rows`` of a table."""
    return _check(counted, check, table, None, "1", "rows", "rows > 0")


def guard_populated(outputs: dict[str, DataFrame]) -> DataFrame:
    return union_all(check_non_empty(df, name, "populated") for name, df in outputs.items())


def check_unique_key(
    df: DataFrame, table: str, key: str, severity: str = ERROR
) -> DataFrame:
    """Non-null keys must differ. Counted per key first, so a hot key is one row."""
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    sizes = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("keys"), F.count("*").alias("different")
    )
    return _check(
        sizes, "unique_key", table, key, "keys", "different", "keys = different", severity
    )


def check_reference(fact: DataFrame, dimension: DataFrame, table: str, key: str) -> DataFrame:
    """Fact rows whose non-null key the dimension lacks."""
    per_key = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    orphans = per_key.join(dimension.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")
    )
    return _check(orphans, "referential", table, key, "0", "orphans", "orphans = 0")


def _per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` by each of its keys, in one scan: key, value, n.

    Partial aggregation leaves a hot key one row a task. Without keys: one row.
    """
    none = F.struct(F.lit("").alias("key"), F.lit(None).cast("string").alias("value"))
    each = [F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys]
    pairs = df.select(F.explode(F.array(*(each or [none]))).alias("k"))
    return pairs.groupBy("k.key", "k.value").agg(F.count("*").alias("n"))


def _sizes(
    tables: dict[str, DataFrame], keys_of: dict[str, list[str]], references: list[tuple[str, str]], fact: str
) -> DataFrame:
    """Per table and key: rows, keys that are not null, different ones, orphans.

    A table's rows count as copies of its keys; the fact's rows also count as uses of
    the keys of the dimensions it refers to. Both are added up per key value.
    """
    frames = []
    for table, df in tables.items():
        own = F.struct(F.lit(table).alias("table"), F.lit(1).alias("copy"))
        counts_for = F.array(own)
        if table == fact:
            uses = [
                F.when(F.col("key") == k, F.struct(F.lit(t).alias("table"), F.lit(0).alias("copy")))
                for t, k in references
            ]
            counts_for = F.array_compact(F.array(own, *uses))
        counts = _per_key(df, keys_of[table]).withColumn("to", F.explode(counts_for))
        copy = F.col("to.copy") == 1
        frames.append(
            counts.select(
                "to.table",
                "key",
                "value",
                F.when(copy, F.col("n")).otherwise(0).alias("copies"),
                F.when(copy, 0).otherwise(F.col("n")).alias("uses"),
            )
        )
    values = union_all(frames).groupBy("table", "key", "value").agg(
        F.sum("copies").alias("copies"), F.sum("uses").alias("uses")
    )
    known = F.col("value").isNotNull()
    return values.groupBy("table", "key").agg(
        F.sum("copies").alias("rows"),
        F.sum(F.when(known, F.col("copies")).otherwise(0)).alias("keys"),
        F.count_if(known & (F.col("copies") > 0)).alias("different"),
        F.sum(F.when(known & (F.col("copies") == 0), F.col("uses")).otherwise(0)).alias("orphans"),
    )


def run_checks(
    tables: dict[str, DataFrame],
    keys: Iterable[tuple[str, str]] = (),
    references: Iterable[tuple[str, str]] = (),
    fact: str = "reviews",
) -> DataFrame:
    """All checks on written tables, as one report. Each table is scanned once."""
    keys, references = list(keys), list(references)
    keys_of = {
        t: sorted(
            {k for name, k in (*keys, *references) if name == t}
            | ({k for _, k in references} if t == fact else set())
        )
        for t in tables
    }
    specs = [("non_empty", t, None, (keys_of[t] or [""])[0]) for t in tables]
    specs += [("unique_key", t, k, k) for t, k in keys]
    specs += [("referential", t, k, k) for t, k in references]
    spark = next(iter(tables.values())).sparkSession
    wanted = spark.createDataFrame(specs, "check string, table string, column string, key string")
    found = wanted.join(_sizes(tables, keys_of, references, fact), ["table", "key"], "left")
    rows, each, different, orphans = (
        F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("rows", "keys", "different", "orphans")
    )

    def by_check(non_empty, unique_key, referential):
        is_ = F.col("check")
        return F.when(is_ == "non_empty", non_empty).when(is_ == "unique_key", unique_key).otherwise(referential)

    return found.select(
        "check",
        "table",
        "column",
        F.lit(ERROR).alias("severity"),
        by_check(F.lit(1), each, F.lit(0)).cast("bigint").alias("expected"),
        by_check(rows, different, orphans).alias("actual"),
        by_check(rows > 0, each == different, orphans == 0).alias("passed"),
    )


def enforce(report: DataFrame) -> list:
    """Raise on a failed error, warn on a failed warning, return the rows.

    A report has one row per check, so collecting it is bounded by the code that
    builds it.
    """
    rows = report.collect()
    failed = [row for row in rows if not row.passed]
    for row in failed:
        if row.severity == WARNING:
            warnings.warn(f"check did not pass: {row.asDict()}", stacklevel=2)
    errors = [row.asDict() for row in failed if row.severity == ERROR]
    if errors:
        raise CheckFailed(f"checks failed: {errors}")
    return rows
