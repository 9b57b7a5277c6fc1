"""Flattening the category lists and dropping rare or unwanted categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.operators.sizing import checked_broadcast
from reviewtide.session import Workspace

MIN_REVIEWS = 10  # fixed value: a kept category has more rows than this


def has_categories(reviews: DataFrame) -> DataFrame:
    return reviews.filter(F.col("categories").isNotNull())


def explode_categories(reviews: DataFrame) -> DataFrame:
    """One row per list element; null and empty lists give none."""
    return reviews.select(
        [F.explode(c).alias("category") if c == "categories" else c for c in reviews.columns]
    )


def category_totals(exploded: DataFrame) -> DataFrame:
    return exploded.groupBy("category").agg(F.count("*").alias("num_reviews"))


def category_counts(reviews: DataFrame, places: DataFrame) -> DataFrame:
    """Lake rows per category, without building the joined rows.

    Reviews shrink to one row per place and category before they are shuffled, and
    places to one row per id. A repeated place id multiplies, as in the join.
    """
    pairs = (
        explode_categories(reviews.select("gPlusPlaceId", "categories"))
        .groupBy("gPlusPlaceId", "category")
        .agg(F.count("*").alias("n"))
    )
    copies = places.groupBy("gPlusPlaceId").agg(F.count("*").alias("copies"))
    return (
        pairs.join(copies, "gPlusPlaceId")
        .groupBy("category")
        .agg(F.sum(F.col("n") * F.col("copies")).alias("num_reviews"))
    )


def merge_counts(counts: DataFrame) -> DataFrame:
    """One row per category from the counts of several batches."""
    return counts.groupBy("category").agg(F.sum("num_reviews").alias("num_reviews"))


def kept_categories(counts: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    return counts.filter(F.col("num_reviews") > min_reviews).select("category")


def keep_categories(
    exploded: DataFrame, kept: DataFrame, how: str = "left_semi"
) -> DataFrame:
    """Rows whose category is in ``kept``; a null category matches a null one.

    ``kept`` has to be a written table: it is measured, then broadcast if small. ``how`` may
    be ``inner`` if no category is in it twice.
    """
    kept = checked_broadcast(kept.withColumnRenamed("category", "_kept"))
    same = F.col("category").eqNullSafe(F.col("_kept"))
    return exploded.join(kept, same, how).drop("_kept")


def drop_rare_categories(
    exploded: DataFrame, ws: Workspace, min_reviews: int = MIN_REVIEWS
) -> DataFrame:
    """Keep the categories with more than ``min_reviews`` rows.

    Counted by an aggregate and joined back, so no task ever sorts a whole category.
    """
    counts = ws.write(category_totals(exploded), "category_counts")
    return keep_categories(exploded, kept_categories(counts, min_reviews))


def filter_category_like(df: DataFrame, contains: str) -> DataFrame:
    """Keep categories that contain the text, and rows without a category.

    Case matters; ``%`` and ``_`` in the text are wildcards.
    """
    category = F.col("category")
    return df.filter(category.isNull() | category.like(f"%{contains}%"))


def count_distinct_categories(df: DataFrame) -> DataFrame:
    """One row; rows without a category count as one category."""
    return df.select("category").distinct().agg(F.count("*").alias("num_categories"))
