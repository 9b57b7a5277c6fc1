"""Each reviewer's average rating, over all reviews, joined back to every review."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def user_totals(reviews: DataFrame) -> DataFrame:
    """Rating sum and count per user. They add up over batches, averages do not.

    Partial aggregation leaves one row per user and task before the shuffle, so a
    user (or the null user) with a third of all reviews costs one task no more.
    """
    return reviews.groupBy("gPlusUserId").agg(
        F.sum("rating").alias("ratingSum"), F.count("rating").alias("ratingCount")
    )


def merge_totals(totals: DataFrame) -> DataFrame:
    """One row per user from the partial totals of several batches."""
    return totals.groupBy("gPlusUserId").agg(
        F.sum("ratingSum").alias("ratingSum"), F.sum("ratingCount").alias("ratingCount")
    )


def user_averages(totals: DataFrame) -> DataFrame:
    average = F.when(F.col("ratingCount") > 0, F.col("ratingSum") / F.col("ratingCount"))
    return totals.select("gPlusUserId", average.alias("userAvgRating"))


def with_user_average(reviews: DataFrame, averages: DataFrame | None = None) -> DataFrame:
    """Add ``userAvgRating``; null users share one average.

    An aggregate joined back instead of a window: a window would sort all reviews
    with their text by user and put a hot user into one task. This join shuffles too
    when the averages are many, but adaptive execution can split its hot partitions.
    """
    if averages is None:
        averages = user_averages(user_totals(reviews))
    averages = averages.withColumnRenamed("gPlusUserId", "_user")
    same_user = F.col("gPlusUserId").eqNullSafe(F.col("_user"))
    return reviews.join(averages, same_user, "left").drop("_user")
