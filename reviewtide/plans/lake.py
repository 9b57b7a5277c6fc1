"""The lake: US reviews with their place, one row per category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.functions.places import USA
from reviewtide.operators.averages import user_averages, user_totals, with_user_average
from reviewtide.operators.categories import (
    MIN_REVIEWS,
    category_counts,
    explode_categories,
    filter_category_like,
    has_categories,
    keep_categories,
    kept_categories,
)
from reviewtide.schemas import LAKE, names
from reviewtide.session import Workspace


def usa_places(places: DataFrame) -> DataFrame:
    return places.filter(F.col("country") == USA)


def join_reviews_places(reviews: DataFrame, places: DataFrame) -> DataFrame:
    return has_categories(reviews).join(usa_places(places), "gPlusPlaceId", "inner")


def _with_average(reviews: DataFrame, averages: DataFrame | None) -> DataFrame:
    if averages is None:
        return reviews.withColumn("userAvgRating", F.lit(None).cast("double"))
    return with_user_average(reviews, averages)


def exploded_lake(
    reviews: DataFrame, places: DataFrame, averages: DataFrame | None
) -> DataFrame:
    """The lake before the rare filter.

    Averages come from all reviews, so they can be joined after the places have
    removed the reviews that are not needed. Rows multiply last, after both shuffles.
    Without ``averages`` they are null: for questions that do not ask for them.
    """
    joined = _with_average(join_reviews_places(reviews, places), averages)
    return explode_categories(joined).select(names(LAKE))


def build_lake(
    reviews: DataFrame,
    places: DataFrame,
    averages: DataFrame | None,
    counts: DataFrame,
    min_reviews: int = MIN_REVIEWS,
) -> DataFrame:
    """``averages`` and ``counts`` are written tables, see :func:`lake_of`."""
    exploded = exploded_lake(reviews, places, averages)
    return keep_categories(exploded, kept_categories(counts, min_reviews))


def build_part(
    reviews: DataFrame, places: DataFrame, averages: DataFrame, categories: DataFrame
) -> DataFrame:
    """The lake rows of ``categories`` (a written table of kept ones, each once).

    Reviews are narrowed to the places that have rows of these categories, which takes keys
    alone, before their text is joined; the category lists explode after both joins, so the
    text of a review moves once for each, however many of its categories are touched.
    """
    rows = has_categories(reviews)
    keys = explode_categories(rows.select("gPlusPlaceId", "categories"))
    places_of = keep_categories(keys, categories).select("gPlusPlaceId").distinct()
    narrowed = rows.join(places_of, "gPlusPlaceId", "left_semi")
    return keep_categories(exploded_lake(narrowed, places, averages), categories, "inner")


def lake_of(
    ws: Workspace,
    reviews: DataFrame,
    places: DataFrame,
    min_reviews: int = MIN_REVIEWS,
    averages: bool = True,
) -> DataFrame:
    """The lake of prepared places and reviews that have no average yet."""
    tables = {"counts": category_counts(reviews, usa_places(places))}
    if averages:
        tables["averages"] = user_averages(user_totals(reviews))
    written = ws.write_all(tables)
    return build_lake(reviews, places, written.get("averages"), written["counts"], min_reviews)


def rating_by_category(lake: DataFrame) -> DataFrame:
    """Average rating and row count by category and part of day."""
    return lake.groupBy("category", "day_night").agg(
        F.avg("rating").alias("avg_rating"), F.count("*").alias("num_reviews")
    )


def category_views(lake: DataFrame, views: dict[str, str]) -> None:
    """One temporary view per audience: view name to the text its categories contain."""
    for view, contains in views.items():
        filter_category_like(lake, contains).createOrReplaceTempView(view)
