"""From raw records to prepared places and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.functions import places as p
from reviewtide.functions import times as t
from reviewtide.operators.averages import with_user_average
from reviewtide.operators.population import join_population
from reviewtide.schemas import PLACES_UNUSED, REVIEWS_UNUSED


def place_features(raw: DataFrame) -> DataFrame:
    """State, postcode, country, address text and price level of each place."""
    return (
        raw.drop(*PLACES_UNUSED)
        .withColumns({"state": p.state(F.col("address")), "postcode": p.postcode(F.col("address"))})
        .withColumns(
            {
                "country": p.country(F.col("state")),
                "address": p.address_text(F.col("address")),
                "price": p.price_level(F.col("price")),
            }
        )
    )


def prepare_places(raw: DataFrame, population: DataFrame) -> DataFrame:
    return join_population(place_features(raw), population)


def review_features(raw: DataFrame) -> DataFrame:
    """Time, weekday and part of day of each review."""
    return (
        raw.drop(*REVIEWS_UNUSED)
        .withColumn("reviewTime", t.review_time(F.col("unixReviewTime")))
        .withColumns(
            {"weekday": t.weekday(F.col("reviewTime")), "day_night": t.day_night(F.col("reviewTime"))}
        )
        .drop("unixReviewTime")
    )


def prepare_reviews(raw: DataFrame) -> DataFrame:
    return with_user_average(review_features(raw))
