"""Column names and types of every data set, as (name, type) pairs in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Fields = Sequence[tuple[str, str]]

# Fixed values, down to LAKE: column names and types of the files that are read and written.
PLACES_RAW: Fields = (
    ("gPlusPlaceId", "string"),
    ("name", "string"),
    ("price", "string"),
    ("address", "array<string>"),
)
# Parsed nowhere and dropped where present.
PLACES_UNUSED = ("phone", "closed", "gps", "hours")

REVIEWS_RAW: Fields = (
    ("gPlusPlaceId", "string"),
    ("gPlusUserId", "string"),
    ("rating", "double"),
    ("reviewText", "string"),
    ("categories", "array<string>"),
    ("unixReviewTime", "bigint"),
)
REVIEWS_UNUSED = ("reviewerName",)

ZIP = "Zip Code ZCTA"
CENSUS = "2010 Census Population"
POPULATION_RAW: Fields = ((ZIP, "string"), (CENSUS, "string"))

PLACES: Fields = (
    ("gPlusPlaceId", "string"),
    ("name", "string"),
    ("price", "int"),
    ("address", "string"),
    ("state", "string"),
    ("postcode", "string"),
    ("country", "string"),
    ("population", "double"),
)

# Reviews with their time features, before the reviewer's average is joined.
REVIEW_FEATURES: Fields = (
    ("gPlusPlaceId", "string"),
    ("gPlusUserId", "string"),
    ("rating", "double"),
    ("reviewText", "string"),
    ("categories", "array<string>"),
    ("reviewTime", "timestamp"),
    ("weekday", "string"),
    ("day_night", "string"),
)
REVIEWS: Fields = (*REVIEW_FEATURES, ("userAvgRating", "double"))

LAKE: Fields = (
    ("gPlusPlaceId", "string"),
    ("day_night", "string"),
    ("gPlusUserId", "string"),
    ("rating", "double"),
    ("reviewTime", "timestamp"),
    ("reviewText", "string"),
    ("userAvgRating", "double"),
    ("weekday", "string"),
    ("address", "string"),
    ("country", "string"),
    ("name", "string"),
    ("population", "double"),
    ("postcode", "string"),
    ("price", "int"),
    ("state", "string"),
    ("category", "string"),
)

STAGING: Fields = (
    ("gPlusPlaceId", "string"),
    ("category", "string"),
    ("day_night", "string"),
    ("gPlusUserId", "string"),
    ("rating", "double"),
    ("reviewTime", "string"),
    ("userAvgRating", "double"),
    ("weekday", "string"),
    ("address", "string"),
    ("country", "string"),
    ("name", "string"),
    ("population", "double"),
    ("postcode", "string"),
    ("price", "int"),
    ("state", "string"),
)

USER_TOTALS: Fields = (
    ("gPlusUserId", "string"),
    ("ratingSum", "double"),
    ("ratingCount", "bigint"),
)
CATEGORY_COUNTS: Fields = (("category", "string"), ("num_reviews", "bigint"))


def star_fields(scale: int = 0) -> dict[str, Fields]:
    """The four star tables; ``scale`` is that of every decimal measure."""
    decimal = f"decimal(18,{scale})"
    return {
        "users": (("gPlusUserId", "string"), ("avgRating", decimal)),
        "places": (
            ("gPlusPlaceId", "string"),
            ("name", "string"),
            ("price", "int"),
            ("state", "string"),
            ("postcode", "string"),
        ),
        "population": (("postcode", "string"), ("population", decimal)),
        "reviews": (
            ("gPlusPlaceId", "string"),
            ("gPlusUserId", "string"),
            ("category", "string"),
            ("rating", decimal),
            ("weekday", "string"),
            ("day_night", "string"),
        ),
    }


# Tables and their unique key columns, and the references of the fact table.
#: A line that is not a record, and why.
REJECT: Fields = (("reject_line", "string"), ("reject_reason", "string"))

STAR_KEYS = (("places", "gPlusPlaceId"), ("population", "postcode"), ("users", "gPlusUserId"))
STAR_REFERENCES = (("places", "gPlusPlaceId"), ("users", "gPlusUserId"))


def names(fields: Fields) -> list[str]:
    return [name for name, _ in fields]


def ddl(fields: Fields) -> str:
    return ", ".join(f"`{name}` {type_}" for name, type_ in fields)


def conform(df: DataFrame, fields: Fields) -> DataFrame:
    """Select ``fields`` by name and cast each to its declared type.

    A missing column is an analysis error, so a wrong order cannot slip through.
    """
    return df.select([F.col(f"`{name}`").cast(type_).alias(name) for name, type_ in fields])
