"""Population by postcode and its join to places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.schemas import CENSUS, ZIP

FIVE_DIGITS = "^[0-9]{5}$"


def population_by_zip(population: DataFrame) -> DataFrame:
    """Sum per zip over a string measure; what is not a number counts as null."""
    measure = F.expr(f"try_cast(`{CENSUS}` AS double)")
    return population.groupBy(ZIP).agg(F.sum(measure).alias("population"))


def join_population(places: DataFrame, population: DataFrame) -> DataFrame:
    """Left join on the postcode.

    A postcode is five digits by construction, so only such zips can match. That
    bounds the broadcast side by 100,000 rows whatever the input holds.
    """
    by_zip = population_by_zip(population.filter(F.col(ZIP).rlike(FIVE_DIGITS)))
    return places.join(F.broadcast(by_zip), F.col("postcode") == F.col(ZIP), "left").drop(ZIP)
