"""Staging and star tables, and the questions the star is meant for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.operators.categories import filter_category_like
from reviewtide.operators.layout import plan_layout, replace_bucketed
from reviewtide.operators.star import build_star, register_table, replace_table
from reviewtide.schemas import STAGING, conform
from reviewtide.session import Workspace, concurrently
from reviewtide.sources.writers import project_staging


def build_staging(lake: DataFrame, category: str) -> DataFrame:
    return filter_category_like(project_staging(lake), category)


def load_staging(projected: DataFrame, category: str, table: str) -> DataFrame:
    """Load the projected lake into a fresh staging table, by column name.

    Unwanted categories are left out while loading instead of deleted afterwards.
    """
    return replace_table(filter_category_like(conform(projected, STAGING), category), table)


@dataclass(frozen=True)
class StarTable:
    """A written star table that no catalog names yet."""

    rows: DataFrame
    path: str
    keys: list[str]
    buckets: int | None


def write_star(
    ws: Workspace, staging: DataFrame, folder: str, scale: int = 0, buckets: int | str | None = None
) -> dict[str, StarTable]:
    """Write the star tables of a written staging table below ``folder``.

    With ``buckets`` (a number, or "auto" for one by size) they are laid out for joins
    without a shuffle. Until they are registered, only the workspace names them.
    """
    star = build_star(staging, scale)
    if buckets is None:
        plan = {name: (df, [], None) for name, df in star.items()}
    else:
        laid = plan_layout(star, None if buckets == "auto" else int(buckets))
        plan = {name: (t.rows, t.keys, t.buckets) for name, t in laid.items()}

    def write(name: str, df: DataFrame, keys: list[str], n: int | None) -> StarTable:
        table, path = ws.table_name(ws.fresh(name)), f"{folder}/{name}"
        if n is None:
            return StarTable(replace_table(df, table, path), path, keys, n)
        return StarTable(replace_bucketed(df, table, keys, n, path), path, keys, n)

    tables = concurrently(ws.spark, *(lambda a=(n, *p): write(*a) for n, p in plan.items()))
    return dict(zip(plan, tables))


def register_layout(
    spark: SparkSession, tables: dict[str, StarTable], database: str
) -> dict[str, DataFrame]:
    """Make the written tables those of ``database``, which is created where missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return {
        name: register_table(spark, f"{database}.{name}", t.rows, t.path, t.keys, t.buckets)
        for name, t in tables.items()
    }


def rating_by_daypart(star: dict[str, DataFrame]) -> DataFrame:
    rating = F.col("rating").cast("double")
    return (
        star["reviews"]
        .groupBy("weekday", "day_night")
        .agg(F.avg(rating).alias("avg_rating"), F.count("*").alias("num_reviews"))
    )


def rating_by_price_state(star: dict[str, DataFrame]) -> DataFrame:
    """Ratings summed per place first, so the join carries one row per place."""
    rating = F.col("rating").cast("double")
    per_place = (
        star["reviews"]
        .groupBy("gPlusPlaceId")
        .agg(F.sum(rating).alias("s"), F.count(rating).alias("c"), F.count("*").alias("n"))
    )
    return (
        per_place.join(star["places"], "gPlusPlaceId")
        .groupBy("price", "state")
        .agg(
            F.try_divide(F.sum("s"), F.sum("c")).alias("avg_rating"),
            F.sum("n").alias("num_reviews"),
        )
    )


def rating_by_population(star: dict[str, DataFrame], step: int = 1000) -> DataFrame:
    """Average rating by population size, in classes of ``step`` people."""
    size_class = (F.floor(F.col("population") / step) * step).cast("bigint")
    rating = F.col("rating").cast("double")
    per_place = (
        star["reviews"]
        .groupBy("gPlusPlaceId")
        .agg(F.sum(rating).alias("s"), F.count(rating).alias("c"), F.count("*").alias("n"))
    )
    return (
        per_place.join(star["places"], "gPlusPlaceId")
        .join(star["population"], "postcode")
        .groupBy(size_class.alias("population_from"))
        .agg(
            F.try_divide(F.sum("s"), F.sum("c")).alias("avg_rating"),
            F.sum("n").alias("num_reviews"),
        )
    )
