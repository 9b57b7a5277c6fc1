"""The star schema: three dimensions and one fact table, from staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewtide.schemas import conform, star_fields


def build_star(staging: DataFrame, scale: int = 0) -> dict[str, DataFrame]:
    """Tables by name. With the default scale every decimal is rounded to an integer.

    Dimensions are distinct rows; the fact keeps every staging row.
    """
    fields = star_fields(scale)
    users = staging.select("gPlusUserId", "userAvgRating").distinct()
    places = staging.select("gPlusPlaceId", "name", "price", "state", "postcode").distinct()
    population = staging.select("postcode", "population").distinct()
    return {
        "users": conform(users.withColumnRenamed("userAvgRating", "avgRating"), fields["users"]),
        "places": conform(places, fields["places"]),
        "population": conform(population, fields["population"]),
        "reviews": conform(staging, fields["reviews"]),
    }


def replace_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Drop ``table`` if it exists, write it anew (its files to ``path``), return it."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer = df.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table, format="parquet")
    return spark.table(table)


def register_table(
    spark: SparkSession, table: str, like: DataFrame, path: str, keys: list[str], buckets: int | None
) -> DataFrame:
    """Let ``table`` name the files at ``path``, which are complete. They are not copied."""
    columns = ", ".join(f"`{name}` {type_}" for name, type_ in like.dtypes)
    by = ", ".join(f"`{key}`" for key in keys)
    layout = "" if buckets is None else f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS"
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW":
        spark.sql(f"DROP VIEW {table}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {layout} LOCATION '{path}'")
    return spark.table(table)
