"""Inputs of the engine's shape, derived by Spark from the given tables.

Every row of ``events``, ``customer`` and ``conversations`` is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.schemas import CENSUS, ZIP


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews from ``events``; some without user, known place or categories, some with a
    null or an empty category. There are as many users as a tenth of the reviews."""
    key = F.col("event_id")
    batch = F.concat(F.lit("batch"), F.floor(key / 16).cast("string"))
    categories = (
        F.when(key % 13 == 0, F.lit(None))
        .when(key % 17 == 0, F.array().cast("array<string>"))
        .when(key % 19 == 0, F.array(F.col("event_type"), F.lit("")))
        .when(key % 23 == 0, F.array(F.col("event_type"), F.lit(None).cast("string")))
        .otherwise(F.array("event_type", batch))
    )
    place = F.when(key % 11 == 0, "-1").otherwise(F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        place.alias("gPlusPlaceId"),
        F.when(key % 89 != 0, F.expr("event_id div 10").cast("string")).alias("gPlusUserId"),
        (F.floor("value").cast("bigint") % 6).cast("double").alias("rating"),
        F.col("props").alias("reviewText"),
        categories.alias("categories"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("unixReviewTime"),
        F.concat(F.lit("reviewer "), key.cast("string")).alias("reviewerName"),
    )


def raw_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places from ``customer``; more than half of them in the US, some without address,
    and some of those abroad twice."""
    key = F.col("c_custkey")
    town = F.when(F.col("c_nationkey") < 8, "Town, CA ").otherwise("Town, NY ")
    zipped = F.concat(town, F.lpad((key % 100).cast("string"), 5, "0"))
    abroad = F.concat(F.lit("Town "), F.col("c_nationkey").cast("string"))
    last = F.when(F.col("c_nationkey") < 15, zipped).otherwise(abroad)
    address = (
        F.when(key % 29 == 0, F.lit(None))
        .when(key % 31 == 0, F.array().cast("array<string>"))
        .otherwise(F.array("c_name", F.concat(F.lit("No. "), key.cast("string")), last))
    )
    twice = (F.col("c_nationkey") >= 15) & (key % 5 == 0)
    copies = F.explode(F.when(twice, F.array(F.lit(""), F.lit(" again"))).otherwise(F.array(F.lit(""))))
    return table(spark, sf_dir, "customer").withColumn("copy", copies).select(
        key.cast("string").alias("gPlusPlaceId"),
        F.concat("c_name", "copy").alias("name"),
        F.when(key % 7 != 0, F.repeat(F.lit("$"), (key % 5 + 1).cast("int"))).alias("price"),
        address.alias("address"),
        F.concat(F.lit("+1 "), key.cast("string")).alias("phone"),
        F.lit(False).alias("closed"),
    )


def raw_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several text counts per zip, from ``customer``; zips 80 to 99 are missing."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.lpad((key % 80).cast("string"), 5, "0").alias(ZIP), key.cast("string").alias(CENSUS)
    )


def _python_text(text: Column, quote: str) -> Column:
    """Text as a Python unicode literal in ``quote``; null as None."""
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), (quote, "\\" + quote)):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    literal = F.concat(F.lit("u" + quote), text, F.lit(quote))
    return F.coalesce(literal, F.lit("None"))


def _python_list(items: Column) -> Column:
    literals = F.transform(items, lambda item: _python_text(item, "'"))
    return F.coalesce(
        F.concat(F.lit("["), F.array_join(literals, ", "), F.lit("]")), F.lit("None")
    )


def _python_dict(**values: Column) -> Column:
    parts = []
    for i, (name, value) in enumerate(values.items()):
        parts += [F.lit(("{" if i == 0 else ", ") + f"u'{name}': "), value]
    return F.concat(*parts, F.lit("}"))


def chat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Python dict literal per row of ``conversations``, and its keys."""
    line = _python_dict(
        role=_python_text(F.col("role"), "'"),
        text=_python_text(F.col("text"), '"'),
        closed=F.lit("False"),
        x=F.lit("None"),
        e=F.lit("u'caf\\xe9'"),
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", line.alias("value"))


def dirty_chat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, every fifth turn cut off in the middle."""
    cut = F.substring(F.col("value"), F.lit(1), F.floor(F.length("value") / 2).cast("int"))
    line = F.when(F.col("turn") % 5 == 4, cut).otherwise(F.col("value"))
    return chat_lines(spark, sf_dir).select(line.alias("value"))


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews as lines of a dirty file."""
    raw = raw_reviews(spark, sf_dir)
    line = _python_dict(
        gPlusPlaceId=_python_text(F.col("gPlusPlaceId"), "'"),
        gPlusUserId=_python_text(F.col("gPlusUserId"), "'"),
        reviewerName=_python_text(F.col("reviewerName"), "'"),
        rating=F.col("rating").cast("string"),
        reviewText=_python_text(F.col("reviewText"), "'"),
        categories=_python_list(F.col("categories")),
        unixReviewTime=F.col("unixReviewTime").cast("string"),
    )
    return raw.select(line.alias("value"))


def place_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw places as lines of a dirty file."""
    raw = raw_places(spark, sf_dir)
    line = _python_dict(
        gPlusPlaceId=_python_text(F.col("gPlusPlaceId"), "'"),
        name=_python_text(F.col("name"), "'"),
        price=_python_text(F.col("price"), "'"),
        address=_python_list(F.col("address")),
        phone=_python_text(F.col("phone"), "'"),
        closed=F.lit("False"),
        hours=F.lit("None"),
    )
    return raw.select(line.alias("value"))
