"""One query per operator, over whole tables. Each takes (spark, sf_dir)."""

from __future__ import annotations

import atexit
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.checks import fixtures as fx
from reviewtide.functions import places as p
from reviewtide.functions import times as t
from reviewtide.operators import categories as cat
from reviewtide.operators import distinct, layout, quality
from reviewtide.operators.averages import user_averages, user_totals, with_user_average
from reviewtide.operators.population import join_population, population_by_zip
from reviewtide.operators.star import build_star, replace_table
from reviewtide.plans import lake as lk
from reviewtide.plans import rollups
from reviewtide.plans import warehouse as wh
from reviewtide.plans.incremental import append_batch
from reviewtide.plans.prepare import (
    place_features,
    prepare_places,
    prepare_reviews,
    review_features,
)
from reviewtide.plans.run import Warehouse, publish_star, run, star_tables
from reviewtide.plans.store import Store
from reviewtide.schemas import (
    POPULATION_RAW,
    REVIEW_FEATURES,
    REVIEWS,
    STAGING,
    STAR_KEYS,
    STAR_REFERENCES,
    ZIP,
    conform,
    names,
)
from reviewtide.session import Workspace, use_utc
from reviewtide.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

STAGING_CATEGORY = "i"  # the event types click, signup and view contain it
VIEWS = {"audience_sign": "sign", "audience_batch": "batch", "audience_i": "i"}
CHAT_FIELDS = (
    ("role", "string"),
    ("text", "string"),
    ("closed", "boolean"),
    ("x", "string"),
    ("e", "string"),
)

QUERIES: dict[str, Query] = {}

# Intermediates of a query have to live until its lazy result is collected, so all
# queries of an application share one workspace that stays.
_workspaces: dict[str, Workspace] = {}


def workspace_of(spark: SparkSession) -> Workspace:
    app = spark.sparkContext.applicationId
    if app not in _workspaces:
        _workspaces[app] = Workspace(spark)
        atexit.register(_drop_workspace, app)
    return _workspaces[app]


def _drop_workspace(app: str) -> None:
    """At exit, if the application is still running by then."""
    context = SparkContext._active_spark_context
    if context is not None and context.applicationId == app:
        _workspaces.pop(app).drop()


def register(*keys: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(use_utc(spark), sf_dir)

        for key in keys:
            QUERIES[key] = in_utc
        return query

    return add


def listed(categories: str = "categories"):
    """A list column as text, so that engines agree on how to show it."""
    return F.array_join(categories, "|").alias(categories)


def show_lists(df: DataFrame) -> DataFrame:
    return df.select([listed(c) if c == "categories" else c for c in df.columns])


def show_decimals(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for the same reason."""
    return df.select(
        [F.col(c).cast("double").alias(c) if d.startswith("decimal") else c for c, d in df.dtypes]
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(review_features(fx.raw_reviews(spark, sf_dir)), REVIEW_FEATURES)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_places(fx.raw_places(spark, sf_dir), fx.raw_population(spark, sf_dir))


def exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = features(spark, sf_dir)
    averages = user_averages(user_totals(reviews))
    return lk.exploded_lake(reviews, places(spark, sf_dir), averages)


def lake(spark: SparkSession, sf_dir: str, averages: bool = True) -> DataFrame:
    return lk.lake_of(
        workspace_of(spark), features(spark, sf_dir), places(spark, sf_dir), averages=averages
    )


def lake_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    usa = lk.usa_places(places(spark, sf_dir))
    return workspace_of(spark).write(cat.category_counts(features(spark, sf_dir), usa), "counts")


def staging(spark: SparkSession, sf_dir: str, averages: bool = True) -> DataFrame:
    return wh.build_staging(lake(spark, sf_dir, averages), STAGING_CATEGORY)


def written_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ws = workspace_of(spark)
    return ws.write_all(build_star(ws.write(staging(spark, sf_dir), "staging")))


# ---- sources and sinks: write, read back, return what was read


@register("src_text", "sink_text")
def text_round_trip(spark, sf_dir):
    path = workspace_of(spark).path("lines")
    writers.write_text(fx.chat_lines(spark, sf_dir).select("value"), path)
    return readers.read_text(spark, path)


@register("repair_python_json")
def repair(spark, sf_dir):
    return readers.repair_python_json(fx.chat_lines(spark, sf_dir))


@register("src_json_dropmalformed")
def dirty_json(spark, sf_dir):
    path = workspace_of(spark).path("dirty")
    writers.write_text(fx.dirty_chat_lines(spark, sf_dir), path)
    return readers.read_dirty_json(spark, path, CHAT_FIELDS)


@register("src_json_rejects")
def json_rejects(spark, sf_dir):
    """The lines that are no records, as they were read, and why; the records beside them are
    counted in the same rows' form."""
    ws = workspace_of(spark)
    path = ws.path("dirty")
    writers.write_text(fx.dirty_chat_lines(spark, sf_dir), path)
    whole = ws.write(readers.read_dirty_json_whole(spark, path, CHAT_FIELDS), "whole")
    counted = readers.records_of(whole).agg(F.count("*").cast("string"))
    return readers.rejects_of(whole).unionByName(
        counted.toDF("reject_line").withColumn("reject_reason", F.lit("records"))
    )


@register("json_malformed_count")
def malformed_count(spark, sf_dir):
    lines = readers.repair_python_json(fx.dirty_chat_lines(spark, sf_dir))
    return readers.count_malformed(readers.parse_json_lines(lines, CHAT_FIELDS))


@register("src_json_staged", "sink_json")
def json_round_trip(spark, sf_dir):
    path = workspace_of(spark).path("prepped")
    writers.write_json(conform(prepare_reviews(fx.raw_reviews(spark, sf_dir)), REVIEWS), path)
    return show_lists(readers.read_json(spark, path, REVIEWS))


@register("src_csv_header")
def csv_round_trip(spark, sf_dir):
    path = workspace_of(spark).path("population")
    fx.raw_population(spark, sf_dir).write.option("header", True).csv(path)
    return readers.read_csv(spark, path, POPULATION_RAW)


@register("src_parquet", "sink_parquet_projected")
def projected_round_trip(spark, sf_dir):
    path = workspace_of(spark).path("temp_lake")
    writers.write_projected(lake(spark, sf_dir), path)
    return readers.read_parquet(spark, path, STAGING)


@register("src_parquet_partitioned", "sink_parquet_partitioned")
def partitioned_round_trip(spark, sf_dir):
    path = workspace_of(spark).path("reviews_lake")
    writers.write_partitioned(lake(spark, sf_dir), path, lake_counts(spark, sf_dir))
    return readers.read_lake(spark, path)


# ---- places


@register("drop_columns")
def drop_columns(spark, sf_dir):
    return show_lists(review_features(fx.raw_reviews(spark, sf_dir)))


@register("drop_columns_places")
def drop_place_columns(spark, sf_dir):
    return place_features(fx.raw_places(spark, sf_dir))


@register("derive_state_postcode")
def state_postcode(spark, sf_dir):
    address = F.col("address")
    return fx.raw_places(spark, sf_dir).select(
        "gPlusPlaceId", p.state(address).alias("state"), p.postcode(address).alias("postcode")
    )


@register("derive_country")
def country(spark, sf_dir):
    state = p.state(F.col("address"))
    return fx.raw_places(spark, sf_dir).select("gPlusPlaceId", p.country(state).alias("country"))


@register("address_to_string")
def address(spark, sf_dir):
    text = p.address_text(F.col("address"))
    return fx.raw_places(spark, sf_dir).select("gPlusPlaceId", text.alias("address"))


@register("price_level")
def price(spark, sf_dir):
    level = p.price_level(F.col("price"))
    return fx.raw_places(spark, sf_dir).select("gPlusPlaceId", level.alias("price"))


@register("population_by_zip")
def population(spark, sf_dir):
    return population_by_zip(fx.raw_population(spark, sf_dir)).withColumnRenamed(ZIP, "zip")


@register("join_population")
def population_join(spark, sf_dir):
    ids = place_features(fx.raw_places(spark, sf_dir)).select("gPlusPlaceId", "postcode")
    return join_population(ids, fx.raw_population(spark, sf_dir))


@register("places_prepped")
def places_prepped(spark, sf_dir):
    return places(spark, sf_dir)


@register("filter_usa")
def filter_usa(spark, sf_dir):
    return lk.usa_places(places(spark, sf_dir))


# ---- reviews


@register("epoch_to_timestamp")
def epoch_to_timestamp(spark, sf_dir):
    time = t.review_time(F.col("unixReviewTime"))
    return fx.raw_reviews(spark, sf_dir).select("event_id", time.alias("reviewTime"))


@register("derive_weekday")
def weekday(spark, sf_dir):
    time = t.review_time(F.col("unixReviewTime"))
    return fx.raw_reviews(spark, sf_dir).select("event_id", t.weekday(time).alias("weekday"))


@register("derive_day_night")
def day_night(spark, sf_dir):
    time = t.review_time(F.col("unixReviewTime"))
    return fx.raw_reviews(spark, sf_dir).select("event_id", t.day_night(time).alias("day_night"))


@register("user_avg_rating")
def user_avg_rating(spark, sf_dir):
    raw = fx.raw_reviews(spark, sf_dir).select("event_id", "gPlusUserId", "rating")
    return with_user_average(raw)


@register("reviews_prepped")
def reviews_prepped(spark, sf_dir):
    return show_lists(prepare_reviews(fx.raw_reviews(spark, sf_dir)))


@register("filter_has_categories")
def filter_has_categories(spark, sf_dir):
    raw = fx.raw_reviews(spark, sf_dir).select("event_id", "categories")
    return show_lists(cat.has_categories(raw))


# ---- lake


@register("join_reviews_places")
def join_reviews_places(spark, sf_dir):
    reviews = fx.raw_reviews(spark, sf_dir).select(
        "event_id", "gPlusPlaceId", "rating", "categories"
    )
    return show_lists(lk.join_reviews_places(reviews, places(spark, sf_dir)))


@register("explode_categories")
def explode_categories(spark, sf_dir):
    raw = fx.raw_reviews(spark, sf_dir).select("event_id", "categories")
    return cat.explode_categories(raw)


@register("category_counts")
def category_counts(spark, sf_dir):
    usa = lk.usa_places(places(spark, sf_dir))
    return cat.category_counts(features(spark, sf_dir), usa)


@register("drop_rare_categories")
def drop_rare_categories(spark, sf_dir):
    raw = fx.raw_reviews(spark, sf_dir).select("event_id", "categories")
    return cat.drop_rare_categories(cat.explode_categories(raw), workspace_of(spark))


@register("count_distinct_categories")
def count_distinct_categories(spark, sf_dir):
    """From the counts by category, which need no joined rows."""
    usa = lk.usa_places(places(spark, sf_dir))
    return cat.count_distinct_categories(cat.category_counts(features(spark, sf_dir), usa))


@register("lake")
def whole_lake(spark, sf_dir):
    return lake(spark, sf_dir)


@register("entry")
def entry(spark, sf_dir):
    return lk.rating_by_category(lake(spark, sf_dir, averages=False))


@register("guard_join_fanout")
def guard_join_fanout(spark, sf_dir):
    usa = lk.usa_places(places(spark, sf_dir))
    return quality.guard_join_fanout(features(spark, sf_dir), usa)


@register("guard_filter_effective")
def guard_filter_effective(spark, sf_dir):
    usa = lk.usa_places(places(spark, sf_dir))
    return quality.guard_filter_effective(cat.category_counts(features(spark, sf_dir), usa))


@register("guard_populated")
def guard_populated(spark, sf_dir):
    ws = workspace_of(spark)
    built, counts = lake(spark, sf_dir), lake_counts(spark, sf_dir)
    partitioned, projected = ws.path("reviews_lake"), ws.path("temp_lake")
    writers.write_partitioned(built, partitioned, counts)
    writers.write_projected(readers.read_lake(spark, partitioned), projected)
    return quality.guard_populated(
        {
            "reviews_lake": readers.read_lake(spark, partitioned),
            "temp_lake": readers.read_parquet(spark, projected, STAGING),
        }
    )


# ---- warehouse


@register("filter_category_like")
def filter_category_like(spark, sf_dir):
    return cat.filter_category_like(lake(spark, sf_dir), STAGING_CATEGORY)


@register("load_staging")
def load_staging(spark, sf_dir):
    ws = workspace_of(spark)
    path = ws.path("temp_lake")
    writers.write_projected(lake(spark, sf_dir), path)
    projected = readers.read_parquet(spark, path)
    return wh.load_staging(projected, STAGING_CATEGORY, ws.table_name(ws.fresh("staging")))


def _star_table(name: str) -> None:
    @register(f"star_{name}")
    def star_table(spark, sf_dir):
        ws = workspace_of(spark)
        table = build_star(staging(spark, sf_dir, averages=name == "users"))[name]
        return show_decimals(replace_table(table, ws.table_name(ws.fresh(name))))


for _name in ("users", "places", "population", "reviews"):
    _star_table(_name)


@register("table_replace")
def table_replace(spark, sf_dir):
    ws = workspace_of(spark)
    users = build_star(ws.write(staging(spark, sf_dir), "staging"))["users"]
    table = ws.table_name(ws.fresh("users"))
    replace_table(users, table)
    return show_decimals(replace_table(users, table))


@register("layout_bucketed_join")
def layout_bucketed_join(spark, sf_dir):
    ws = workspace_of(spark)
    star = build_star(ws.write(staging(spark, sf_dir), "staging"))
    tables = layout.write_layout(star, ws.table_name(ws.fresh("layout")) + "_")
    return show_decimals(layout.join_colocated(tables))


@register("dq_non_empty")
def dq_non_empty(spark, sf_dir):
    return quality.run_checks(written_star(spark, sf_dir))


@register("dq_unique_key")
def dq_unique_key(spark, sf_dir):
    star = written_star(spark, sf_dir)
    return quality.union_all(
        quality.check_unique_key(star[name], name, key) for name, key in STAR_KEYS
    )


@register("dq_referential")
def dq_referential(spark, sf_dir):
    star = written_star(spark, sf_dir)
    return quality.union_all(
        quality.check_reference(star["reviews"], star[name], name, key)
        for name, key in STAR_REFERENCES
    )


@register("dq_report")
def dq_report(spark, sf_dir):
    return quality.run_checks(written_star(spark, sf_dir), STAR_KEYS, STAR_REFERENCES)


# ---- whole runs and what the star is for


@register("main_run")
def main_run(spark, sf_dir):
    """Dirty files in, everything published: rows and sums of the lake and of each star
    table, and how many records were parsed."""
    ws = workspace_of(spark)
    raw = {name: ws.path(f"raw_{name}") for name in ("places", "reviews", "population")}
    writers.write_text(fx.place_lines(spark, sf_dir), raw["places"])
    writers.write_text(fx.review_lines(spark, sf_dir), raw["reviews"])
    fx.raw_population(spark, sf_dir).write.option("header", True).csv(raw["population"])
    published = run(
        spark,
        raw["places"],
        raw["reviews"],
        raw["population"],
        ws.path("out"),
        Warehouse(STAGING_CATEGORY, ws.name),
    )
    measured = {"lake": (published.store.lake(), "rating")} | {
        name: (published.tables[name], column)
        for name, column in (
            ("users", "avgRating"), ("places", "price"), ("population", "population"), ("reviews", "rating"),
        )
    }
    sums = [
        df.agg(F.count("*").alias("num_rows"), F.sum(F.col(column).cast("double")).alias("total"))
        .select(F.lit(name).alias("table"), "num_rows", "total")
        for name, (df, column) in measured.items()
    ]
    parsed = [(f"parsed {name}", n["records"], 0.0) for name, n in published.parsed.items()]
    return quality.union_all(
        [*sums, spark.createDataFrame(parsed, "table string, num_rows bigint, total double")]
    )


def batches(spark, sf_dir):
    """The raw reviews in three batches by date."""
    raw = fx.raw_reviews(spark, sf_dir)
    time = t.review_time(F.col("unixReviewTime"))
    return (
        raw.filter(time < "2024-01-16"),
        raw.filter((time >= "2024-01-16") & (time < "2024-01-24")),
        raw.filter(time >= "2024-01-24"),
    )


def spoiled(raw):
    """A batch as it should not have been: half of its rows, other ratings, one category more."""
    category = F.array(F.lit("spoiled"))
    return raw.filter(F.col("rating") > 2).withColumns(
        {"rating": F.col("rating") + 1, "categories": F.concat("categories", category)}
    )


@register("ext_incremental_append")
def incremental_append(spark, sf_dir):
    """Reviews in three batches, the last of them corrected; their lake has to be that of a
    full run."""
    ws = workspace_of(spark)
    early, middle, late = batches(spark, sf_dir)
    store = Store(spark, ws.path("store"))
    store.write_places(places(spark, sf_dir))
    store.write_batch(review_features(early), "initial", first=True)
    store.write_lake(ws)
    # An attempt that died before the lake had its rows; the next batch catches it up.
    store.write_batch(review_features(middle), "second", first=False)
    append_batch(ws, store, spoiled(late), "third")
    return append_batch(ws, store, late, "third")


@register("ext_star_changes")
def star_by_changes(spark, sf_dir):
    """Rows of all star tables, by table, after two changes of the lake: a batch with a wrong
    one beside it, which is withdrawn together with the next batch."""
    ws = workspace_of(spark)
    early, middle, late = batches(spark, sf_dir)
    store, warehouse = Store(spark, ws.path("store")), Warehouse(STAGING_CATEGORY, ws.name, parts=4)
    store.write_places(places(spark, sf_dir))
    store.write_batch(review_features(early), "initial", first=True)
    store.write_lake(ws)
    publish_star(ws, store, warehouse, anew=True)
    store.write_batch(review_features(spoiled(late)), "wrong", first=False)
    append_batch(ws, store, middle, "second")
    publish_star(ws, store, warehouse)
    store.withdraw("wrong")
    append_batch(ws, store, late, "third")
    publish_star(ws, store, warehouse)
    star = star_tables(spark, store.root)

    def row(table, *columns):
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
        return star[table].select(F.lit(table).alias("table"), F.concat_ws("|", *texts).alias("line"))

    return quality.union_all([
        row("users", "gPlusUserId", "avgRating"),
        row("places", "gPlusPlaceId", "price", "state", "postcode"),
        row("population", "postcode", "population"),
        row("reviews", "gPlusPlaceId", "gPlusUserId", "category", "rating", "weekday", "day_night"),
    ])


@register("ext_rollup_rating")
def rollup_rating(spark, sf_dir):
    """The question of ``entry``, answered from sums that three batches have kept up to date."""
    ws = workspace_of(spark)
    early, middle, late = batches(spark, sf_dir)
    store = Store(spark, ws.path("store"))
    store.write_places(places(spark, sf_dir))
    store.write_batch(review_features(early), "initial", first=True)
    store.write_lake(ws)
    for name, raw in (("second", middle), ("third", late)):
        rollups.refresh(ws, store)
        append_batch(ws, store, raw, name)
    rollups.refresh(ws, store)
    return rollups.rating_by_category(rollups.rollup(store))


@register("ext_distinct_users")
def distinct_users(spark, sf_dir):
    """Different reviewers of each category, over three batches of which each has been read once."""
    ws = workspace_of(spark)
    known = spark.createDataFrame([], distinct.DICTIONARY)
    kept = []
    for raw in batches(spark, sf_dir):
        exploded = cat.explode_categories(cat.has_categories(raw).select("gPlusUserId", "categories"))
        rows = ws.write(exploded.withColumnRenamed("gPlusUserId", "value"), "rows")
        added = ws.write(distinct.new_ids(rows, known), "ids")
        known = known.unionByName(added)
        kept.append(ws.write(distinct.bitmaps(rows, known, "category"), "bitmaps"))
    return distinct.distinct_counts(quality.union_all(kept), "category")


@register("ext_category_views")
def category_views(spark, sf_dir):
    lk.category_views(workspace_of(spark).write(lake(spark, sf_dir), "lake"), VIEWS)
    return quality.union_all(
        spark.table(view)
        .groupBy("category")
        .agg(F.count("*").alias("num_reviews"), F.avg("rating").alias("avg_rating"))
        .select(F.lit(view).alias("view_name"), "category", "num_reviews", "avg_rating")
        for view in VIEWS
    )


@register("ext_rating_by_daypart")
def rating_by_daypart(spark, sf_dir):
    return wh.rating_by_daypart(written_star(spark, sf_dir))


@register("ext_rating_by_price_state")
def rating_by_price_state(spark, sf_dir):
    return wh.rating_by_price_state(written_star(spark, sf_dir))


@register("ext_rating_by_population")
def rating_by_population(spark, sf_dir):
    return wh.rating_by_population(written_star(spark, sf_dir))
