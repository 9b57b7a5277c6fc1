"""Whole plans: shapes of the physical plans, skew, runs and increments."""

import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from core_helpers import plan_of
from reviewtide.checks import fixtures as fx
from reviewtide.checks import queries as q
from reviewtide.operators import quality
from reviewtide.operators.averages import user_averages, user_totals, with_user_average
from reviewtide.plans import lake as lk
from reviewtide.plans.incremental import append_batch
from reviewtide.plans.prepare import review_features
from reviewtide.plans.run import Warehouse, run, run_increment
from reviewtide.plans.store import Store
from reviewtide.schemas import PLACES, REVIEW_FEATURES, conform, ddl
from reviewtide.sources import readers, writers


def same_rows(left, right):
    right = right.select(left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def folders(lake):
    """As the lake reads back: null and '' share a folder."""
    return lake.withColumn("category", F.nullif("category", F.lit("")))


@pytest.fixture(scope="module")
def raw_paths(spark, tmp_path_factory, sf):
    root = tmp_path_factory.mktemp("raw")
    paths = [str(root / name) for name in ("places", "reviews", "population")]
    writers.write_text(fx.place_lines(spark, sf), paths[0])
    writers.write_text(fx.review_lines(spark, sf), paths[1])
    fx.raw_population(spark, sf).write.option("header", True).csv(paths[2])
    return paths


def test_no_python_worker_in_any_plan(spark, sf):
    for name in ("lake", "places_prepped", "reviews_prepped", "star_users", "src_json_dropmalformed"):
        assert "Python" not in plan_of(q.QUERIES[name](spark, sf))


def test_each_line_is_parsed_once(spark, raw_paths):
    from reviewtide.schemas import REVIEWS_RAW

    plan = plan_of(readers.read_dirty_json(spark, raw_paths[1], REVIEWS_RAW))
    assert plan.count("from_json") == 1
    assert plan.count("replace(value") == 1


def test_population_is_broadcast_even_without_automatic_broadcasts(spark, sf, conf):
    conf(autoBroadcastJoinThreshold="-1")
    plan = plan_of(q.places(spark, sf))
    assert "BroadcastHashJoin" in plan and "RLIKE" in plan


def test_large_sides_are_shuffled_not_broadcast(spark, sf, conf):
    conf(autoBroadcastJoinThreshold="-1")
    plan = plan_of(q.lake(spark, sf))
    assert plan.count("SortMergeJoin") == 2  # places, averages
    assert plan.count("BroadcastHashJoin") == 2  # population, kept categories
    assert "Window" not in plan


def test_partition_filters_reach_the_scan(spark, sf, tmp_path):
    from reviewtide.operators.categories import filter_category_like

    path = str(tmp_path / "lake")
    writers.write_partitioned(q.lake(spark, sf), path, q.lake_counts(spark, sf))
    lake = readers.read_lake(spark, path)
    for df in (lake.filter("category = 'view'"), filter_category_like(lake, "i")):
        plan = plan_of(df.select("gPlusPlaceId"))
        assert "PartitionFilters: [(" in plan or "PartitionFilters: [is" in plan
        assert "reviewText" not in plan.split("ReadSchema")[1]


def test_projected_lake_never_reads_the_text(spark, sf, ws):
    store = Store(spark, ws.path("store"))
    store.write_places(q.places(spark, sf))
    store.write_batch(review_features(fx.raw_reviews(spark, sf)), "b", first=True)
    plan = plan_of(writers.project_staging(store.build_lake(ws)))
    assert "reviewText" not in plan


def hot_reviews(spark):
    """Half of the users null, a third of the places one place, many equal rows."""
    return conform(
        spark.range(60_000, numPartitions=8).select(
            F.expr("if(id % 3 = 0, 'hot', 'p' || id % 5000)").alias("gPlusPlaceId"),
            F.expr("if(id % 2 = 0, null, 'u' || id % 7000)").alias("gPlusUserId"),
            (F.col("id") % 6).cast("double").alias("rating"),
            F.lit("x" * 200).alias("reviewText"),
            F.array(F.lit("a"), F.expr("'c' || id % 40")).alias("categories"),
            F.lit(None).alias("reviewTime"),
            F.lit(None).alias("weekday"),
            F.lit(None).alias("day_night"),
        ),
        REVIEW_FEATURES,
    )


def hot_places(spark):
    ids = spark.range(5000).select(F.expr("'p' || id")).union(spark.range(1).select(F.lit("hot")))
    row = [F.lit("x").cast(t).alias(n) if t == "string" else F.lit(None).cast(t).alias(n) for n, t in PLACES[1:]]
    return ids.toDF("gPlusPlaceId").select("gPlusPlaceId", *row).withColumn("country", F.lit("USA"))


def test_hot_keys_are_split(spark, ws, conf):
    reviews, places = ws.write(hot_reviews(spark), "r"), ws.write(hot_places(spark), "p")
    expected = (
        reviews.withColumn("a", F.explode("categories"))
        .groupBy("a", "gPlusPlaceId")
        .count()
        .collect()
    )
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="16KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__coalescePartitions__initialPartitionNum="32",
    )
    lake = lk.lake_of(ws, reviews, places)
    got = lake.groupBy("category", "gPlusPlaceId").count()
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in expected}
    assert plan_of(got).count("SortMergeJoin(skew=true)") >= 2
    averages = with_user_average(reviews)
    assert {r[0] for r in averages.filter("gPlusUserId is null").select("userAvgRating").distinct().collect()} == {2.0}


def test_run_publishes_everything(spark, raw_paths, ws, sf):
    out = ws.path("out")
    for _ in range(2):  # a run can be repeated
        published = run(spark, *raw_paths, out, Warehouse("i", ws.name))
    assert same_rows(published.store.lake(), folders(q.lake(spark, sf)))
    assert {name: df.count() for name, df in published.tables.items()} == {
        "users": 88, "places": 6, "population": 6, "reviews": 202,
    }
    assert all(r.passed for r in published.report)
    assert {r.check for r in published.report} == {
        "join_fanout", "unique_key", "filter_effective", "populated", "non_empty", "referential",
    }
    assert published.parsed == {
        "places": {"records": fx.raw_places(spark, sf).count(), "dropped": 0},
        "reviews": {"records": 1000, "dropped": 0},
    }
    assert not spark.catalog.tableExists(f"{ws.name}.staging")


def test_run_with_layout(spark, raw_paths, ws, sf):
    published = run(spark, *raw_paths, ws.path("out"), Warehouse("i", ws.name, scale=2, buckets=4))
    assert all(r.passed for r in published.report)
    fact = q.build_star(q.staging(spark, sf), scale=2)["reviews"]
    assert same_rows(published.tables["reviews"].drop("slice"), fact)
    assert published.tables["users"].dtypes[1] == ("avgRating", "decimal(18,2)")


def test_run_stops_before_publishing_on_fanout(spark, raw_paths, ws):
    doubled = ws.path("places")
    lines = spark.read.text(raw_paths[0])
    writers.write_text(lines.union(lines).union(lines), doubled)
    out = ws.path("out")
    with pytest.raises(ValueError, match="join_fanout"):
        run(spark, doubled, *raw_paths[1:], out, Warehouse("i", ws.name))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(Store(spark, out).lake_path)


def test_token_repair_gives_the_same_lake_on_clean_text(spark, raw_paths, ws, sf):
    published = run(spark, *raw_paths, ws.path("out"), Warehouse("i", ws.name), repair="token")
    assert same_rows(published.store.lake(), folders(q.lake(spark, sf)))


def files_of(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def review(place, user, rating, categories):
    return (place, user, rating, "t", categories, 0)


def test_increment_equals_full_run(spark, ws):
    raw = (
        "gPlusPlaceId string, gPlusUserId string, rating double, reviewText string, "
        "categories array<string>, unixReviewTime bigint"
    )
    place = dict(name="n", price=1, address="a", state="CA", postcode="00501", country="USA", population=1.0)
    places = spark.createDataFrame(
        [("p1", *place.values()), ("p2", *place.values()), ("fr", "n", 1, "a", None, None, None, None)],
        ddl(PLACES),
    )
    first = spark.createDataFrame(
        [review("p1", "u", 4.0, ["a"])] * 11
        + [review("p1", "v", 4.0, ["b"])] * 11
        + [review("p2", "w", 4.0, ["c"])] * 10
        + [review("p2", None, 1.0, [None])] * 11
        + [review("p2", "x", 1.0, [""])] * 11,
        raw,
    )
    second = spark.createDataFrame(
        [review("fr", "u", 1.0, ["z"]), review("p1", "w", 5.0, ["c"]), review("fr", None, 3.0, None)], raw
    )
    one, full = Store(spark, ws.path("one")), Store(spark, ws.path("full"))
    for store in (one, full):
        store.write_places(places)
    one.write_batch(review_features(first), "initial", first=True)
    one.write_lake(ws)
    assert {r.category for r in one.lake().collect()} == {"a", "b", None}
    untouched = files_of(one.lake().filter("category = 'b'"))

    full.write_batch(review_features(first.union(second)), "initial", first=True)
    full.write_lake(ws)
    for _ in range(2):  # repeating a batch changes nothing
        lake = append_batch(ws, one, second, "2")
        assert same_rows(lake, full.lake())
    assert {r.category for r in lake.collect()} == {"a", "b", "c", None}
    assert files_of(one.lake().filter("category = 'b'")) == untouched
    assert {r.userAvgRating for r in lake.filter("category = 'a'").collect()} == {45 / 12}


def test_run_and_increment_equal_one_run(spark, raw_paths, ws, sf):
    lines = spark.read.text(raw_paths[1])
    day = F.col("value").contains("7',")
    parts = [ws.path("reviews"), ws.path("reviews")]
    writers.write_text(lines.filter(~day), parts[0])
    broken = spark.createDataFrame([("{u'cut",)], "value string")
    writers.write_text(lines.filter(day).union(broken), parts[1])
    out, warehouse = ws.path("out"), Warehouse("i", ws.name)
    run(spark, raw_paths[0], parts[0], raw_paths[2], out, warehouse)
    published = run_increment(spark, parts[1], "day 2", out, warehouse)
    assert published.parsed["reviews"]["dropped"] == 1
    assert same_rows(published.store.lake(), folders(q.lake(spark, sf)))
    star = q.build_star(q.staging(spark, sf))
    for name, table in published.tables.items():
        assert same_rows(table, star[name])


def test_plans_without_averages_join_no_users(spark, sf, conf):
    conf(autoBroadcastJoinThreshold="-1")
    for name in ("entry", "count_distinct_categories"):
        assert "hashpartitioning(gPlusUserId" not in plan_of(q.QUERIES[name](spark, sf))
    staging = q.staging(spark, sf, averages=False)
    assert "hashpartitioning(gPlusUserId" not in plan_of(staging)


def test_increment_narrows_reviews_before_it_joins_them(spark, sf, ws, conf):
    """Below every shuffle that carries text, the filter on touched categories."""
    conf(autoBroadcastJoinThreshold="-1")
    store = Store(spark, ws.path("store"))
    store.write_places(q.places(spark, sf))
    store.write_batch(review_features(fx.raw_reviews(spark, sf)), "initial", first=True)
    averages = ws.write(store.averages(), "averages")
    touched = ws.write(spark.createDataFrame([("click",)], "category string"), "touched")
    part = lk.build_part(store.reviews(), store.places(), averages, touched)
    plan = plan_of(part)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line or "BroadcastHashJoin" in line]
    assert "LeftSemi" in joins[-1] or "LeftSemi" in joins[-2]
    assert plan.index("SortMergeJoin") < plan.index("LeftSemi")
    expected = q.lake(spark, sf).filter("category = 'click'")
    assert same_rows(part, expected)


def test_shuffles_of_a_run_have_the_sized_number(spark, raw_paths, ws, monkeypatch):
    """Every exchange of the lake write, both joins included."""
    from reviewtide.session import Sizing, sized_for

    store = Store(spark, ws.path("store"))
    store.write_places(q.places(spark, "/root/testdata/sf0.001"))
    store.write_batch(review_features(fx.raw_reviews(spark, "/root/testdata/sf0.001")), "initial", first=True)
    with sized_for(spark, 37 * 1000, Sizing(shuffle_bytes=1000)):
        counts = ws.write(store.category_counts(), "counts")
        plan = plan_of(store.build_lake(ws).repartition(37, "category"))
        assert counts.count()
    numbers = set(re.findall(r"hashpartitioning\([^)]*?, (\d+)\)", plan))
    assert numbers <= {"37"}


REVIEW = (
    "gPlusPlaceId string, gPlusUserId string, rating double, reviewText string, "
    "categories array<string>, unixReviewTime bigint"
)


@pytest.fixture
def started(spark, ws, sf):
    """A store with a first batch, the rest of the reviews in two parts, and the whole lake."""
    raw = fx.raw_reviews(spark, sf)
    first, second, third = (raw.filter(F.col("event_id") % 3 == k) for k in range(3))
    store = Store(spark, ws.path("store"))
    store.write_places(q.places(spark, sf))
    store.write_batch(review_features(first), "initial", first=True)
    store.write_lake(ws)
    return store, second, third, folders(q.lake(spark, sf))


@pytest.mark.parametrize("name", ["", "initial", " x", None, "__HIVE_DEFAULT_PARTITION__"])
def test_names_that_could_be_confused_are_refused(spark, ws, started, name):
    store, second, _, _ = started
    before = store.reviews().count()
    with pytest.raises(ValueError, match="not a name"):
        append_batch(ws, store, second, name)
    assert store.reviews().count() == before


def test_a_refused_batch_leaves_nothing(spark, ws, started):
    store, second, third, lake = started
    before = store.reviews().count()
    places = store.places()
    twice = Store(spark, ws.path("twice"))
    twice.write_places(ws.write(places.union(places).union(places), "p"))
    twice.write_batch(review_features(second), "initial", first=True)
    with pytest.raises(ValueError, match="join_fanout"):
        append_batch(ws, twice, third, "bad")
    assert twice.batches() == ["initial"]
    assert store.reviews().count() == before


@pytest.mark.parametrize("lost_at", ["reviews", "states", "lake"])
def test_a_lost_attempt_is_caught_up_by_the_next_batch(spark, ws, started, lost_at, monkeypatch):
    from reviewtide.plans import incremental

    store, second, third, lake = started

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        if lost_at == "reviews":
            broken.setattr(Store, "write_states", die)
        elif lost_at == "states":
            broken.setattr(incremental, "rewrite_touched", die)
        else:
            broken.setattr(incremental, "write_partitioned", die)
        with pytest.raises(RuntimeError):
            append_batch(ws, store, second, "second")
    assert store.pending() == ["second"]
    assert same_rows(append_batch(ws, store, third, "third"), lake)
    assert store.pending() == []


def test_failed_checks_leave_the_published_tables(spark, raw_paths, ws, monkeypatch):
    from reviewtide.plans import run as runs

    out, warehouse = ws.path("out"), Warehouse("i", ws.name)
    published = run(spark, *raw_paths, out, warehouse)
    before = {name: df.collect() for name, df in published.tables.items()}
    with monkeypatch.context() as broken:
        broken.setattr(runs, "run_checks", lambda *_: quality.check_non_empty(spark.range(0), "users"))
        with pytest.raises(quality.CheckFailed):
            run(spark, *raw_paths, out, warehouse)
    with monkeypatch.context() as broken:
        broken.setattr(runs, "register_star", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, *raw_paths, out, warehouse)
    for name, rows in before.items():
        assert sorted(spark.table(f"{ws.name}.{name}").collect(), key=str) == sorted(rows, key=str)
        assert sorted(runs.star_tables(spark, out)[name].collect(), key=str) == sorted(rows, key=str)


def test_command_line_can_be_repeated(raw_paths, tmp_path):
    """Two processes with their own catalogs write to one folder; a third reads the tables."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {
        "PYTHONPATH": root,
        "PYSPARK_SUBMIT_ARGS": "--master local[4] --conf spark.ui.enabled=false "
        f"--conf spark.sql.shuffle.partitions=4 --conf spark.sql.warehouse.dir={tmp_path}/w "
        f"--conf spark.checkpoint.dir={tmp_path}/c pyspark-shell",
    }
    out = str(tmp_path / "out")
    command = [sys.executable, "-m", "reviewtide", "run", *raw_paths, out, "i", "--database", "dw"]
    for _ in range(2):
        done = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
        assert done.returncode == 0, done.stderr[-2000:]
    read = (
        "from pyspark.sql import SparkSession; from reviewtide.plans.run import star_tables; "
        "s = SparkSession.builder.getOrCreate(); "
        f"print('COUNTS', *(df.count() for df in star_tables(s, {out!r}).values()))"
    )
    done = subprocess.run([sys.executable, "-c", read], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "COUNTS 88 6 6 202" in done.stdout, done.stderr[-2000:]


def test_category_views(spark, sf):
    lk.category_views(q.lake(spark, sf), {"v_click": "click", "v_none": "nothing"})
    assert {r.category for r in spark.table("v_click").select("category").distinct().collect()} == {"click", None}
    assert {r.category for r in spark.table("v_none").select("category").distinct().collect()} == {None}


def test_averages_of_totals_are_averages(spark, sf):
    reviews = review_features(fx.raw_reviews(spark, sf))
    plain = reviews.groupBy("gPlusUserId").agg(F.avg("rating").alias("userAvgRating"))
    assert same_rows(user_averages(user_totals(reviews)), plain)
