"""Joins, aggregates, filters, layout and checks on small literal frames."""

import warnings

import pytest
from pyspark.sql import functions as F

from core_helpers import plan_of
from reviewtide.operators import categories as cat
from reviewtide.operators import layout, quality
from reviewtide.operators.averages import (
    merge_totals,
    user_averages,
    user_totals,
    with_user_average,
)
from reviewtide.operators.population import join_population, population_by_zip
from reviewtide.operators.sizing import checked_broadcast, measured_bytes
from reviewtide.operators.star import build_star, replace_table
from reviewtide.plans import lake as lk
from reviewtide.schemas import CENSUS, STAGING, STAR_KEYS, STAR_REFERENCES, ZIP, ddl


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def population_frame(spark):
    rows = [("00501", "1"), ("00501", "2.5"), ("00501", None), ("00501", "x"), ("bad", "7"), (None, "9")]
    return frame(spark, rows, f"`{ZIP}` string, `{CENSUS}` string")


def test_population_by_zip(spark):
    sums = {r[0]: r[1] for r in population_by_zip(population_frame(spark)).collect()}
    assert sums == {"00501": 3.5, "bad": 7.0, None: 9.0}


def test_join_population_keeps_all_places(spark):
    places = frame(spark, [("a", "00501"), ("b", "99999"), ("c", None)], "id string, postcode string")
    joined = join_population(places, population_frame(spark))
    assert joined.columns == ["id", "postcode", "population"]
    assert sorted(map(tuple, joined.collect())) == [
        ("a", "00501", 3.5), ("b", "99999", None), ("c", None, None),
    ]


def test_user_average(spark):
    rows = [(1, None, 1.0), (2, None, 3.0), (3, "a", None), (4, "a", 4.0), (5, "b", None)]
    reviews = frame(spark, rows, "id int, gPlusUserId string, rating double")
    got = {r.id: r.userAvgRating for r in with_user_average(reviews).collect()}
    assert got == {1: 2.0, 2: 2.0, 3: 4.0, 4: 4.0, 5: None}


def test_totals_of_batches_add_up(spark):
    schema = "gPlusUserId string, rating double"
    one = frame(spark, [("a", 1.0), (None, 5.0)], schema)
    two = frame(spark, [("a", 4.0), (None, None)], schema)
    merged = user_averages(merge_totals(user_totals(one).union(user_totals(two))))
    whole = user_averages(user_totals(one.union(two)))
    assert set(map(tuple, merged.collect())) == set(map(tuple, whole.collect())) == {("a", 2.5), (None, 5.0)}


def test_explode_categories(spark):
    rows = [(1, ["a", None]), (2, []), (3, None), (4, ["b", "b"])]
    got = cat.explode_categories(frame(spark, rows, "id int, categories array<string>"))
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a"), (1, None), (4, "b"), (4, "b")]


def rows_of(**counts):
    return [(None if c == "null" else c,) for c, n in counts.items() for _ in range(n)]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_rare_filter_is_strict_and_keeps_null(spark, ws, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(cat, "checked_broadcast", lambda df: checked_broadcast(df, broadcast_bytes))
    df = frame(spark, rows_of(ten=10, eleven=11, null=11), "category string")
    kept = cat.drop_rare_categories(df, ws)
    assert {(r.category, r["count"]) for r in kept.groupBy("category").count().collect()} == {
        ("eleven", 11), (None, 11),
    }


def test_rare_filter_equals_window_form(spark, ws, sf):
    from pyspark.sql import Window

    from reviewtide.checks.fixtures import raw_reviews

    df = cat.explode_categories(raw_reviews(spark, sf).select("event_id", "categories"))
    n = F.count("event_id").over(Window.partitionBy("category"))
    window_form = df.withColumn("n", n).filter("n > 10").drop("n")
    assert window_form.exceptAll(cat.drop_rare_categories(df, ws)).count() == 0
    assert cat.drop_rare_categories(df, ws).exceptAll(window_form).count() == 0


def test_category_counts_equal_the_joined_rows(spark):
    reviews = frame(
        spark,
        [("p", ["a", "b"]), ("p", ["a"]), ("q", ["a", None]), ("gone", ["a"]), (None, ["a"]), ("q", None)],
        "gPlusPlaceId string, categories array<string>",
    )
    places = frame(spark, [("p",), ("p",), ("q",), (None,)], "gPlusPlaceId string")
    counts = {tuple(r) for r in cat.category_counts(reviews, places).collect()}
    assert counts == {("a", 5), ("b", 2), (None, 1)}


def test_category_like(spark):
    df = frame(spark, [("Rx",), ("b",), ("r",), (None,)], "category string")
    got = {r.category for r in cat.filter_category_like(df, "R").collect()}
    assert got == {"Rx", None}


def test_distinct_categories_count_null(spark):
    df = frame(spark, [("a",), ("a",), (None,)], "category string")
    assert cat.count_distinct_categories(df).first()[0] == 2


def test_broadcast_only_below_the_limit(spark, ws):
    df = ws.write(frame(spark, [("x" * 100,)] * 10, "s string"), "t")
    assert measured_bytes(df) == 10 * 116
    assert measured_bytes(df.filter("s is null")) == 0
    big = spark.range(10_000_000).selectExpr("cast(id as string) s")
    assert "BroadcastHashJoin" in plan_of(big.join(checked_broadcast(df, 1160), "s"))
    unhinted = checked_broadcast(df, 1159)
    assert unhinted is df


def test_arrays_count_when_measured(spark):
    rows = [([1] * 100, [("x", 1)] * 2, b"abcd"), (None, None, None)]
    df = frame(spark, rows, "a array<int>, b array<struct<s: string, n: int>>, c binary")
    assert measured_bytes(df) == 2 * 48 + 400 + 2 * 48 + 4


STAGED = [
    ("p1", "Bar", "day", "u1", 4.0, "t", 3.5, "Mon", "a", "USA", "n1", 10.4, "00501", 2, "CA"),
    ("p1", "Pub", "day", "u1", 4.0, "t", 3.5, "Mon", "a", "USA", "n1", 10.4, "00501", 2, "CA"),
    ("p2", "Bar", "night", None, 2.0, "t", 2.5, "Tue", "a", "USA", "n2", None, "00502", None, "CA"),
]


def star_of(spark, scale=0):
    return build_star(frame(spark, STAGED, ddl(STAGING)), scale)


def test_star_tables(spark):
    star = star_of(spark)
    assert star["users"].dtypes == [("gPlusUserId", "string"), ("avgRating", "decimal(18,0)")]
    assert {tuple(r) for r in star["users"].collect()} == {("u1", 4), (None, 3)}
    assert star["places"].count() == 2
    assert {(r[0], r[1]) for r in star["population"].collect()} == {("00501", 10), ("00502", None)}
    assert star["reviews"].count() == 3
    assert {str(r.avgRating) for r in star_of(spark, 2)["users"].collect()} == {"3.50", "2.50"}


def test_replace_table_can_be_repeated(spark, ws):
    users = star_of(spark)["users"]
    for _ in range(2):
        assert replace_table(users, ws.table_name("users")).count() == 2


def test_layout_joins_without_exchange_and_splits_a_hot_place(spark, ws, conf):
    conf(autoBroadcastJoinThreshold="-1")
    hot = [("hot", "u", "c", "Mon", "day")] * 4000  # equal rows, a third of all
    rest = [(f"p{i}", "u", "c", "Mon", "day") for i in range(8000)]
    schema = "gPlusPlaceId string, gPlusUserId string, category string, weekday string, day_night string"
    star = {
        "reviews": frame(spark, hot + rest, schema),
        "places": frame(spark, [("hot", "H")] + [(f"p{i}", str(i)) for i in range(8000)], "gPlusPlaceId string, name string"),
        "users": frame(spark, [("u", 1)], "gPlusUserId string, avgRating int"),
        "population": frame(spark, [("00501", 1)], "postcode string, population int"),
    }
    star["reviews"] = ws.write(star["reviews"], "fact")
    tables = layout.write_layout(star, ws.table_name("l_"), 8)
    joined = layout.join_colocated(tables)
    assert joined.columns == [*star["reviews"].columns, "name"]
    assert joined.exceptAll(star["reviews"].join(star["places"], "gPlusPlaceId")).count() == 0
    assert joined.count() == 12000
    assert joined.filter("gPlusPlaceId = 'hot' and name = 'H'").count() == 4000
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    per_slice = tables["reviews"].filter("gPlusPlaceId = 'hot'").groupBy("slice").count().collect()
    assert len(per_slice) == 3 and max(r["count"] for r in per_slice) <= 1400
    plain = layout.without_slices(tables)
    assert plain["places"].count() == 8001 and plain["reviews"].count() == 12000
    assert plain["places"].columns == star["places"].columns


def test_buckets_follow_the_size(spark, ws):
    small = ws.write(frame(spark, [("a",)], "k string"), "small")
    assert layout.buckets_for(small) == layout.MIN_BUCKETS
    large = ws.write(spark.range(100_000), "large")
    assert layout.buckets_for(large, bucket_bytes=160_000) == 10
    star = {name: ws.write(df, name) for name, df in star_of(spark).items()}
    tables = layout.write_layout(star, ws.table_name("auto_"))
    assert "Exchange" not in plan_of(layout.join_colocated({k: t.hint("merge") for k, t in tables.items()}))


def test_few_places_count_as_hot(spark, ws):
    fact = frame(spark, [(f"p{i % 3}",) for i in range(90)], "gPlusPlaceId string")
    assert layout.place_slices(fact, 8).count() == 3
    assert layout.place_slices(fact, 2).count() == 0


def passed(report):
    return {(r.check, r.table): r.passed for r in report.collect()}


def test_fanout_guard(spark):
    reviews = frame(spark, [("p", ["a"])] * 3, "gPlusPlaceId string, categories array<string>")
    twice = frame(spark, [("p",), ("p",)], "gPlusPlaceId string")
    assert passed(quality.guard_join_fanout(reviews, twice)) == {
        ("join_fanout", "lake"): False, ("unique_key", "places"): False,
    }
    mostly_lost = reviews.union(frame(spark, [("x", ["a"])] * 9, reviews.schema))
    assert passed(quality.guard_join_fanout(mostly_lost, twice)) == {
        ("join_fanout", "lake"): True, ("unique_key", "places"): False,
    }
    with pytest.raises(quality.CheckFailed):
        quality.enforce(quality.guard_join_fanout(reviews, twice))
    with pytest.warns(UserWarning):
        quality.enforce(quality.guard_join_fanout(mostly_lost, twice))


def test_ineffective_filter_is_a_warning(spark):
    counts = frame(spark, [("a", 11), (None, 12)], "category string, num_reviews bigint")
    with pytest.warns(UserWarning):
        quality.enforce(quality.guard_filter_effective(counts))
    rare = counts.union(frame(spark, [("b", 10)], counts.schema))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        quality.enforce(quality.guard_filter_effective(rare))


def test_empty_table_fails(spark):
    empty = spark.range(0)
    assert passed(quality.check_non_empty(empty, "t")) == {("non_empty", "t"): False}
    with pytest.raises(quality.CheckFailed):
        quality.enforce(quality.guard_populated({"reviews_lake": empty}))


@pytest.mark.parametrize(
    "keys, ok", [(["a", "b"], True), (["a", "a"], False), ([None, None], True), ([], True)]
)
def test_unique_key(spark, keys, ok):
    df = frame(spark, [(k,) for k in keys], "k string")
    row = quality.check_unique_key(df, "t", "k").first()
    assert row.passed is ok
    assert row.expected == len([k for k in keys if k])


def test_referential(spark):
    fact = frame(spark, [("a",), ("b",), ("b",), (None,)], "k string")
    dim = frame(spark, [("a",)], "k string")
    row = quality.check_reference(fact, dim, "d", "k").first()
    assert (row.actual, row.passed) == (2, False)
    assert quality.check_reference(fact, dim.union(frame(spark, [("b",)], "k string")), "d", "k").first().passed


def test_report_scans_each_table_once(spark, ws):
    star = {name: ws.write(df, name) for name, df in star_of(spark).items()}
    report = quality.run_checks(star, STAR_KEYS, STAR_REFERENCES)
    plan = plan_of(report).split("== Initial Plan ==")[-1]
    assert plan.count("FileScan parquet") == 4
    got = {(r.check, r.table, r.column): (r.expected, r.actual, r.passed) for r in report.collect()}
    assert got == {
        ("non_empty", "users", None): (1, 2, True),
        ("non_empty", "places", None): (1, 2, True),
        ("non_empty", "population", None): (1, 2, True),
        ("non_empty", "reviews", None): (1, 3, True),
        ("unique_key", "places", "gPlusPlaceId"): (2, 2, True),
        ("unique_key", "population", "postcode"): (2, 2, True),
        ("unique_key", "users", "gPlusUserId"): (1, 1, True),
        ("referential", "places", "gPlusPlaceId"): (0, 0, True),
        ("referential", "users", "gPlusUserId"): (0, 0, True),
    }


def test_report_finds_what_is_wrong(spark, ws):
    star = {name: ws.write(df, name) for name, df in star_of(spark).items()}
    star["places"] = ws.write(star["places"].filter("gPlusPlaceId = 'p2'").unionByName(
        star["places"].filter("gPlusPlaceId = 'p2'")), "places")
    star["population"] = ws.write(star["population"].filter("false"), "population")
    report = {(r.check, r.table): r for r in quality.run_checks(star, STAR_KEYS, STAR_REFERENCES).collect()}
    assert {k for k, r in report.items() if not r.passed} == {
        ("non_empty", "population"), ("unique_key", "places"), ("referential", "places"),
    }
    assert report["referential", "places"].actual == 2
    assert (report["unique_key", "places"].expected, report["unique_key", "places"].actual) == (2, 1)
    alone = quality.run_checks({"reviews": star["reviews"]})
    assert [tuple(r)[:3] for r in alone.collect()] == [("non_empty", "reviews", None)]


def test_average_covers_reviews_outside_the_lake(spark, ws):
    schema = "gPlusPlaceId string, gPlusUserId string, rating double, reviewText string, categories array<string>, reviewTime timestamp, weekday string, day_night string"
    reviews = frame(
        spark,
        [("us", "u", 5.0, "t", ["a"], None, None, None), ("fr", "u", 1.0, "t", ["a"], None, None, None)],
        schema,
    )
    places = frame(
        spark,
        [("us", "n", 1, "a", "CA", "00501", "USA", 1.0), ("fr", "n", 1, "a", None, None, None, None)],
        "gPlusPlaceId string, name string, price int, address string, state string, postcode string, country string, population double",
    )
    lake = lk.lake_of(ws, reviews, places, min_reviews=0)
    assert [(r.gPlusPlaceId, r.userAvgRating) for r in lake.collect()] == [("us", 3.0)]
