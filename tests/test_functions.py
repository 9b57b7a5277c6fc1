"""Literal edge rows of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewtide.functions import places as p
from reviewtide.functions import times as t
from reviewtide.functions.repair import repair_python_literal
from reviewtide.plans.prepare import place_features
from reviewtide.sources.readers import count_malformed, drop_malformed, parse_json_lines


def value(spark, type_, given, expression):
    df = spark.createDataFrame([(given,)], f"x {type_}")
    return df.select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "line, repaired",
    [
        (
            "{'name': u'Menu', 'price': None, 'closed': False}",
            "{'name': 'Men', 'price': null, 'closed': false}",
        ),
        ('u"Joe\'s None"', '"Joe\'s null"'),
        ("you're", "yo're"),
        ("None of us", "null of us"),
        ("{u'open': True}", "{'open': true}"),
        (r"u'Caf\xe9'", r"'Caf\u00e9'"),
        ("uu'", "u'"),
        (None, None),
    ],
)
def test_blind_repair(spark, line, repaired):
    assert value(spark, "string", line, repair_python_literal) == repaired


@pytest.mark.parametrize(
    "line, repaired",
    [
        (
            "{u'name': u'Menu', u'price': None, u'l': [None, True], u'closed': False}",
            "{'name': 'Menu', 'price': null, 'l': [null, true], 'closed': false}",
        ),
        ('{u"t": u"Joe\'s None, you\'re"}', '{"t": "Joe\'s None, you\'re"}'),
        (r"{'a': u'Caf\xe9'}", r"{'a': 'Caf\u00e9'}"),
        (r"{'a': 'C:\\xe9'}", r"{'a': 'C:\\xe9'}"),
    ],
)
def test_token_repair_leaves_text_alone(spark, line, repaired):
    assert value(spark, "string", line, lambda c: repair_python_literal(c, "token")) == repaired


def test_unknown_repair_mode():
    with pytest.raises(ValueError):
        repair_python_literal(F.lit("x"), "other")


def test_parse_counts_and_drops_malformed(spark):
    lines = [
        r"{u'a': u'Caf\xe9', u'n': 1}",
        r"{u'a': u'Joe\'s \"x\"', u'n': 2}",
        r"{u'a': u'\U0001f600', u'n': 3}",
        "{'a': 'cut',",
        "{'a': 'wrong type', 'n': 'x'}",
        "",
        "   ",
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    repaired = df.withColumn("value", repair_python_literal(F.col("value")))
    parsed = parse_json_lines(repaired, (("a", "string"), ("n", "bigint")))
    rows = drop_malformed(parsed).collect()
    assert sorted((r.a, r.n) for r in rows) == [("Café", 1), ('Joe\'s "x"', 2)]
    assert count_malformed(parsed).first().asDict() == {"records": 5, "dropped": 3}
    # Asking for one column must not hide the wrong type in another.
    assert drop_malformed(parsed).select("a").count() == 2


@pytest.mark.parametrize(
    "last, expected",
    [
        ("X, CA 90210", ("CA", "90210", "USA")),
        ("X, CA 90210-1234", ("CA", "90210", "USA")),
        ("X, CA 902101", ("CA", "90210", "USA")),
        ("CA 00501", ("CA", "00501", "USA")),
        ("X, CA\t90210", ("CA", "90210", "USA")),
        ("X, CA  90210", (None, None, None)),
        ("X, CA\u00a090210", (None, None, None)),
        ("xCA 90210", (None, None, None)),
        ("X, ca 90210", (None, None, None)),
        ("X,CA 90210", (None, None, None)),
        ("X, CA 90210, ", (None, None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_state_postcode_country(spark, last, expected):
    df = spark.createDataFrame([(["A", last], "$", "n")], "address array<string>, price string, name string")
    row = place_features(df).first()
    assert (row.state, row.postcode, row.country) == expected


@pytest.mark.parametrize("address", [None, []])
def test_missing_address(spark, address):
    df = spark.createDataFrame([(address, None)], "address array<string>, price string")
    row = place_features(df).first()
    assert (row.state, row.postcode, row.country, row.address) == (None, None, None, "")


def test_address_text_skips_null(spark):
    assert value(spark, "array<string>", ["a", None, "b"], p.address_text) == "a,b"


@pytest.mark.parametrize("price, level", [("$$$", 3), ("", 0), (None, None)])
def test_price_level(spark, price, level):
    assert value(spark, "string", price, p.price_level) == level


def test_unused_columns_are_dropped(spark):
    df = spark.createDataFrame(
        [("p", ["a"], "$", "1", True, "g", "h")],
        "gPlusPlaceId string, address array<string>, price string, phone string, closed boolean, "
        "gps string, hours string",
    )
    assert set(place_features(df).columns) == {
        "gPlusPlaceId", "address", "price", "state", "postcode", "country",
    }


def test_time_features(spark):
    row = (
        spark.range(1)
        .select(t.review_time(F.lit(1294424319)).alias("x"))
        .select("x", t.weekday(F.col("x")), t.day_night(F.col("x")), t.iso_text(F.col("x")))
        .first()
    )
    assert tuple(row) == (
        dt.datetime(2011, 1, 7, 18, 18, 39), "Fri", "night", "2011-01-07T18:18:39.000Z",
    )


@pytest.mark.parametrize(
    "clock, part",
    [
        ("07:59:59", "night"),
        ("08:00:00", "day"),
        ("17:59:59", "day"),
        ("18:00:00", "night"),
        ("00:00:00", "night"),
        (None, None),
    ],
)
def test_day_night(spark, clock, part):
    text = clock and f"2020-05-05 {clock}"
    assert value(spark, "string", text, lambda c: t.day_night(c.cast("timestamp"))) == part


def test_review_time_is_exact_where_clocks_change(spark, conf):
    conf(session__timeZone="America/New_York")
    assert value(spark, "bigint", 1289109600, lambda c: F.unix_seconds(t.review_time(c))) == 1289109600


@pytest.mark.parametrize("given, rounded", [(2.5, 3), (3.5, 4), (4.3, 4), (4.5, 5)])
def test_decimals_round_half_up(spark, given, rounded):
    assert value(spark, "double", given, lambda c: c.cast("decimal(18,0)")) == rounded
