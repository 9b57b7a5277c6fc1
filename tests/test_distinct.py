"""Distinct counts by bitmaps against count distinct, batch after batch."""

import pytest
from core_helpers import plan_of
from pyspark.sql import functions as F

from reviewtide.operators import distinct


def batch(spark, k):
    """Values that come back in later batches, in uneven groups, with nulls on both sides."""
    n = 4000 + 3000 * k
    return spark.range(n).select(
        F.expr("if(id % 7 = 0, null, 'g' || (id * id) % 5)").alias("a"),
        F.expr("if(id % 3 = 0, 'x', 'y')").alias("b"),
        F.expr(f"if(id % 11 = 0, null, 'v' || (id * {k + 3}) % 70000)").alias("value"),
    )


@pytest.mark.parametrize("parts", [1, 16])
def test_counts_over_batches(spark, ws, parts):
    known = spark.createDataFrame([], distinct.DICTIONARY)
    kept, seen = [], None
    for k in range(3):
        rows = batch(spark, k)
        added = ws.write(distinct.new_ids(rows, known, parts), "ids")
        known = known.unionByName(added)
        kept.append(ws.write(distinct.bitmaps(rows, known, "a", "b"), "bits"))
        seen = rows if seen is None else seen.unionByName(rows)
        together = kept[0]
        for more in kept[1:]:
            together = together.unionByName(more)
        for groups in (("a", "b"), ("a",), ()):
            got = distinct.distinct_counts(together, *groups)
            want = seen.groupBy(*groups).agg(F.count_distinct("value").alias("num_values"))
            assert sorted(map(str, got.collect())) == sorted(map(str, want.filter("num_values > 0").collect()))
    ids = known.agg(F.count("*"), F.count_distinct("id"), F.count_distinct("value")).first()
    assert ids[0] == ids[1] == ids[2]
    # dense within each part, so that bitmaps are few
    dense = known.groupBy(F.expr(f"id div {distinct.PART_NUMBERS}")).agg(
        F.max(F.col("id") % distinct.PART_NUMBERS).alias("last"), F.count("*").alias("n")
    )
    assert dense.filter("last != n - 1").count() == 0
    plan = plan_of(distinct.distinct_counts(together, "a"))
    assert "value#" not in plan.replace("_value", "") and "Range" not in plan


def test_no_rows(spark, ws):
    none = batch(spark, 0).limit(0)
    known = spark.createDataFrame([], distinct.DICTIONARY)
    ids = distinct.new_ids(none, known)
    assert ids.count() == 0
    assert distinct.distinct_counts(distinct.bitmaps(none, ids, "a"), "a").count() == 0
