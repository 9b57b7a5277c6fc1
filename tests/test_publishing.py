"""Publishing: whole or not at all, by signed changes, with corrections and withdrawals."""

import os
from urllib.parse import unquote

import pytest
from core_helpers import plan_of
from pyspark.sql import functions as F

from reviewtide.checks import fixtures as fx
from reviewtide.checks import queries as q
from reviewtide.operators import quality
from reviewtide.operators.star import build_star
from reviewtide.plans import incremental, rollups, snapshot, star_changes
from reviewtide.plans import lake as lk
from reviewtide.plans import store as stores
from reviewtide.plans.incremental import add_batch, append_batch, rewrite_touched, withdraw_batch
from reviewtide.plans.prepare import review_features
from reviewtide.plans.run import Warehouse, publish_star, star_tables
from reviewtide.plans.snapshot import Snapshot, Star, current, replace
from reviewtide.plans.store import Store
from reviewtide.schemas import REVIEWS_RAW, STAR_KEYS, STAR_REFERENCES
from reviewtide.sources import files, readers, writers

LIKE = "i"  # text in the categories of the star


def rows(df) -> list:
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def raw(spark, sf):
    return fx.raw_reviews(spark, sf)


def thirds(raw):
    return [raw.filter(F.col("event_id") % 3 == k) for k in range(3)]


@pytest.fixture
def make(spark, ws, sf):
    """A store with some batches, its lake written by a full build."""

    def of(**batches):
        store = Store(spark, ws.path("store"))
        store.write_places(q.places(spark, sf))
        for k, (name, raw) in enumerate(batches.items()):
            store.write_batch(review_features(raw), name, first=k == 0)
        store.write_lake(ws)
        return store

    return of


def full_star(store, like=LIKE, scale=0):
    return build_star(star_changes.staging_rows(store, store.snapshot().lake, like), scale)


def assert_star_is_full(store, tables):
    for name, df in full_star(store).items():
        assert rows(tables[name]) == rows(df), name


def test_a_listing_task_takes_many_folders(spark, ws):
    """Before, each lake folder was a task of its own whenever the lake was read."""
    store = Store(spark, ws.path("store"))
    many = spark.range(600).select((F.col("id") % 300).cast("string").alias("category"), "id")
    many.repartition(1).write.partitionBy("category").parquet(store.path(snapshot.LAKE, "v1"))
    folders = {name: "v1" for name in files.children(spark, store.path(snapshot.LAKE, "v1")) if "=" in name}
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("listing", "listing of folders")
    lake = store.lake(folders, (("category", "string"), ("id", "bigint")))
    context._jsc.clearJobGroup()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    tasks = [tracker.getStageInfo(stage).numTasks for stage in stages]
    assert len(folders) == 300 and lake.count() == 600
    assert tasks and max(tasks) <= 4 * context.defaultParallelism


def test_a_batch_is_written_once(spark, ws, make, raw, monkeypatch):
    """Before, it went into a table of its own first, to be checked there."""
    first, second, third = thirds(raw)
    store = make(initial=first)
    tables, write = [], type(ws).write
    monkeypatch.setattr(type(ws), "write", lambda self, df, name: tables.append(name) or write(self, df, name))
    add_batch(ws, store, review_features(second), "second")
    assert tables and "batch" not in tables
    assert store.reviews([store.snapshot().reviews["second"]]).count() == second.count()
    # A refused one leaves no folder.
    base = store.path(snapshot.REVIEWS)
    places = store.places()
    store.write_places(ws.write(places.union(places).union(places), "p"))
    before = files.children(spark, base)
    with pytest.raises(ValueError, match="join_fanout"):
        add_batch(ws, store, review_features(third), "third")
    assert files.children(spark, base) == before and store.batches() == ["initial", "second"]


def test_small_files(spark, ws):
    path = ws.path("small")
    assert files.children(spark, path) == []
    files.write_small(spark, f"{path}/a", "één\n")
    assert files.read_small(spark, f"{path}/a") == "één\n"
    with pytest.raises(FileExistsError):
        files.write_small(spark, f"{path}/a", "other")
    assert files.read_small(spark, f"{path}/a") == "één\n"
    assert [n for n in files.children(spark, path) if not n.startswith((".", "_"))] == ["a"]
    files.remove(spark, path)
    files.remove(spark, path)
    assert files.children(spark, path) == []


def test_snapshots(spark, ws):
    root = ws.path("s")
    assert current(spark, root) == Snapshot()
    one = Snapshot(reviews={"initial": "v1", "day 2": "v2"}, in_lake={"initial": "v1", "gone": "v0"},
                   lake={"category=a%2Fb": "v1"}, star=Star("x", 2, "v3", 4, {"users": {"part=0": ["v1"]}}))
    snapshot.publish(spark, root, one)
    assert current(spark, root) == one and one.pending() == ["day 2", "gone"]
    snapshot.publish(spark, root, replace(one, places="v9"))
    assert current(spark, root).places == "v9"


@pytest.mark.parametrize("whole", [True, False])
def test_a_write_that_dies_half_way_leaves_the_lake(spark, ws, make, raw, monkeypatch, whole):
    """From a full run and from an increment; another session reads on as if nothing had been."""
    first, second, _ = thirds(raw)
    store = make(initial=first)
    other = Store(spark.newSession(), store.root)
    before = rows(other.lake())
    reading = other.lake()  # planned before, read after

    def half(df, path, counts, *_, **__):
        writers.write_partitioned(df.filter("rating > 2"), path, counts)
        raise RuntimeError("lost")

    def attempt():
        if whole:
            draft = store.draft()
            draft.write_places(q.places(spark, "/root/testdata/sf0.001"))
            draft.write_batch(review_features(first.union(second)), "initial", first=True)
            draft.write_lake(ws)
            draft.publish()
        else:
            append_batch(ws, store, second, "second")

    with monkeypatch.context() as broken:
        broken.setattr(stores.Store.write_folders, "__defaults__", (half,))
        broken.setattr(incremental, "write_partitioned", half)
        with pytest.raises(RuntimeError):
            attempt()
    assert rows(other.lake()) == before
    attempt()
    assert rows(reading) == before
    assert rows(other.lake()) == rows(make(initial=first, second=second).lake())


def test_clean_up(spark, ws, make, raw):
    """Replaced folders stay until the next run begins, live ones longer."""
    first, second, third = thirds(raw)
    store = make(initial=first)
    publish_star(ws, store, Warehouse(LIKE, ws.name, parts=3), anew=True)
    was = store.lake()
    before = rows(was)
    append_batch(ws, store, second, "second")
    assert rows(was) == before
    dead = store.path(snapshot.LAKE, "vdead")
    writers.write_parquet(spark.range(3), f"{dead}/category=x")
    lake, star = rows(store.lake()), {n: rows(t) for n, t in star_tables(spark, store.root).items()}
    removed = store.clean_up()
    assert f"{snapshot.LAKE}/version=vdead" in removed
    assert store.clean_up() == []
    assert rows(store.lake()) == lake
    assert {n: rows(t) for n, t in star_tables(spark, store.root).items()} == star
    assert len(files.children(spark, f"{store.root}/{snapshot.SNAPSHOTS}")) == 1
    append_batch(ws, store, third, "third")
    assert rows(store.lake()) == rows(make(initial=raw).lake())


def test_corrected_batch(spark, ws, make, raw):
    """Rows that vanish, change or come: as if the batch had always been so."""
    first, second, third = thirds(raw)
    store = make(initial=first)
    wrong = (
        second.union(third.limit(40))
        .withColumn("rating", F.col("rating") + 1)
        .withColumn("categories", F.concat("categories", F.array(F.lit("wrong category"))))
    )
    append_batch(ws, store, wrong, "second")
    assert store.lake().filter("category = 'wrong category'").count() > 0
    lake = append_batch(ws, store, second, "second")
    assert rows(lake) == rows(make(initial=first, second=second).lake())
    assert store.pending() == [] and store.batches() == ["initial", "second"]


def test_withdrawn_batch(ws, make, raw):
    first, second, third = thirds(raw)
    store = make(initial=first)
    append_batch(ws, store, second, "second")
    append_batch(ws, store, third, "third")
    lake = withdraw_batch(ws, store, "second")
    assert rows(lake) == rows(make(initial=first, third=third).lake())
    with pytest.raises(ValueError, match="no batch"):
        withdraw_batch(ws, store, "second")
    with pytest.raises(ValueError, match="not a name"):
        withdraw_batch(ws, store, "initial")


def test_a_correction_that_dies_is_caught_up(ws, make, raw, monkeypatch):
    first, second, third = thirds(raw)
    store = make(initial=first)
    append_batch(ws, store, second.limit(100), "second")
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "rewrite_touched", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            append_batch(ws, store, second, "second")
        with pytest.raises(ZeroDivisionError):
            withdraw_batch(ws, store, "second")
    assert store.pending() == ["second"]
    append_batch(ws, store, third, "third")
    assert rows(store.lake()) == rows(make(initial=first, third=third).lake())


def test_star_by_signed_changes(spark, ws, make, raw):
    """After a batch, a correction and a withdrawal the star is that of the whole lake."""
    first, second, third = thirds(raw)
    store, warehouse = make(initial=first), Warehouse(LIKE, ws.name, parts=5)
    publish_star(ws, store, warehouse, anew=True)
    assert_star_is_full(store, star_tables(spark, store.root))
    changes = (
        lambda: add_batch(ws, store, review_features(second), "second"),
        lambda: add_batch(ws, store, review_features(second.limit(60).union(third)), "second"),
        lambda: withdraw_batch(ws, store, "second"),
        lambda: add_batch(ws, store, review_features(second), "again"),
    )
    for change in changes:
        change()
        published, checks = publish_star(ws, store, warehouse)
        assert all(c.passed for c in checks)
        assert_star_is_full(store, star_tables(spark, store.root))
        assert_star_is_full(store, published)
        assert_star_is_full(store, {n: spark.table(f"{ws.name}.{n}") for n in published})


def test_only_touched_folders_and_parts(spark, ws, make, raw, monkeypatch):
    """One review of one place: no other lake folder is read, parts without a change stay."""
    first, second, _ = thirds(raw)
    store, warehouse = make(initial=first), Warehouse(LIKE, ws.name, parts=16)
    publish_star(ws, store, warehouse, anew=True)
    before = store.snapshot()
    known = store.lake().filter(F.col("category").contains(LIKE)).first()
    # a reviewer without other reviews, so that no average changes but their own
    one = second.limit(1).withColumns({
        "gPlusUserId": F.lit("new one"), "gPlusPlaceId": F.lit(known.gPlusPlaceId),
        "categories": F.array(F.lit(known.category)),
    })
    add_batch(ws, store, review_features(one), "one")
    after = store.snapshot()
    touched = {f for f, v in after.lake.items() if before.lake.get(f) != v}
    assert 0 < len(touched) < len(after.lake)

    seen = []
    signed = star_changes.signed_staging

    def spied(ws, gone, new):
        seen.extend([*gone.inputFiles(), *new.inputFiles()])
        return signed(ws, gone, new)

    monkeypatch.setattr(star_changes, "signed_staging", spied)
    publish_star(ws, store, warehouse)
    assert {unquote(os.path.basename(os.path.dirname(f))) for f in seen} <= {unquote(f) for f in touched}
    assert_star_is_full(store, star_tables(spark, store.root))
    was, now = before.star.tables, store.snapshot().star.tables
    for table in now:
        changed = {p for p, v in now[table].items() if was[table].get(p) != v}
        assert len(changed) <= 1, table
    assert all(versions[: len(was["reviews"].get(p, []))] == was["reviews"].get(p, [])
               for p, versions in now["reviews"].items())


def test_many_small_batches_are_brought_together(spark, ws, make, raw, monkeypatch):
    monkeypatch.setattr(star_changes, "MOST_FOLDERS", 2)
    first, second, _ = thirds(raw)
    store, warehouse = make(initial=first), Warehouse(LIKE, ws.name, parts=1)
    publish_star(ws, store, warehouse, anew=True)
    for k in range(3):
        add_batch(ws, store, review_features(second.filter(F.col("event_id") % 9 == 3 * k + 1)), f"b{k}")
        publish_star(ws, store, warehouse)
        assert all(len(v) <= 2 for v in store.snapshot().star.tables["reviews"].values())
    assert_star_is_full(store, star_tables(spark, store.root))


def test_a_star_out_of_step_is_noticed(spark, ws, make, raw):
    """Changes that would take away rows which are not there raise instead of being lost."""
    first, second, _ = thirds(raw)
    store, warehouse = make(initial=first), Warehouse(LIKE, ws.name, parts=2)
    publish_star(ws, store, warehouse, anew=True)
    star = store.snapshot().star
    emptied = {**star.tables, "reviews": {p: [] for p in star.tables["reviews"]}}
    store.change(lambda s: replace(s, star=replace(star, tables=emptied)))
    add_batch(ws, store, review_features(second), "second")
    withdraw_batch(ws, store, "second")
    store.change(lambda s: replace(s, lake={}))
    with pytest.raises(Exception, match="out of step"):
        publish_star(ws, store, warehouse)


def test_rewriting_without_a_change(ws, make, raw):
    store = make(initial=thirds(raw)[0])
    before = store.snapshot()
    rewrite_touched(ws, store)
    assert store.snapshot() == before


LINES = [
    ("{u'a': 1, u'b': [u'x']}", None),
    ("{u'a': None, u'b': None}", None),
    ("", None),
    ("{u'a': 1, u'b'", "not JSON"),
    ("free text", "not JSON"),
    ("{u'a': u'one', u'b': [u'x']}", "wrong type: a"),
    ("{u'a': u'one', u'b': 3}", "wrong type: a, b"),
]


def test_rejected_lines(spark, ws):
    """Rejects and records are all lines but the blank one; one scan of the text gives both."""
    path = ws.path("lines")
    writers.write_text(spark.createDataFrame([(line,) for line, _ in LINES], "value string"), path)
    whole = readers.read_dirty_json_whole(spark, path, (("a", "bigint"), ("b", "array<string>")))
    assert plan_of(whole).count("Scan text") == 1
    found = ws.write(whole, "whole")
    rejects = {tuple(r) for r in readers.rejects_of(found).collect()}
    assert rejects == {(line, reason) for line, reason in LINES if reason}
    assert sorted(map(str, readers.records_of(found).collect())) == ["Row(a=1, b=['x'])", "Row(a=None, b=None)"]


def test_rejects_are_kept_by_batch(spark, ws, sf, make, raw):
    """Beside the records of their batch, and gone with it."""
    first, second, _ = thirds(raw)
    store = make(initial=first)
    path = ws.path("day")
    broken = spark.createDataFrame([("{u'cut",), ("{u'rating': u'good'}",)], "value string")
    writers.write_text(fx.review_lines(spark, sf).limit(30).union(broken), path)
    whole = review_features(readers.read_dirty_json_whole(spark, path, REVIEWS_RAW))
    add_batch(ws, store, whole, "day")
    assert {tuple(r) for r in store.rejects().collect()} == {
        ("{u'cut", "not JSON"), ("{u'rating': u'good'}", "wrong type: rating"),
    }
    assert store.reviews().count() == first.count() + 30
    withdraw_batch(ws, store, "day")
    assert store.rejects().count() == 0 and store.rejects(snapshot.PLACES).count() == 0
    assert rows(store.lake()) == rows(make(initial=first).lake())


def test_checks_at_the_cost_of_the_day(spark, ws, make, raw, monkeypatch):
    """The same findings as checks of the whole star; no file of the fact that was there is read."""
    first, second, _ = thirds(raw)
    store, warehouse = make(initial=first), Warehouse(LIKE, ws.name, parts=4)
    publish_star(ws, store, warehouse, anew=True)
    before = store.snapshot().star
    add_batch(ws, store, review_features(second), "second")
    now = star_changes.updated_star(ws, store, LIKE, 0)
    assert now.rows == {
        t: {f"part={r['part']}": r["count"] for r in star_changes.read_part_files(
            spark, store.root, t, now, (star_changes.PART,)).groupBy("part").count().collect()}
        for t in now.tables
    }
    report = star_changes.check_changes(store, before, now)
    old = {f"{v}/{p}" for p, versions in before.tables["reviews"].items() for v in versions}
    read = [f for f in report.inputFiles() if "/reviews/" in f]
    assert read and not [f for f in read if any(o in f for o in old)]
    found = {(r.check, r.table): r.passed for r in report.collect()}
    whole = quality.run_checks(star_changes.star_rows(spark, store.root, now), STAR_KEYS, STAR_REFERENCES)
    assert found == {(r.check, r.table): r.passed for r in whole.collect()} and all(found.values())


def test_a_duplicate_across_batches_is_found(spark, ws, make, raw, sf):
    """Another name of a known place, which comes with a later batch, stops the star."""
    first, second, third = thirds(raw)
    store, warehouse = make(initial=first), Warehouse(LIKE, ws.name, parts=4)
    publish_star(ws, store, warehouse, anew=True)
    published = {n: rows(t) for n, t in star_tables(spark, store.root).items()}
    # Only the folders that this batch touches are written with the other name.
    store.write_places(q.places(spark, sf).withColumn("name", F.concat("name", F.lit(" renamed"))))
    known = store.lake().filter(F.col("category").contains(LIKE)).groupBy("gPlusPlaceId").agg(
        F.countDistinct("category").alias("n"), F.min("category").alias("category")).filter("n > 1").first()
    one = second.limit(1).withColumns({
        "gPlusUserId": F.lit("new one"), "gPlusPlaceId": F.lit(known.gPlusPlaceId),
        "categories": F.array(F.lit(known.category)),
    })
    add_batch(ws, store, review_features(one), "one")
    with pytest.raises(quality.CheckFailed, match="unique_key"):
        publish_star(ws, store, warehouse)
    assert {n: rows(t) for n, t in star_tables(spark, store.root).items()} == published


def test_rollup(spark, ws, make, raw, monkeypatch):
    """Equal to the plain question at any time; only new folders are added up, and none twice."""
    first, second, third = thirds(raw)
    store = make(initial=first)

    def assert_right():
        sums = rollups.rollup(store)
        assert rows(rollups.rating_by_category(sums)) == rows(lk.rating_by_category(store.lake_values().drop(
            "category").withColumnRenamed("categoryValue", "category")))
        by_day = rollups.rating_by_daypart(sums, LIKE)
        plain = star_changes.staging_rows(store, store.snapshot().lake, LIKE).groupBy("weekday", "day_night")
        assert rows(by_day) == rows(plain.agg(
            F.avg("rating").alias("avg_rating"), F.count("*").alias("num_reviews")))

    assert_right()  # before any sums are kept
    assert rollups.refresh(ws, store) == sorted(store.snapshot().lake)
    assert rollups.refresh(ws, store) == []
    assert not any("reviews_lake" in f for f in rollups.rollup(store).inputFiles())
    assert_right()
    before = store.snapshot().lake
    monkeypatch.setattr(rollups, "MOST_VERSIONS", 2)
    for name, batch in (("second", second), ("third", third)):
        append_batch(ws, store, batch, name)
        assert_right()  # the sums of new folders are not there yet
        new = sorted(f for f, v in store.snapshot().lake.items() if before.get(f) != v)
        assert rollups.refresh(ws, store) == new
        assert_right()
        before = store.snapshot().lake
    assert len(store.snapshot().rollup.versions) == 1
    withdraw_batch(ws, store, "second")
    rollups.refresh(ws, store)
    store.clean_up()
    assert_right()
