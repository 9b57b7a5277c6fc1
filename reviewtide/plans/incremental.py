"""Changes of the reviews on top of a published store: a further batch, a batch sent again
with other rows, a batch withdrawn.

The result equals a full run over all batches as they are now. What changes is not only the
batch's own rows: a reviewer's average changes on all their other rows, and a category may pass
the rare filter for the first time, or no longer. The states of what the lake has and of what is
live are compared, so that reviewers and categories which lose rows are found too. Categories
with such rows are written anew, the other lake folders stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from reviewtide.operators.averages import merge_totals, user_averages
from reviewtide.operators.categories import (
    MIN_REVIEWS,
    explode_categories,
    has_categories,
    keep_categories,
)
from reviewtide.operators.quality import enforce, guard_join_fanout
from reviewtide.operators.sizing import checked_broadcast
from reviewtide.plans.lake import build_part, usa_places
from reviewtide.plans.prepare import review_features
from reviewtide.plans.snapshot import Snapshot, replace
from reviewtide.plans.store import Store, category_of, checked_batch_name
from reviewtide.session import Workspace
from reviewtide.sources.writers import write_partitioned


class Change:
    """Versions of batches that the lake has and that are live: unchanged, gone, and new."""

    def __init__(self, snapshot: Snapshot):
        was, now = snapshot.in_lake, snapshot.reviews
        self.same = [v for b, v in was.items() if now.get(b) == v]
        self.gone = [v for b, v in was.items() if now.get(b) != v]
        self.new = [v for b, v in now.items() if was.get(b) != v]

    @property
    def any(self) -> list[str]:
        return [*self.gone, *self.new]


def changed_users(store: Store, change: Change) -> DataFrame:
    """Users of unchanged batches too, whose average is another one than the lake has."""
    users = store.totals(change.any).select(F.col("gPlusUserId").alias("_user"))
    same = F.col("gPlusUserId").eqNullSafe(F.col("_user"))

    def averages(versions: list[str]) -> DataFrame:
        return user_averages(merge_totals(store.totals(versions).join(users, same, "left_semi")))

    was = averages([*change.same, *change.gone]).toDF("_user", "was")
    now = averages([*change.same, *change.new]).withColumnRenamed("userAvgRating", "now")
    return (
        now.join(was, same, "inner")
        .filter(~F.col("now").eqNullSafe(F.col("was")))
        .select("gPlusUserId")
    )


def touched_categories(ws: Workspace, store: Store, change: Change) -> DataFrame:
    """Categories with a row that is new or gone, or with one whose average changed."""
    users = ws.write(changed_users(store, change), "changed_users")
    users = checked_broadcast(users.withColumnRenamed("gPlusUserId", "_user"))
    same = F.col("gPlusUserId").eqNullSafe(F.col("_user"))
    older = has_categories(store.reviews(change.same)).join(users, same, "left_semi")
    pairs = explode_categories(older.select("gPlusPlaceId", "categories")).distinct()
    ids = usa_places(store.places()).select("gPlusPlaceId")
    stale = pairs.join(ids, "gPlusPlaceId", "left_semi").select("category")
    own = store.counts(change.any).select("category")
    # Null and '' share a lake folder, so one of them brings the other along.
    category = F.col("category")
    folder = F.when(
        F.coalesce(category, F.lit("")) == "", F.array(F.lit(None).cast("string"), F.lit(""))
    ).otherwise(F.array(category))
    return stale.union(own).select(F.explode(folder).alias("category")).distinct()


def untouched_folders(lake: dict[str, str], touched: DataFrame) -> dict[str, str]:
    """The lake folders without a touched category. No more is collected than there are folders."""
    spark = touched.sparkSession
    live = spark.createDataFrame([(f, category_of(f)) for f in lake], "folder string, category string")
    hit = keep_categories(live, touched).select("folder").collect()
    return {f: v for f, v in lake.items() if f not in {row["folder"] for row in hit}}


def rewrite_touched(ws: Workspace, store: Store, min_reviews: int = MIN_REVIEWS) -> None:
    """Bring the lake up to date: the folders that pending batches change are written anew and
    take the places of the former ones, all at once.

    Only reviews of places with touched categories are joined.
    """
    snapshot = store.snapshot()
    touched = ws.write(touched_categories(ws, store, Change(snapshot)), "touched")
    kept = store.category_counts().filter(F.col("num_reviews") > min_reviews)
    written = ws.write_all({"touched_counts": keep_categories(kept, touched), "averages": store.averages()})
    counts = written["touched_counts"]
    part = build_part(
        store.reviews(), store.places(), written["averages"], counts.select("category")
    )
    folders = store.write_folders(part, counts, write_partitioned)
    stays = untouched_folders(snapshot.lake, touched)
    store.change(lambda s: replace(s, lake={**stays, **folders}, in_lake=dict(snapshot.states)))


def append_batch(
    ws: Workspace, store: Store, raw_reviews: DataFrame, batch: str, min_reviews: int = MIN_REVIEWS
) -> DataFrame:
    """Add ``raw_reviews`` as ``batch`` and return the lake with it.

    Nothing is written to the store if a join would multiply the batch's reviews.
    """
    add_batch(ws, store, review_features(raw_reviews), batch, min_reviews)
    return store.lake()


def add_batch(
    ws: Workspace,
    store: Store,
    features: DataFrame,
    batch: str,
    min_reviews: int = MIN_REVIEWS,
    raw_bytes: int = 0,
) -> list[Row]:
    """Write a batch once, check what is written, make it live and bring the lake up to date;
    returns the check rows. A refused batch is removed again.

    A batch that is there already is corrected: its rows are these from now on. Rejected lines
    among ``features`` are kept beside its records.
    """
    checked_batch_name(batch)
    store.clean_up()
    version = store.stage_reviews(features)
    try:
        records = store.reviews([version])
        report = enforce(guard_join_fanout(records, usa_places(store.places())))
        store.write_missing_states()
    except BaseException:
        store.drop_staged(version)
        raise
    store.publish_reviews(batch, version, first=False)
    store.write_states(batch, first=False, raw_bytes=raw_bytes)
    rewrite_touched(ws, store, min_reviews)
    return report


def withdraw_batch(
    ws: Workspace, store: Store, batch: str, min_reviews: int = MIN_REVIEWS
) -> DataFrame:
    """Take a batch back and return the lake without it."""
    store.clean_up()
    store.write_missing_states()
    store.withdraw(checked_batch_name(batch))
    rewrite_touched(ws, store, min_reviews)
    return store.lake()
