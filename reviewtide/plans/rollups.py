"""Sums and counts by category, weekday and part of day, kept beside the lake.

The rows of a lake folder are added up once, when the folder is new; the sums of folders that
stay are kept. Analyst questions read these few rows instead of the lake. Folders whose sums
are not there yet, because a run died before it made them, are added up on the spot, so an
answer is always that of the published lake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.operators.categories import filter_category_like
from reviewtide.plans.snapshot import ROLLUP, VERSION, Rollup, new_version, replace
from reviewtide.plans.store import LAKE_VALUES, Store, category_of
from reviewtide.schemas import Fields, names
from reviewtide.session import Workspace
from reviewtide.sources.readers import read_folders

MOST_VERSIONS = 16  # folders of sums, before they are brought together

#: ``lake_version`` and ``folder`` (a category, null for the default folder) tell whose sums
#: these are; ``category`` is that of the rows.
SUMS: Fields = (
    ("lake_version", "string"),
    ("folder", "string"),
    ("category", "string"),
    ("weekday", "string"),
    ("day_night", "string"),
    ("num_reviews", "bigint"),
    ("num_ratings", "bigint"),
    ("rating_sum", "double"),
)


def folder_sums(store: Store, folders: dict[str, str]) -> DataFrame:
    """The sums of some lake folders, from their rows; no text is read."""
    rows = store.lake(folders, (*LAKE_VALUES, ("version", "string")))
    return (
        rows.withColumnsRenamed({"category": "folder", "categoryValue": "category", "version": "lake_version"})
        .groupBy("lake_version", "folder", "category", "weekday", "day_night")
        .agg(
            F.count("*").alias("num_reviews"),
            F.count("rating").alias("num_ratings"),
            F.sum("rating").alias("rating_sum"),
        )
        .select(names(SUMS))
    )


def stale_folders(store: Store) -> dict[str, str]:
    """Live lake folders whose sums are not kept."""
    snapshot = store.snapshot()
    return {f: v for f, v in snapshot.lake.items() if snapshot.rollup.lake.get(f) != v}


def _kept(store: Store) -> DataFrame:
    """The kept sums of live folders."""
    snapshot = store.snapshot()
    live = [(v, category_of(f)) for f, v in snapshot.lake.items() if snapshot.rollup.lake.get(f) == v]
    # As many rows as there are folders, which the snapshot holds anyway.
    pairs = store.spark.createDataFrame(live, "_version string, _folder string")
    base = store.path(ROLLUP)
    sums = read_folders(store.spark, base, (f"{VERSION}{v}" for v in snapshot.rollup.versions), SUMS)
    same = (F.col("lake_version") == F.col("_version")) & F.col("folder").eqNullSafe(F.col("_folder"))
    return sums.join(pairs, same, "left_semi")


def rollup(store: Store) -> DataFrame:
    """Sums of the published lake by category, weekday and part of day."""
    stale = stale_folders(store)
    kept = _kept(store)
    whole = kept.unionByName(folder_sums(store, stale)) if stale else kept
    return whole.drop("lake_version", "folder")


def refresh(ws: Workspace, store: Store) -> list[str]:
    """Add up the folders that are new; returns these."""
    stale = stale_folders(store)
    snapshot = store.snapshot()
    if not stale and snapshot.rollup.lake.keys() == snapshot.lake.keys():
        return []
    version = new_version()
    new = folder_sums(store, stale)
    together = len(snapshot.rollup.versions) >= MOST_VERSIONS
    if together:
        new = new.unionByName(_kept(store))
    new.coalesce(1 + len(stale) // 1000).write.parquet(store.path(ROLLUP, version))
    versions = [version] if together else [*snapshot.rollup.versions, version]
    store.change(lambda s: replace(s, rollup=Rollup(versions, dict(snapshot.lake))))
    return sorted(stale)


def _averages(sums: DataFrame, *by: str) -> DataFrame:
    return sums.groupBy(*by).agg(
        F.try_divide(F.sum("rating_sum"), F.sum("num_ratings")).alias("avg_rating"),
        F.sum("num_reviews").alias("num_reviews"),
    )


def rating_by_category(sums: DataFrame) -> DataFrame:
    """Average rating and row count by category and part of day."""
    return _averages(sums, "category", "day_night")


def rating_by_daypart(sums: DataFrame, contains: str) -> DataFrame:
    """The same by weekday and part of day, over the categories that contain a text."""
    return _averages(filter_category_like(sums, contains), "weekday", "day_night")
