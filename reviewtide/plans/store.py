"""The files a run keeps, below one folder: prepared data, two small states, the lake.

Each write has a folder of its own, and a snapshot names those that are live, see
:mod:`reviewtide.plans.snapshot`. Prepared reviews and the states are kept by batch. A
state row is what its batch adds, so a batch is written without reading what is there, and
writing it again, or withdrawing it, replaces what it has added.

The snapshot tells how far each batch has come: whether its states are those of its reviews,
and which version of it the lake has. A batch whose run died is caught up by the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from threading import Lock
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.operators.averages import merge_totals, user_averages, user_totals
from reviewtide.operators.categories import MIN_REVIEWS, category_counts, merge_counts
from reviewtide.plans import snapshot as snapshots
from reviewtide.plans.lake import build_lake, usa_places
from reviewtide.plans.snapshot import VERSION, Snapshot, new_version, replace
from reviewtide.schemas import (
    CATEGORY_COUNTS,
    LAKE,
    PLACES,
    REJECT,
    REVIEW_FEATURES,
    USER_TOTALS,
    Fields,
    conform,
    names,
)
from reviewtide.session import Workspace, bounded_listing, concurrently
from reviewtide.sources.files import children, remove
from reviewtide.sources.readers import read_folders
from reviewtide.sources.writers import write_parquet, write_partitioned

FIRST_BATCH = "initial"
_NO_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of a null
KIND, RECORDS, REJECTS = ("kind", "string"), "records", "rejects"
LAKE_VALUES = (*LAKE, ("categoryValue", "string"))


def checked_batch_name(batch: str) -> str:
    """The name of a further batch. Names that could not be told from others are refused."""
    if not batch or batch != batch.strip() or batch in (FIRST_BATCH, _NO_FOLDER):
        raise ValueError(f"not a name for a further batch: {batch!r}")
    return batch


def category_of(folder: str) -> str | None:
    """The category whose rows a lake folder has; null and '' share one, which gives null."""
    value = folder.removeprefix("category=")
    return None if value == _NO_FOLDER else unquote(value)


class Store:
    """Reads what is published, and publishes each change, or in a draft all of them at once."""

    def __init__(self, spark: SparkSession, root: str, draft: Snapshot | None = None):
        self.spark, self.root = bounded_listing(spark), root
        self._draft = draft
        self._changing = Lock()

    def draft(self) -> Store:
        """A store that starts empty and is published by ``publish``. Until then, and if that
        does not come, the published one stays as it is."""
        return Store(self.spark, self.root, Snapshot(star=self.snapshot().star))

    def snapshot(self) -> Snapshot:
        return self._draft or snapshots.current(self.spark, self.root)

    def change(self, new: Callable[[Snapshot], Snapshot]) -> None:
        with self._changing:
            after = new(self.snapshot())
            if self._draft is None:
                snapshots.publish(self.spark, self.root, after)
            else:
                self._draft = after

    def publish(self) -> None:
        """Let what a draft has become take the place of what is published."""
        snapshots.publish(self.spark, self.root, self._draft)
        self._draft = None

    def clean_up(self) -> list[str]:
        return snapshots.clean_up(self.spark, self.root)

    def path(self, dataset: str, version: str | None = None) -> str:
        base = f"{self.root}/{dataset}"
        return base if version is None else f"{base}/{VERSION}{version}"

    @property
    def lake_path(self) -> str:
        return self.path(snapshots.LAKE)

    def batches(self) -> list[str]:
        return sorted(self.snapshot().reviews)

    def pending(self) -> list[str]:
        """Batches that the lake does not have as they are now."""
        return self.snapshot().pending()

    def raw_bytes(self) -> int:
        return sum(self.snapshot().raw_bytes.values())

    def places(self) -> DataFrame:
        version = self.snapshot().places
        if version is None:
            raise ValueError(f"no run has published places below {self.root!r}")
        return self.records(snapshots.PLACES, PLACES, [version])

    def versions(self, dataset: str, fields: Fields, versions: Iterable[str]) -> DataFrame:
        return read_folders(self.spark, self.path(dataset), (f"{VERSION}{v}" for v in versions), fields)

    def records(self, dataset: str, fields: Fields, versions: Iterable[str]) -> DataFrame:
        """Prepared records; the folders of rejects are not opened."""
        whole = self.versions(dataset, (*fields, KIND), versions)
        return whole.filter(F.col("kind") == RECORDS).drop("kind")

    def rejects(self, dataset: str = snapshots.REVIEWS) -> DataFrame:
        """Lines of the live batches (or of the places) that are not records, with the reason."""
        now = self.snapshot()
        live = [now.places] * bool(now.places) if dataset == snapshots.PLACES else now.reviews.values()
        whole = self.versions(dataset, (*REJECT, KIND), live)
        return whole.filter(F.col("kind") == REJECTS).drop("kind")

    def _write_records(self, df: DataFrame, fields: Fields, path: str) -> None:
        """Records, and rejects if ``df`` has them, in folders of their own, in one job."""
        if not set(names(REJECT)) <= set(df.columns):
            df = df.withColumns({name: F.lit(None).cast(type_) for name, type_ in REJECT})
        kind = F.when(F.col(names(REJECT)[1]).isNull(), RECORDS).otherwise(REJECTS)
        whole = conform(df, (*fields, *REJECT)).withColumn("kind", kind)
        whole.write.mode("overwrite").partitionBy("kind").parquet(path)

    def reviews(self, versions: Iterable[str] | None = None) -> DataFrame:
        live = self.snapshot().reviews.values() if versions is None else versions
        return self.records(snapshots.REVIEWS, REVIEW_FEATURES, live)

    def totals(self, versions: Iterable[str] | None = None) -> DataFrame:
        live = self.snapshot().states.values() if versions is None else versions
        return self.versions(snapshots.TOTALS, USER_TOTALS, live)

    def counts(self, versions: Iterable[str] | None = None) -> DataFrame:
        live = self.snapshot().states.values() if versions is None else versions
        return self.versions(snapshots.COUNTS, CATEGORY_COUNTS, live)

    def averages(self) -> DataFrame:
        return user_averages(merge_totals(self.totals()))

    def category_counts(self) -> DataFrame:
        return merge_counts(self.counts())

    def build_lake(self, ws: Workspace, min_reviews: int = MIN_REVIEWS) -> DataFrame:
        """The lake of all batches, not written yet."""
        inputs = self.lake_inputs(ws)
        return build_lake(
            self.reviews(), self.places(), inputs["averages"], inputs["counts"], min_reviews
        )

    def lake_inputs(self, ws: Workspace) -> dict[str, DataFrame]:
        """Averages and counts of all batches, written."""
        return ws.write_all({"averages": self.averages(), "counts": self.category_counts()})

    def write_lake(
        self,
        ws: Workspace,
        min_reviews: int = MIN_REVIEWS,
        inputs: dict[str, DataFrame] | None = None,
    ) -> None:
        """Compute the lake of all batches once and write it."""
        inputs = inputs or self.lake_inputs(ws)
        counts = inputs["counts"]
        lake = build_lake(self.reviews(), self.places(), inputs["averages"], counts, min_reviews)
        folders = self.write_folders(lake, counts.filter(F.col("num_reviews") > min_reviews))
        self.change(lambda s: replace(s, lake=folders, in_lake=dict(s.states)))

    def write_folders(
        self, lake: DataFrame, counts: DataFrame, write: Callable = write_partitioned
    ) -> dict[str, str]:
        """Write lake rows under a new version; the folders made, which are not live yet."""
        version = new_version()
        path = self.path(snapshots.LAKE, version)
        write(lake, path, counts)
        return {name: version for name in children(self.spark, path) if "=" in name}

    def lake(self, folders: dict[str, str] | None = None, fields: Fields = LAKE) -> DataFrame:
        """The published rows, or those of other ``folders`` (with their versions)."""
        live = self.snapshot().lake if folders is None else folders
        below = (f"{VERSION}{version}/{folder}" for folder, version in live.items())
        return read_folders(self.spark, self.lake_path, below, fields)

    def lake_values(self, folders: dict[str, str] | None = None) -> DataFrame:
        """The lake with each row's own category, null or '', as ``categoryValue``."""
        return self.lake(folders, LAKE_VALUES)

    def write_places(self, places: DataFrame) -> None:
        version = new_version()
        self._write_records(places, PLACES, self.path(snapshots.PLACES, version))
        self.change(lambda s: replace(s, places=version))

    def stage_reviews(self, features: DataFrame) -> str:
        """Write the reviews of a batch under a version that is not live yet; returns it."""
        version = new_version()
        self._write_records(features, REVIEW_FEATURES, self.path(snapshots.REVIEWS, version))
        return version

    def drop_staged(self, version: str) -> None:
        remove(self.spark, self.path(snapshots.REVIEWS, version))

    def publish_reviews(self, batch: str, version: str, first: bool) -> None:
        """``first`` starts the reviews anew; otherwise the other batches stay."""

        def with_batch(s: Snapshot) -> Snapshot:
            if first:
                return replace(s, reviews={batch: version}, states={}, raw_bytes={})
            return replace(s, reviews={**s.reviews, batch: version})

        self.change(with_batch)

    def write_reviews(self, features: DataFrame, batch: str, first: bool) -> None:
        self.publish_reviews(batch, self.stage_reviews(features), first)

    def write_states(self, batch: str, first: bool, raw_bytes: int = 0) -> None:
        """What the written reviews of ``batch`` add to the states."""
        version = self.snapshot().reviews[batch]
        reviews = self.reviews([version])
        counts = category_counts(reviews, usa_places(self.places()))
        totals = user_totals(reviews)
        concurrently(
            self.spark,
            lambda: write_parquet(
                conform(totals, USER_TOTALS), self.path(snapshots.TOTALS, version)
            ),
            lambda: write_parquet(
                conform(counts, CATEGORY_COUNTS), self.path(snapshots.COUNTS, version)
            ),
        )
        self.change(
            lambda s: replace(
                s,
                states={**s.states, batch: version},
                raw_bytes={**s.raw_bytes, batch: raw_bytes or s.raw_bytes.get(batch, 0)},
            )
        )

    def write_missing_states(self) -> None:
        """States of batches whose run died between their reviews and their states."""
        now = self.snapshot()
        for batch, version in now.reviews.items():
            if now.states.get(batch) != version:
                self.write_states(batch, first=False)

    def write_batch(
        self, features: DataFrame, batch: str, first: bool, raw_bytes: int = 0
    ) -> None:
        self.write_reviews(features, batch, first)
        self.write_states(batch, first, raw_bytes)

    def withdraw(self, batch: str) -> None:
        """Take a batch out of the reviews and the states; the lake has to catch up."""

        def without(batches: dict) -> dict:
            return {b: v for b, v in batches.items() if b != batch}

        if batch not in self.snapshot().reviews:
            raise ValueError(f"no batch {batch!r}")
        self.change(
            lambda s: replace(
                s, reviews=without(s.reviews), states=without(s.states), raw_bytes=without(s.raw_bytes)
            )
        )
