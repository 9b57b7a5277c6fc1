"""Which written folders are the published ones.

No published file is ever overwritten. A write makes a folder for its own version; a small
file, the snapshot, then names the folders that are live, and takes effect as a whole when it
appears. Whoever reads goes by the newest snapshot, so a write that dies leaves what was
published as it was, and readers never find a gap. Folders that a newer snapshot does not name
stay until the next run begins, for those who still read them; :func:`clean_up` then removes
them, together with what a dead write has left.

One process writes at a time; any number may read. Two that write by mistake cannot both
publish the same number, so the later one fails instead of undoing the other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from reviewtide.sources.files import children, read_small, remove, write_small

PLACES, REVIEWS = "prepped/places", "prepped/reviews"
TOTALS, COUNTS = "state/user_totals", "state/category_counts"
LAKE, STAR, ROLLUP = "reviews_lake", "star", "rollup"
SNAPSHOTS = "snapshots"
VERSION = "version="


@dataclass(frozen=True)
class Star:
    """The published star tables.

    ``tables``: per table its parts, each with the versions whose files make it up; empty for
    a star that was written as a whole to the folder of ``version``. ``rows``: how many rows
    each part has. ``lake`` has the lake folders it was made from, by their version.
    """

    category: str
    scale: int
    version: str
    parts: int = 1
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    rows: dict[str, dict[str, int]] = field(default_factory=dict)
    lake: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Rollup:
    """The versions that have kept sums, and the lake folders that these are of."""

    versions: list[str] = field(default_factory=list)
    lake: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    """``reviews`` and ``states``: per batch the version that is live. ``in_lake``: the version
    of each batch that the lake has; where it differs the lake has to catch up. ``raw_bytes``:
    per batch. ``lake``: per folder its version."""

    places: str | None = None
    reviews: dict[str, str] = field(default_factory=dict)
    states: dict[str, str] = field(default_factory=dict)
    in_lake: dict[str, str] = field(default_factory=dict)
    raw_bytes: dict[str, int] = field(default_factory=dict)
    lake: dict[str, str] = field(default_factory=dict)
    star: Star | None = None
    rollup: Rollup = field(default_factory=Rollup)

    def pending(self) -> list[str]:
        """Batches that the lake does not have as they are now, or still has although they
        are withdrawn."""
        names = self.reviews.keys() | self.in_lake.keys()
        return sorted(b for b in names if self.reviews.get(b) != self.in_lake.get(b))

    def folders(self) -> Iterator[str]:
        """All folders it names, below the root."""
        if self.places:
            yield f"{PLACES}/{VERSION}{self.places}"
        for version in self.reviews.values():
            yield f"{REVIEWS}/{VERSION}{version}"
        for version in (*self.states.values(), *self.in_lake.values()):
            yield from (f"{state}/{VERSION}{version}" for state in (TOTALS, COUNTS))
        for folder, version in self.lake.items():
            yield f"{LAKE}/{VERSION}{version}/{folder}"
        for version in self.rollup.versions:
            yield f"{ROLLUP}/{VERSION}{version}"
        if self.star:
            for folder, version in self.star.lake.items():
                yield f"{LAKE}/{VERSION}{version}/{folder}"
            for table, parts in self.star.tables.items():
                for part, versions in parts.items():
                    yield from (f"{STAR}/{table}/{VERSION}{v}/{part}" for v in versions)
            if not self.star.tables:
                yield f"{STAR}/{VERSION}{self.star.version}"

    def to_text(self) -> str:
        return json.dumps(asdict(self), indent=1, sort_keys=True)

    @classmethod
    def of_text(cls, text: str) -> Snapshot:
        values = json.loads(text)
        star, rollup = values.pop("star"), values.pop("rollup")
        return cls(**values, star=Star(**star) if star else None, rollup=Rollup(**rollup))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = children(spark, f"{root}/{SNAPSHOTS}")
    return [int(name) for name in names if name.isdigit()]


def _read(spark: SparkSession, root: str, number: int) -> Snapshot:
    return Snapshot.of_text(read_small(spark, f"{root}/{SNAPSHOTS}/{number:012d}"))


def current(spark: SparkSession, root: str) -> Snapshot:
    """The published snapshot; an empty one before the first."""
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else Snapshot()


def publish(spark: SparkSession, root: str, snapshot: Snapshot) -> None:
    """Make ``snapshot`` the published one, by one small write."""
    number = ([0] + _numbers(spark, root))[-1] + 1
    write_small(spark, f"{root}/{SNAPSHOTS}/{number:012d}", snapshot.to_text())


def new_version() -> str:
    """A name for the folder of one write, which no other has used or will use."""
    return f"v{uuid.uuid4().hex}"


def clean_up(spark: SparkSession, root: str) -> list[str]:
    """Remove the folders that the published snapshot does not name, and older snapshots."""
    numbers = _numbers(spark, root)
    live = set(_read(spark, root, numbers[-1]).folders()) if numbers else set()
    inner = {folder[: folder.rindex("/")] for folder in live}
    tables = [f"{STAR}/{name}" for name in children(spark, f"{root}/{STAR}") if not name.startswith(VERSION)]
    removed = []
    for parent in (PLACES, REVIEWS, TOTALS, COUNTS, LAKE, ROLLUP, STAR, *tables):
        for name in children(spark, f"{root}/{parent}"):
            folder = f"{parent}/{name}"
            if not name.startswith(VERSION) or folder in live:
                continue
            if folder not in inner:
                removed.append(folder)
                continue
            below = (f"{folder}/{x}" for x in children(spark, f"{root}/{folder}"))
            removed += [f for f in below if "=" in f.rsplit("/", 1)[1] and f not in live]
    for folder in removed:
        remove(spark, f"{root}/{folder}")
    for number in numbers[:-1]:
        remove(spark, f"{root}/{SNAPSHOTS}/{number:012d}")
    return removed


__all__ = ["Snapshot", "Star", "clean_up", "current", "new_version", "publish", "replace"]
