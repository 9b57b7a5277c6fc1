"""Sharding by a minimax contiguous partition.

Rows of equal texts form an atomic group. The groups are put in the order of the hash
of their text and cut into as many contiguous runs as there are shards, so that the
largest run is as small as it can be: a binary search finds the smallest capacity for
which greedy filling needs no more shards than allowed. Within that capacity each shard
is then filled to its share of what remains, so that sizes are near equal.

The search looks at sums over leaves, ranges of the hash, of which there are a bounded
number; a leaf that a cut falls into, and that holds several groups, is split into its
256 parts, until every cut falls between two groups. So the result is that of a search
over all groups, while neither the driver nor a task ever holds them. A row's shard
follows from its hash and the cuts alone.

Null texts have size 1 and are a group with the empty ones. Repeated rows and null
doc_ids are rows like others. A group larger than a shard's share fills a shard alone.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewtide.llm.common import text_or_empty
from reviewtide.session import Workspace

FIRST_DIGITS = 3  # leaves at first: 4096 ranges of the hash
MORE_DIGITS = 2  # a split makes 256 of one
BLOCKS = 1024  # of a shard, for numbering its rows


@dataclass(frozen=True)
class Leaf:
    """A range of the hash: its leading digits, the bytes and the groups in it."""

    prefix: str
    size: int
    groups: int


class Cutter:
    """Cuts at leaf borders, and the leaves that have to be split before cuts are exact."""

    def __init__(self, leaves: list[Leaf], shards: int):
        self.leaves, self.shards = leaves, shards
        self.ends = list(accumulate(leaf.size for leaf in leaves))
        self.total = self.ends[-1] if leaves else 0
        self.largest = sorted(((x.size, k) for k, x in enumerate(leaves)), reverse=True)[:shards]
        self.split: set[str] = set()

    def _fill(self, start: int, capacity: int) -> int:
        """The leaf after the last one that fits into a shard beginning with leaf ``start``."""
        before = self.ends[start - 1] if start else 0
        end = bisect_right(self.ends, before + capacity)
        if end < len(self.leaves) and self.ends[end - 1 if end else 0] != before + capacity:
            if self.leaves[end].groups > 1:
                self.split.add(self.leaves[end].prefix)
        return end

    def feasible(self, capacity: int, start: int = 0, shards: int | None = None) -> bool:
        for _ in range(self.shards if shards is None else shards):
            if start == len(self.leaves):
                break
            start = self._fill(start, capacity)
        return start == len(self.leaves)

    def capacity(self) -> int:
        low = max(-(-self.total // self.shards), max((x.size for x in self.leaves if x.groups == 1), default=0))
        high = max(low, -(-self.total // self.shards) + max((x.size for x in self.leaves), default=0))
        while low < high:
            middle = (low + high) // 2
            if self.feasible(middle):
                high = middle
            else:
                low = middle + 1
        return low

    def _share(self, start: int, left: int) -> int:
        """What each of ``left`` shards gets of the leaves from ``start``, where groups larger
        than that have shards of their own."""
        rest = self.total - (self.ends[start - 1] if start else 0)
        for size, at in self.largest:
            if at >= start and left > 1 and size * left > rest:
                rest, left = rest - size, left - 1
        return -(-rest // left)

    def cuts(self) -> list[int]:
        """The first leaf of each shard but the first."""
        capacity, start, cuts = self.capacity(), 0, []
        for shard in range(self.shards - 1):
            before = self.ends[start - 1] if start else 0
            left = self.shards - shard
            most = self._fill(start, capacity)
            share = self._share(start, left)
            end = min(most, max(self._fill(start, share), start))
            # The share ends inside leaf ``end``: take it too if it fits, so that less remains.
            if end < most and (self.ends[end - 1] if end else 0) - before < share:
                end += 1
            if not self.feasible(capacity, end, left - 1):
                end = most
            cuts.append(end)
            start = end
        return cuts


def _leaves(groups: DataFrame, digits: int) -> list[Leaf]:
    rows = (
        groups.groupBy(F.substring("sha", 1, digits).alias("prefix"))
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups"))
        .collect()
    )
    return [Leaf(*row) for row in rows]


def cut_points(groups: DataFrame, shards: int) -> list[str | None]:
    """For each shard but the first, the hash prefix it begins at; None: it is empty.

    ``groups``: a written table (sha, size), a row for each group.
    """
    leaves = _leaves(groups, FIRST_DIGITS)
    while True:
        leaves.sort(key=lambda leaf: leaf.prefix)
        cutter = Cutter(leaves, shards)
        cuts = cutter.cuts()
        if not cutter.split:
            return [leaves[c].prefix if c < len(leaves) else None for c in cuts]
        leaves = [leaf for leaf in leaves if leaf.prefix not in cutter.split]
        for digits in {len(prefix) for prefix in cutter.split}:
            prefixes = [p for p in cutter.split if len(p) == digits]
            inside = groups.filter(F.substring("sha", 1, digits).isin(prefixes))
            leaves += _leaves(inside, digits + MORE_DIGITS)


def shard_of(sha: Column, cuts: list[str | None]) -> Column:
    starts = [F.when(sha >= cut, 1).otherwise(0) for cut in cuts if cut is not None]
    return sum(starts, F.lit(0))


def numbered(rows: DataFrame, ws: Workspace, shards: int) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in each shard.

    Rows are numbered inside blocks of a shard, dealt by doc_id; a block begins after
    the rows of the blocks before it. ``shards`` times ``BLOCKS`` numbers are broadcast.
    """
    blocks = rows.withColumn("_block", F.pmod(F.xxhash64("doc_id", "text_sha256"), F.lit(BLOCKS)))
    counts = blocks.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", "_block").orderBy("doc_id", "text_sha256", "row")
    return (
        blocks.withColumn("_at", F.row_number().over(inside) - 1)
        .join(F.broadcast(ws.write(starts, "block_starts")), ["shard", "_block"])
        .withColumn("slot", F.col("_start") + F.col("_at"))
        .drop("_block", "_at", "_start")
    )


def shard(docs: DataFrame, ws: Workspace, shards: int = 16) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, shard, slot, text_sha256."""
    text = text_or_empty()
    rows = ws.write(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sized",
    )
    groups = ws.write(
        rows.groupBy(F.col("text_sha256").alias("sha")).agg(F.sum("size").alias("size")), "groups"
    )
    cuts = cut_points(groups, shards)
    placed = rows.withColumn("shard", shard_of(F.col("text_sha256"), cuts).cast("int"))
    return numbered(placed, ws, shards).drop("row")
