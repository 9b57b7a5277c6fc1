"""Best-fit packing of documents into sequences, by a grouping genetic algorithm on islands.

A document's ids and an end id are one piece; only documents longer than a sequence are cut,
into pieces of a sequence's size and a rest. Full pieces are sequences of their own. What is
left to pack are lengths, so a gene is a bin: the lengths that share a sequence.

The pieces are dealt to islands of bounded size. An island keeps a few groupings of its
pieces, made by best fit in different orders, and breeds: a child takes over whole
well-filled bins of the other parent (those whose lengths are still there), loses the bins
that held these pieces before, and the displaced ones are put back, longest first, each into
the bin it fits best. The child takes the place of the worst grouping if it is better.
Between epochs the islands' elites migrate: the well-filled bins of an island's best grouping
go to the next island as bins of lengths, and are one parent there, as far as that island has
pieces of these lengths.

After the last epoch most bins stay; the pieces of the least filled ones (an eighth of the bins
at most, as far as they are not filled to ``settled``) are dealt to fewer islands and bred
again, until one island has the rest. So what a partly filled bin wastes is lost once, not
once an island.

Bounds. An island has about ``island_pieces`` pieces (dealt by a hash of the row number,
whatever their lengths or texts), which is what a task holds; migrants are bins of one
island. Token ids never travel with the pieces: these are numbers, written once, and joined
to the placed pieces by their key.

Odd input. Null and empty texts have the end id alone. Rows that repeat a doc_id, or whole
rows, are documents of their own, null doc_ids too. Only doc_id and text are read, further
columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.llm.common import text_or_empty
from reviewtide.llm.wordbatch import gathered
from reviewtide.llm.wordends import spaced_ids_of
from reviewtide.session import Workspace

OPEN_SHARE = 8  # at most one bin in so many goes on to the next level
PIECES_AT_ONCE = 4096  # handed on; each has the ids of a sequence at most
MOST_ISLANDS, MOST_BINS = 1 << 32, 1 << 24  # for numbers of sequences only


@dataclass(frozen=True)
class Breeding:
    """``size`` of a sequence in tokens; ``island_pieces``: about as many pieces an island has;
    ``parents`` groupings an island keeps, ``children`` it breeds an epoch, ``epochs``; bins
    filled to ``settled`` (a share) always stay when islands are joined."""

    size: int = 4096
    island_pieces: int = 8192
    parents: int = 3
    children: int = 4
    epochs: int = 2
    settled: float = 0.998
    seed: int = 1


class Bins:
    """A grouping under way: bins by what is free in them, found by best fit."""

    def __init__(self, size: int):
        self.size = size
        self.bins: list[list[int]] = []
        self.free_of: list[int] = []
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.frees: list[int] = []  # those that some bin has, rising

    def open(self, lengths: list[int]) -> None:
        self.bins.append(lengths)
        self._shelve(len(self.bins) - 1, self.size - sum(lengths))

    def _shelve(self, k: int, free: int) -> None:
        if free:
            if not self.by_free[free]:
                insort(self.frees, free)
            self.by_free[free].append(k)

    def put(self, length: int) -> None:
        """Into the fullest bin with room for it, or a new one."""
        at = bisect_left(self.frees, length)
        if at == len(self.frees):
            self.open([length])
            return
        free = self.frees[at]
        k = self.by_free[free].pop()
        if not self.by_free[free]:
            del self.frees[at]
        self.bins[k].append(length)
        self._shelve(k, free - length)


def packed(lengths: Iterable[int], size: int, bins: Iterable[list[int]] = ()) -> list[list[int]]:
    """``bins`` with ``lengths`` put in by best fit, in their order."""
    filled = Bins(size)
    for taken in bins:
        filled.open(list(taken))
    for length in lengths:
        filled.put(length)
    return filled.bins


def fitness(bins: list[list[int]], size: int) -> tuple[int, float]:
    """Fewer bins are better; of equally many, those that are filled unevenly: the mean of the
    squared filling grows when a nearly empty bin gives to a nearly full one."""
    return -len(bins), sum((sum(b) / size) ** 2 for b in bins) / max(1, len(bins))


def child(base: list[list[int]], donor: list[list[int]], size: int, rng: random.Random) -> list[list[int]]:
    """``base`` with whole well-filled bins of ``donor``; what that displaces is put back.

    A donor's bin is taken over if its lengths are there and are not in bins taken over
    before. Bins of the base that lose a length are dissolved.
    """
    there = Counter(length for b in base for length in b)
    wanted = [b for b in donor if sum(b) >= size - (size >> 6)]
    rng.shuffle(wanted)
    taken, used = [], Counter()
    for b in wanted[: max(1, len(wanted) // 2)]:
        need = Counter(b)
        if all(used[x] + n <= there[x] for x, n in need.items()):
            taken.append(b)
            used.update(need)
    gone, kept, displaced = Counter(used), [], []
    order = sorted(base, key=sum)  # poorly filled bins give up their pieces first
    for b in order:
        if any(gone[x] for x in b):
            for x in b:
                if gone[x]:
                    gone[x] -= 1
                else:
                    displaced.append(x)
        else:
            kept.append(b)
    displaced.sort(reverse=True)
    return packed(displaced, size, [*taken, *kept])


def bred(
    population: list[list[list[int]]], donors: list[list[list[int]]], plan: Breeding, rng: random.Random
) -> list[list[int]]:
    """The best grouping after an epoch."""
    ranked = sorted(population, key=lambda p: fitness(p, plan.size), reverse=True)
    for k in range(plan.children):
        base = ranked[0] if k % 2 == 0 else rng.choice(ranked)
        donor = donors[k % len(donors)] if donors and k % 2 == 0 else rng.choice(ranked)
        new = child(base, donor, plan.size, rng)
        if fitness(new, plan.size) > fitness(ranked[-1], plan.size):
            ranked[-1] = new
            ranked.sort(key=lambda p: fitness(p, plan.size), reverse=True)
    return ranked[0]


def first_groupings(lengths: list[int], plan: Breeding, rng: random.Random) -> list[list[list[int]]]:
    """Best fit in order of length, and in orders where neighbours in length are mixed."""
    down = sorted(lengths, reverse=True)
    found = [packed(down, plan.size)]
    for k in range(1, plan.parents):
        blur = plan.size * k / 16
        found.append(packed(sorted(lengths, key=lambda x: -x + rng.uniform(0, blur)), plan.size))
    return found


def evolve(own: pd.DataFrame, migrants: pd.DataFrame, plan: Breeding, epoch: int) -> pd.DataFrame:
    """An island's pieces in the bins of its best grouping.

    ``migrants`` (length, bin) are the elite of another island. ``offset`` is a piece's place
    in its bin. ``open`` are the bins that are filled least, an eighth of all at most, as far
    as they are not filled to ``settled``.
    """
    if not len(own):
        return own
    rng = random.Random(f"{plan.seed}/{int(own['island'].iloc[0])}/{epoch}")
    own = own.sort_values(["length", "key"], kind="stable")
    lengths = own["length"].tolist()
    population = first_groupings(lengths, plan, rng)
    if (own["bin"] >= 0).all():
        population[-1] = own.groupby("bin")["length"].apply(list).tolist()
    donors = [migrants.groupby("bin")["length"].apply(list).tolist()] if len(migrants) else []
    bins = sorted(bred(population, donors, plan, rng), key=sum)
    most = max(1, len(bins) // OPEN_SHARE)
    n_open = sum(sum(b) < plan.settled * plan.size for b in bins[:most])
    places: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for k, b in enumerate(bins):
        offset = 0
        for length in b:
            places[length].append((k, offset))
            offset += length
    found = np.array([places[length].pop() for length in lengths], np.int64).reshape(-1, 2)
    return own.assign(bin=found[:, 0], offset=found[:, 1], open=found[:, 0] < n_open)


STATE = "island bigint, key bigint, length bigint, bin bigint, offset bigint, open boolean"


def _epoch(state: DataFrame, islands: int, plan: Breeding, epoch: int) -> DataFrame:
    """All islands bred once; each gets the elite of the one before it, if there are bins yet."""

    def task(own: pd.DataFrame, migrants: pd.DataFrame) -> pd.DataFrame:
        return evolve(own, migrants, plan, epoch)

    elite = state.filter("bin >= 0 and not open").select(
        ((F.col("island") + 1) % islands).alias("island"), "length", "bin"
    )
    if islands == 1 or epoch == 0:
        elite = elite.limit(0)
    return state.groupBy("island").cogroup(elite.groupBy("island")).applyInPandas(task, STATE)


def place(pieces: DataFrame, ws: Workspace, plan: Breeding = Breeding()) -> DataFrame:
    """Per piece of a written table (key, length): key, sequence_id, offset.

    Each level has half the islands of the one before at most, so there are few. Islands of
    so few bins that these hold more pieces than that have tiny pieces, less than a token
    for each place of their bins, so they stay small although they become larger.
    """
    zero = F.lit(0).cast("bigint")
    placed = pieces.filter(F.col("length") >= plan.size).select(
        "key", (-1 - F.col("key")).alias("sequence_id"), zero.alias("offset")
    )
    rest = pieces.filter(F.col("length") < plan.size).select("key", "length")
    level, islands = 0, None
    while islands != 1:
        wanted = max(1, -(-rest.count() // plan.island_pieces))
        islands = wanted if islands is None else min(wanted, max(1, islands // 2))
        state = rest.select(
            F.pmod(F.xxhash64("key", F.lit(level)), F.lit(islands)).alias("island"), "key", "length",
            F.lit(-1).cast("bigint").alias("bin"), zero.alias("offset"), F.lit(False).alias("open"),
        )
        for epoch in range(plan.epochs if islands > 1 else 1):
            state = ws.write(_epoch(state, islands, plan, epoch), "islands")
        number = (F.lit(level) * MOST_ISLANDS + F.col("island")) * MOST_BINS + F.col("bin")
        stays = F.lit(True) if islands == 1 else ~F.col("open")
        placed = placed.unionByName(
            state.filter(stays).select("key", number.alias("sequence_id"), "offset")
        )
        rest, level = state.filter("open").select("key", "length"), level + 1
    return placed


def pieces_of(docs: DataFrame, tokenizer_path: str, end_id: int, size: int) -> DataFrame:
    """Per piece of at most ``size`` tokens: doc_id, piece, start, length, ids (32-bit,
    little-endian)."""
    with open(tokenizer_path, encoding="utf-8") as file:
        description = docs.sparkSession.sparkContext.broadcast(file.read())  # of the vocabulary's size
    end = np.array([end_id], "<u4").tobytes()

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = spaced_ids_of(description.value)
        for batch in gathered(batches):
            ids, bounds = encode.batch(batch.column("text"), end)
            n = np.diff(bounds)
            cuts = -(-n // size)
            doc = np.repeat(np.arange(len(n)), cuts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start = piece * size
            length = np.minimum(size, n[doc] - start)
            edges = np.append(bounds[doc] + start, bounds[-1])
            for k in range(0, len(doc), PIECES_AT_ONCE):
                some = slice(k, k + PIECES_AT_ONCE)
                at = edges[k : k + PIECES_AT_ONCE + 1]
                here = pa.py_buffer(ids[at[0] : at[-1]])
                offsets = pa.py_buffer((4 * (at - at[0])).astype(np.int32))
                parts = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, offsets, here])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc[some])),
                     pa.array(piece[some].astype(np.int32)), pa.array(start[some]),
                     pa.array(length[some]), parts],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    plain = docs.select("doc_id", text_or_empty().alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    return plain.mapInArrow(
        task, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary"
    )


def pack(
    docs: DataFrame, ws: Workspace, tokenizer_path: str, end_id: int, plan: Breeding = Breeding()
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset (there).

    The checksum is written with the ids, so that who needs it alone does not move these.
    """
    found = pieces_of(docs, tokenizer_path, end_id, plan.size).withColumns(
        {"key": F.monotonically_increasing_id(), "ids_crc32": F.crc32("ids")}
    )
    pieces = ws.write(found, "pieces")
    placed = place(pieces.select("key", "length"), ws, plan)
    return pieces.join(placed, "key").drop("key")


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """Per sequence its ids as one binary, and its pieces in order. A sequence is bounded."""
    fields = ("offset", "doc_id", "piece", "length", "ids")
    parts = F.sort_array(F.collect_list(F.struct(*fields)))
    return (
        packed_pieces.groupBy("sequence_id").agg(parts.alias("p"))
        .select(
            "sequence_id",
            F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"),
            F.transform("p", lambda x: x.dropFields("ids")).alias("pieces"),
        )
    )
