"""Periodic runs of words, by scale-tiled distribution.

A run is a stretch of consecutive words with smallest period q that is at least six words
and four periods long, and that no neighbouring word extends while it keeps that period.

Periods are taken by octaves [2^k, 2^(k+1)). A document is exploded into overlapping tiles
for each octave; the tiles of the lowest octaves are the same and solved together. In a
tile every 2^(k+1)-th word is a boundary. Every run of the octave has its first boundary
within its first 2^(k+1) words, from where the words and those q further on agree for more
than q words. Boundaries where hashes of so many words differ for all q are passed over;
at the others a Z-function of the words after the boundary tells how far period q goes on,
and one of the reversed words before it how far back. Around a boundary only a few periods
are looked at, so each octave costs time in proportion to the words, whatever they are.

That gives fragments of runs. They are merged within their task, then shuffled by document
and period and stitched: fragments of one period that share at least a period of words are
one run. Of runs that take the same words the smallest period is the run's own.

Bounds. A tile has up to 2^16 words and an eighth more for periods below 2^11, and eight
times the octave's largest period beyond; tiles overlap by four times that period, so each
run longer than the overlap leaves fragments on both sides that share a period. Documents
below 128 KiB are one tile for all their octaves and are never moved as a whole; of these
only the ones with runs are written. Tiles of longer documents are dealt over the tasks.
No group is larger than a document: the fragments of one document and period.

Odd input. Null texts, empty ones and those of white space have no words, no runs and an
empty collapsed text. Rows that repeat a doc_id, or whole rows, are documents of their own,
null doc_ids too. Only doc_id and text are read, so further columns may have any name; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewtide.llm.bpe import slices
from reviewtide.llm.common import text_or_empty
from reviewtide.session import Workspace

MIN_WORDS = 6
MIN_PERIODS = 4  # the boundaries' distance and the hash test rest on this and on MIN_WORDS
GRAM = 3

FRAGMENTS = "array<struct<period bigint, start bigint, stop bigint>>"
RUNS = "array<struct<start bigint, period bigint, length bigint>>"
_FRAGMENT = pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


@dataclass(frozen=True)
class Tiles:
    """``words`` of a tile of the lowest level, which holds the ``low_octaves``; each further
    octave is a level with tiles of twice the words."""

    words: int = 1 << 16
    low_octaves: int = 11

    def size(self, level: int) -> tuple[int, int]:
        """Words of a tile, and how many more of the next one it has."""
        return self.words << level, MIN_PERIODS << self.low_octaves + level

    def levels(self, n_words: int) -> int:
        return max(1, octaves_of(n_words) - self.low_octaves + 1)

    def octaves(self, level: int, n_words: int) -> range:
        """Those that tiles of the level are solved for."""
        low = 0 if level == 0 else self.low_octaves + level - 1
        return range(low, min(octaves_of(n_words), self.low_octaves + level))


def z_function(s: list[int]) -> list[int]:
    """For each place how many items from there on equal those at the beginning."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def word_ids(texts: Iterable[bytes]) -> list[np.ndarray]:
    """The words of each text as numbers, the same for equal words."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    return [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            for words in map(bytes.split, texts)]


class Stream:
    """Texts as numbers, one after another. Behind each stands a number that occurs once, so
    that nothing agrees across."""

    def __init__(self, texts: list[np.ndarray]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        parts = [part for k, t in enumerate(texts) for part in (t, np.array([-1 - k], np.int64))]
        self.ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.begins = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.text_of = np.repeat(np.arange(len(texts)), self.lengths + 1)
        mixed = (self.ids.astype(np.uint64) + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        self.powers = np.cumprod(np.full(len(mixed) + 1, 0x2545F4914F6CDD1D, np.uint64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * self.powers[1:])])
        self.grams = mixed.copy()
        for k in range(1, GRAM):
            self.grams[:-k] += mixed[k:] * np.uint64(0x94D049BB133111EB >> k | 1)

    def candidates(self, octave: int) -> tuple[np.ndarray, np.ndarray]:
        """Boundaries and periods of the octave for which the hashes of ``period`` + 1 words
        from the boundary on and from a period later agree."""
        half = 1 << octave
        step = 2 * half
        at = np.arange(0, len(self.ids), step)
        at = at[self.lengths[self.text_of[at]] >= max(MIN_WORDS, MIN_PERIODS * half)]
        if not len(at):
            return at, at
        padded = np.zeros(-(-len(self.grams) // step) * step, np.uint64)
        padded[: len(self.grams)] = self.grams
        rows = padded.reshape(-1, step)[at // step]
        row, k = np.nonzero(rows[:, half:] == rows[:, :1])
        at, period = at[row], half + k
        text = self.text_of[at]
        fits = at + 2 * period + 1 <= self.begins[text] + self.lengths[text]
        at, period = at[fits], period[fits]
        here = (self.sums[at + period + 1] - self.sums[at]) * self.powers[period - 1]
        same = here == self.sums[at + 2 * period + 1] - self.sums[at + period]
        return at[same], period[same]

    def fragments(self, octaves: range) -> np.ndarray:
        """Rows of text, period, start, stop (places in the text), merged."""
        found = []
        for octave in octaves:
            step = 2 << octave
            at, period = self.candidates(octave)
            bounds = np.flatnonzero(np.diff(at, prepend=-1))
            for a, b in zip(bounds, [*bounds[1:], len(at)]):
                found += self._around(int(at[a]), period[a:b].tolist(), step)
        return merged(np.array(found, np.int64).reshape(-1, 4))

    def _around(self, at: int, periods: list[int], step: int) -> Iterator[tuple]:
        """The fragments that hold a boundary; they end where the tile around it does."""
        text = int(self.text_of[at])
        begin = int(self.begins[text])
        low = max(begin, at - step)
        high = min(begin + int(self.lengths[text]), at + 3 * step)
        after = self.ids[at:high].tolist()
        forward = z_function(after)
        edge = min(at + step, high)
        before = self.ids[low:at][::-1].tolist()
        backward = z_function([*before, -1, *self.ids[low:edge][::-1].tolist()]) if before else []
        for q in periods:
            if forward[q] > q:  # else the hashes have agreed by chance
                back = backward[len(before) + 1 + edge - at - q] if before else 0
                yield text, q, at - back - begin, at + q + forward[q] - begin


def merged(rows: np.ndarray) -> np.ndarray:
    """Fragments (text, period, start, stop) of the same text and period that share at least a
    period of words, as one."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    text, period, start, stop = rows.T
    same = (np.diff(text, prepend=-1) == 0) & (np.diff(period, prepend=-1) == 0)
    group = np.cumsum(~same)
    far = int(stop.max()) + 1
    reach = np.maximum.accumulate(group * far + stop) - group * far
    joins = same.copy()
    joins[1:] &= start[1:] <= reach[:-1] - period[1:]
    first = np.flatnonzero(~joins)
    return np.stack([text[first], period[first], start[first], np.maximum.reduceat(stop, first)], 1)


def long_enough(rows: np.ndarray) -> np.ndarray:
    return rows[:, 3] - rows[:, 2] >= np.maximum(MIN_WORDS, MIN_PERIODS * rows[:, 1])


def octaves_of(n_words: int) -> int:
    """The number of octaves whose periods fit four times."""
    return max(0, (n_words // MIN_PERIODS).bit_length())


def _binary(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _lists(texts: int, rows: np.ndarray) -> pa.Array:
    """Fragments by text as an Arrow column; ``rows`` are in order of their text."""
    offsets = np.searchsorted(rows[:, 0], np.arange(texts + 1)).astype(np.int32)
    structs = pa.StructArray.from_arrays([pa.array(c) for c in rows[:, 1:].T], fields=list(_FRAGMENT))
    return pa.ListArray.from_arrays(offsets, structs)


def _solved(texts: list[bytes]) -> tuple[list[int], np.ndarray]:
    """Numbers of words and all runs (whatever their smallest period) of whole texts."""
    stream = Stream(word_ids(texts))
    longest = int(stream.lengths.max()) if len(texts) else 0
    rows = stream.fragments(range(octaves_of(longest)))
    return stream.lengths.tolist(), rows[long_enough(rows)]


def periodic(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts that have runs, with these."""
    for batch in slices(batches):
        _, rows = _solved(_binary(batch.column("text")))
        texts = np.unique(rows[:, 0])
        if len(texts):
            rows[:, 0] = np.searchsorted(texts, rows[:, 0])
            columns = [*batch.take(pa.array(texts)).columns, _lists(len(texts), rows)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "fragments"])


def aperiodic(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts that have none, in the form of :func:`collapsed`."""
    for batch in slices(batches):
        texts = _binary(batch.column("text"))
        lengths, rows = _solved(texts)
        rest = np.setdiff1d(np.arange(len(texts)), rows[:, 0])
        columns = [
            batch.column("doc_id").take(pa.array(rest)),
            pa.array([lengths[k] for k in rest], pa.int64()),
            pa.array([[] for _ in rest], _runs_type()),
            pa.array([b" ".join(texts[k].split()).decode() for k in rest], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def _runs_type() -> pa.DataType:
    fields = [("start", pa.int64()), ("period", pa.int64()), ("length", pa.int64())]
    return pa.list_(pa.struct(fields))


def cut(batches: Iterable[pa.RecordBatch], tiles: Tiles = Tiles()) -> Iterator[pa.RecordBatch]:
    """The tiles of long texts, one a batch: row, level, at, the number of words of the text, and
    the tile's words."""
    names = ["row", "level", "at", "n_words", "words"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
            words = text.as_py().encode().split()
            n = len(words)
            for level in range(tiles.levels(n)):
                length, overlap = tiles.size(level)
                for at in range(0, max(n, 1), length):
                    stop = min(n, at + length + overlap)
                    values = (row, level, at, n, b" ".join(words[at:stop]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], k) for v, k in zip(values, kinds)], names
                    )
                    if stop == n:
                        break


def solve_tiles(
    batches: Iterable[pa.RecordBatch], tiles: Tiles = Tiles()
) -> Iterator[pa.RecordBatch]:
    """The fragments of tiles: those at a cut whatever their length, as they may go on there."""
    for batch in batches:
        for tile in range(batch.num_rows):
            row, level, at, n_words, words = (c[tile].as_py() for c in batch.columns)
            stream = Stream(word_ids([words]))
            n = int(stream.lengths[0])
            rows = stream.fragments(tiles.octaves(level, n))
            at_cut = (rows[:, 2] == 0) & (at > 0) | (rows[:, 3] == n) & (at + n < n_words)
            rows = rows[at_cut | long_enough(rows)]
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), row, np.int64)), pa.array(rows[:, 1]),
                     pa.array(rows[:, 2] + at), pa.array(rows[:, 3] + at)],
                    ["row", "period", "start", "stop"],
                )


def stitched(fragments: DataFrame) -> DataFrame:
    """Per row and run: start, length, period."""
    order = Window.partitionBy("row", "period").orderBy("start", "stop")
    earlier = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("start") > earlier - F.col("period"), F.lit(True))
    whole = (
        fragments.withColumn("apart", apart.cast("int"))
        .withColumn("part", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "period", "part")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    )
    length = F.col("stop") - F.col("start")
    least = F.greatest(F.lit(MIN_WORDS), MIN_PERIODS * F.col("period"))
    return (
        whole.filter(length >= least)
        .groupBy("row", "start", "stop")
        .agg(F.min("period").alias("period"))
        .select("row", "start", "period", length.alias("length"))
    )


def collapsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_words, runs, and the words left when each run keeps its first period alone."""
    for batch in slices(batches):
        lengths, texts = [], []
        runs = batch.column("runs").to_pylist()
        for text, found in zip(_binary(batch.column("text")), runs):
            words = text.split()
            covered = np.zeros(len(words) + 1, np.int64)
            for run in found:
                covered[run["start"] + run["period"]] += 1
                covered[run["start"] + run["length"]] -= 1
            kept = np.flatnonzero(np.cumsum(covered[:-1]) == 0).tolist()
            lengths.append(len(words))
            texts.append(b" ".join(map(words.__getitem__, kept)).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lengths, pa.int64()),
             pa.array(runs, _runs_type()), pa.array(texts, pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"],
        )


def collapse_runs(docs: DataFrame, ws: Workspace, sizes: Tiles = Tiles()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (in order of start and period), collapsed.

    ``collapsed`` has the words that are in no run after the run's first period, joined by
    one space.
    """
    plain = docs.select("doc_id", text_or_empty().alias("text"))
    is_long = F.octet_length("text") >= 2 * sizes.words
    columns = f"doc_id {dict(docs.dtypes)['doc_id']}"
    short = plain.filter(~is_long)
    with_runs = short.mapInArrow(periodic, f"{columns}, text string, fragments {FRAGMENTS}")
    tables = ws.write_all({
        "periodic": with_runs.withColumn("row", F.monotonically_increasing_id()),
        "long": plain.filter(is_long).withColumn("row", -1 - F.monotonically_increasing_id()),
    })
    tiles = (
        tables["long"].select("row", "text")
        .mapInArrow(partial(cut, tiles=sizes), "row bigint, level int, at bigint, n_words bigint, words binary")
        .repartition("row", "level", "at")
    )
    fragments = (
        tables["periodic"].select("row", F.inline("fragments"))
        .unionByName(tiles.mapInArrow(
            partial(solve_tiles, tiles=sizes), "row bigint, period bigint, start bigint, stop bigint"
        ))
    )
    of_row = stitched(fragments).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    )
    texts = tables["periodic"].drop("fragments").unionByName(tables["long"])
    none = F.array().cast(RUNS)
    found = texts.join(of_row, "row", "left").select(
        "doc_id", "text", F.coalesce("runs", none).alias("runs")
    )
    result = f"{columns}, n_words bigint, runs {RUNS}, collapsed string"
    return found.mapInArrow(collapsed, result).unionByName(short.mapInArrow(aperiodic, result))


def longest(runs: str = "runs") -> Column:
    """The longest run; of equal ones that of smallest start, then period. Null if none."""
    ordered = F.transform(
        runs, lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"], r.alias("run"))
    )
    return F.array_max(ordered)["run"]
