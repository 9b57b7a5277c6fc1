"""Removing repeated passages by a distributed merge sort of suffixes.

Bytes that lie in a string of ``LENGTH`` bytes which also starts elsewhere are removed.
Not all suffixes need to be sorted for that. Anchors, the positions whose hash is the
smallest in some window of ``WINDOW``, depend on the text around them alone, so two
equal strings have their anchors at the same places, the first within ``REACH`` bytes.
Around an anchor, the repeated strings of which it is the first anchor are known from
how far its text goes on like that of another anchor, to the right and to the left.

1. Anchors whose next ``SURE`` bytes occur once only are left out; a hash tells.
2. Tasks sort the others by their text to the right, then to the left (read backwards),
   count equal ones, and send the sorted runs front-coded: what each shares with the one
   before, and the rest. Those that share ``SURE`` bytes go to one place.
3. There a loser tree merges the runs, comparing no prefix that is known to be equal,
   and tells what neighbours share; from that follows for each how far the bytes around
   it are repeated.
4. The documents get the spans around their anchors and lose them.

Strings are judged on the input; an anchor whose text occurs in one document twice counts
like one of two documents. Anchors are counted by the hash of their next ``SURE`` bytes. Of
a hash with more than ``MANY`` (a passage in a large part of all documents) equal texts become
one row before any go to a place; if more than ``MANY`` different ones are left, none does:
their strings are told apart by 128-bit hashes of all positions around the anchors,
counted by a grouped aggregate.

Null texts count as empty. Rows that share a doc_id count as documents each; they share
their spans, which are then removed from each as far as it goes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.llm.bpe import slices
from reviewtide.llm.loser_tree import common, front_coded, merge
from reviewtide.operators.sizing import checked_broadcast
from reviewtide.session import Workspace

LENGTH = 200
WINDOW = 100
GRAM = 16
REACH = WINDOW - 1  # bytes before the first anchor of a repeated string, at most
SURE = LENGTH - REACH  # bytes after it, at least
END = b"\xff"  # no byte of UTF-8: a text's end
RUN_CONTEXTS = 100_000  # a task sorts so many at once
PLACE_CONTEXTS = 50_000  # a task merges so many, about
MANY = 20_000
_FACTOR = np.array([0x9E3779B97F4A7C15], np.uint64)


def _doubled(hashes: np.ndarray, n: int, factor: int) -> np.ndarray:
    """Hashes of 2n bytes from those of n; ``factor`` is that of n bytes."""
    return hashes[:-n] * np.array([factor], np.uint64) + hashes[n:]


def _slid(values: np.ndarray, n: int, best) -> np.ndarray:
    """The best value of each ``n`` in a row."""
    width = 1
    while 2 * width <= n:
        values = best(values[:-width], values[width:])
        width *= 2
    return best(values[: len(values) - (n - width)], values[n - width :]) if n > width else values


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of a text, and a hash of the ``SURE`` bytes from there."""
    none = np.empty(0, np.int32), np.empty(0, np.int64)
    if len(text) < LENGTH:
        return none
    hashes = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    factor, n = 0x100000001B3, 1
    while n < GRAM:
        hashes = _doubled(hashes, n, factor)
        factor, n = factor * factor % (1 << 64), 2 * n
    ranks = (hashes ^ (hashes >> np.uint64(31))) * _FACTOR
    ranks ^= ranks >> np.uint64(29)
    lowest = _slid(ranks, WINDOW, np.minimum)
    pad = np.zeros(WINDOW - 1, np.uint64)
    is_lowest = ranks == _slid(np.concatenate([pad, lowest, pad]), WINDOW, np.maximum)
    at = np.flatnonzero(is_lowest[: len(text) - SURE + 1])
    while 2 * n <= SURE:
        hashes = _doubled(hashes, n, factor)
        factor, n = factor * factor % (1 << 64), 2 * n
    keys = (hashes[at] * _FACTOR + hashes[at + SURE - n]) * _FACTOR
    return at.astype(np.int32), (keys ^ (keys >> np.uint64(32))).view(np.int64)


def context(text: bytes, at: int) -> bytes:
    """The text to the right of an anchor, then that to its left read backwards."""
    right = text[at : at + LENGTH]
    left = text[max(0, at - REACH) : at][::-1]
    return right + left if len(right) == LENGTH else right + END + left


def right_length(context_: bytes) -> int:
    end = context_.find(END, 0, LENGTH)
    return LENGTH if end < 0 else end


def left_of(context_: bytes, right: int) -> bytes:
    return context_[right:] if right == LENGTH else context_[right + 1 :]


def scan(docs: DataFrame) -> DataFrame:
    """Per document doc_id, at (its anchors) and keys."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [anchors(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            offsets = np.cumsum([0, *(len(at) for at, _ in found)], dtype=np.int32)
            lists = [
                pa.ListArray.from_arrays(offsets, np.concatenate([f[k] for f in found])) for k in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "at", "keys"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id bigint, at array<int>, keys array<bigint>")


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    """(doc_id, position, context) of the anchors listed with the documents."""
    for batch in slices(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for text, doc_id, at in zip(texts, batch.column("doc_id").to_pylist(), batch.column("at").to_pylist()):
            text = text or b""
            for p in at:
                if p + SURE <= len(text):
                    yield doc_id, p, context(text, p)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, int]]:
    for batch in slices(batches):
        yield from zip(batch.column("context").to_pylist(), batch.column("n").to_pylist())


def counted_contexts(texts: DataFrame) -> DataFrame:
    """Per different context: key (a hash of its first ``SURE`` bytes), context, n."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [c for _, _, c in _contexts([batch])]
            keys = np.array([xxhash.xxh64_intdigest(c[:SURE]) for c in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(found, pa.binary())], ["key", "context"])

    each = texts.mapInArrow(task, "key bigint, context binary")
    return each.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"))


RUNS = "place int, run bigint, shared binary, lengths binary, counts binary, rests binary"


def sorted_runs(texts: DataFrame, places: int) -> DataFrame:
    """Sorted runs of contexts, front-coded: a row for each place and run (schema ``RUNS``).

    ``texts``: documents with their anchors (at), or rows of context and n.
    """
    known = "context" in texts.columns

    def rows(run: int, contexts: list[tuple[int, bytes, int]]) -> Iterator[dict]:
        contexts.sort()
        for place, own in groupby(contexts, lambda c: c[0]):
            strings, counts = [], []
            for _, string, n in own:
                if strings and strings[-1] == string:
                    counts[-1] += n
                else:
                    strings.append(string)
                    counts.append(n)
            coded = list(front_coded(strings))
            yield {
                "place": place,
                "run": run,
                "shared": np.array([n for n, _ in coded], np.uint16).tobytes(),
                "lengths": np.array([len(rest) for _, rest in coded], np.uint16).tobytes(),
                "counts": np.array(counts, np.int64).tobytes(),
                "rests": b"".join(rest for _, rest in coded),
            }

    schema = pa.schema(
        [("place", pa.int32()), ("run", pa.int64()), *((c, pa.binary()) for c in ("shared", "lengths", "counts", "rests"))]
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, run = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            found = list(rows(run, waiting))
            for k in range(0, len(found), 64):
                yield pa.RecordBatch.from_pylist(found[k : k + 64], schema)

        each = _counted(batches) if known else ((string, 1) for _, _, string in _contexts(batches))
        for string, n in each:
            waiting.append((xxhash.xxh64_intdigest(string[:SURE]) % places, string, n))
            if len(waiting) >= RUN_CONTEXTS:
                yield from out()
                waiting, run = [], run + 1
        yield from out()

    return texts.mapInArrow(task, RUNS)


def _run(row) -> Iterator[tuple[int, bytes, int]]:
    shared, lengths = (np.frombuffer(row[c], np.uint16).tolist() for c in ("shared", "lengths"))
    at, rests = 0, row["rests"]
    for n, length, count in zip(shared, lengths, np.frombuffer(row["counts"], np.int64).tolist()):
        yield n, rests[at : at + length], count
        at += length


def _reaches(members: list[bytes], counts: list[int], shared: list[int]) -> Iterator[tuple[int, int, int]]:
    """(member, to the left, to the right): how far repeated bytes reach around each anchor.

    ``members`` share ``SURE`` bytes and are sorted; ``shared``: each with the one before.
    Another anchor counts if what both share to the left and to the right is ``LENGTH``
    bytes together. For every number of bytes shared to the right, those who share as
    many are sorted by their left, so that neighbours share the most.
    """
    rights = [right_length(m) for m in members]
    lefts = [left_of(m, r) for m, r in zip(members, rights)]
    if len(members) == 1:
        if counts[0] > 1 and len(lefts[0]) + rights[0] >= LENGTH:
            yield 0, len(lefts[0]), rights[0]
        return
    with_last = [0, *(min(s, r) for s, r in zip(shared[1:], rights[1:]))]
    own = {r for r, count in zip(rights, counts) if count > 1}
    reach = [[-1, -1] for _ in members]
    for right in sorted({min(x, LENGTH) for x in with_last[1:]} | own, reverse=True):
        start = 0
        for end in range(1, len(members) + 1):
            if end < len(members) and with_last[end] >= right:
                continue
            group = [i for i in range(start, end) if rights[i] >= right]
            start = end
            if len(group) == 1 and counts[group[0]] == 1:
                continue
            group.sort(key=lambda i: lefts[i])
            most = {i: len(lefts[i]) if counts[i] > 1 else -1 for i in group}
            for i, j in zip(group, group[1:]):
                n = common(lefts[i], lefts[j])
                most[i], most[j] = max(most[i], n), max(most[j], n)
            for i in group:
                if most[i] >= max(0, LENGTH - right):
                    reach[i] = [max(reach[i][0], most[i]), max(reach[i][1], right)]
    for i, (left, right) in enumerate(reach):
        if right >= 0:
            yield i, left, right


def _digest(string: bytes) -> tuple[int, int]:
    a, b = np.frombuffer(xxhash.xxh3_128_digest(string), np.int64).tolist()
    return a, b


REACHES = "c1 bigint, c2 bigint, to_left int, to_right int"


def merged_reaches(runs: DataFrame) -> DataFrame:
    """Per context (c1, c2: its hash) how far repeated bytes reach around its anchors."""

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        members: list[bytes] = []
        counts: list[int] = []
        shared: list[int] = []

        def close() -> None:
            for i, left, right in _reaches(members, counts, shared):
                found.append((*_digest(members[i]), left, right))

        for n, string, count in merge([_run(row) for row in rows.to_dict("records")]):
            if members and n == len(string) == len(members[-1]):
                counts[-1] += count
                continue
            if n < SURE and members:
                close()
                members, counts, shared = [], [], []
            members.append(string)
            counts.append(count)
            shared.append(n)
        if members:
            close()
        return pd.DataFrame(found, columns=["c1", "c2", "to_left", "to_right"])

    return runs.groupBy("place").applyInPandas(task, REACHES)


def crowd_reaches(crowd: DataFrame, ws: Workspace) -> DataFrame:
    """The same (c1, c2, to_left, to_right) of different contexts (context, n), by hashes.

    A row for each string. All strings of a context hold its anchor, so the farthest ends
    of the repeated ones are the ends of what they cover.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["c1", "c2", "to_left", "s1", "s2", "n"]
        for batch in slices(batches):
            rows = []
            for string, count in _counted([batch]):
                c1, c2 = _digest(string)
                right = right_length(string)
                left = left_of(string, right)
                whole = left[::-1] + string[:right]
                for n in range(max(0, LENGTH - right), len(left) + 1):
                    start = len(left) - n
                    rows.append((c1, c2, n, *_digest(whole[start : start + LENGTH]), count))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    strings = crowd.select("context", "n").mapInArrow(
        task, "c1 bigint, c2 bigint, to_left bigint, s1 bigint, s2 bigint, n bigint"
    )
    # The same string before different offsets is of different anchors: offset belongs to it.
    several = strings.groupBy("s1", "s2", "to_left").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    # Written, so that both sides of the join are shuffled for it and a hot string can be split.
    return (
        strings.join(ws.write(several, "several"), ["s1", "s2", "to_left"], "left_semi")
        .groupBy("c1", "c2")
        .agg(F.max("to_left").alias("to_left"), F.min("to_left").alias("least"))
        .select("c1", "c2", F.col("to_left").cast("int"), (F.lit(LENGTH) - F.col("least")).cast("int").alias("to_right"))
    )


def context_hashes(texts: DataFrame) -> DataFrame:
    """Per anchor doc_id, at, c1, c2."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(d, p, *_digest(c)) for d, p, c in _contexts([batch])]
            columns = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "at", "c1", "c2"])

    return texts.mapInArrow(task, "doc_id bigint, at int, c1 bigint, c2 bigint")


def _merged(spans: Iterable[tuple[int, int]], n: int | None = None) -> list[tuple[int, int]]:
    """The spans joined where they meet, and cut at ``n``."""
    found: list[list[int]] = []
    for a, b in sorted(spans):
        b = b if n is None else min(b, n)
        if found and a <= found[-1][1]:
            found[-1][1] = max(found[-1][1], b)
        elif a < b:
            found.append([a, b])
    return [(a, b) for a, b in found]


def joined_spans(spans: DataFrame) -> DataFrame:
    """Lists of (a, b) made as short as they can be."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lists = [_merged((s["a"], s["b"]) for s in row) for row in batch.column("spans").to_pylist()]
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            short = pa.array([[{"a": a, "b": b} for a, b in x] for x in lists], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), short], ["doc_id", "spans"])

    return spans.mapInArrow(task, "doc_id bigint, spans array<struct<a int, b int>>")


def without_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``spans``) as doc_id, n_bytes, n_removed, n_spans, kept (bytes)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        for batch in slices(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            sizes, removed, n_spans, kept = [], [], [], []
            for text, spans in zip(texts, batch.column("spans").to_pylist()):
                text = text or b""
                spans = _merged(((x["a"], x["b"]) for x in spans or []), len(text))
                ends = [0, *(b for _, b in spans)]
                starts = [*(a for a, _ in spans), len(text)]
                rest = b"".join(text[a:b] for a, b in zip(ends, starts))
                sizes.append(len(text))
                removed.append(len(text) - len(rest))
                n_spans.append(len(spans))
                kept.append(rest)
            numbers = [pa.array(x, pa.int64()) for x in (sizes, removed, n_spans)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *numbers, pa.array(kept, pa.binary())], names)

    return docs.mapInArrow(
        task, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def remove_repeats(docs: DataFrame, ws: Workspace, many: int = MANY) -> DataFrame:
    """Per document doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay)."""
    docs = docs.select("doc_id", "text")
    scanned = ws.write(scan(docs).filter("size(at) > 0"), "anchors")
    each = scanned.select("doc_id", F.arrays_zip("at", "keys").alias("z")).select(
        "doc_id", F.explode("z").alias("z")
    ).select("doc_id", "z.at", F.col("z.keys").alias("key"))
    counted = ws.write(each.groupBy("key").count().filter("count > 1"), "repeated_keys")

    def listed(keys: DataFrame, name: str) -> DataFrame:
        own = each.join(checked_broadcast(keys.select("key")), "key", "left_semi")
        return ws.write(own.groupBy("doc_id").agg(F.collect_list("at").alias("at")), name)

    def with_texts(listed: DataFrame) -> DataFrame:
        own = checked_broadcast(listed)
        return docs.join(own, docs["doc_id"].eqNullSafe(own["doc_id"])).select(docs["doc_id"], "text", "at")

    few = listed(counted, "listed")
    texts = with_texts(few)
    frequent = counted.filter(F.col("count") > many)
    partitions = int(ws.spark.conf.get("spark.sql.shuffle.partitions"))

    def places(n: int) -> int:
        return max(partitions, -(-n // PLACE_CONTEXTS))

    def anchors_of(listed: DataFrame) -> int:
        return listed.agg(F.coalesce(F.sum(F.size("at")), F.lit(0))).first()[0]

    if frequent.isEmpty():
        known = ws.write(merged_reaches(sorted_runs(texts, places(anchors_of(few)))), "reaches")
    else:
        few = listed(counted.filter(F.col("count") <= many), "listed_few")
        contexts = ws.write(counted_contexts(with_texts(listed(frequent, "listed_frequent"))), "contexts")
        crowded = ws.write(contexts.groupBy("key").count().filter(F.col("count") > many).select("key"), "crowded")
        keys = checked_broadcast(crowded)
        held = contexts.join(keys, "key", "left_anti").select("context", "n")
        n = places(anchors_of(few) + held.count())
        runs = sorted_runs(with_texts(few), n).unionByName(sorted_runs(held, n))
        known = ws.write(merged_reaches(runs), "reaches")
        if not crowded.isEmpty():
            known = known.unionByName(crowd_reaches(contexts.join(keys, "key", "left_semi"), ws))
    span = F.struct((F.col("at") - F.col("to_left")).alias("a"), (F.col("at") + F.col("to_right")).alias("b"))
    around = context_hashes(texts).join(known, ["c1", "c2"])
    spans = joined_spans(around.groupBy("doc_id").agg(F.collect_list(span).alias("spans")))
    spans = checked_broadcast(ws.write(spans, "spans"))
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(spans["doc_id"]), "left")
    return without_spans(joined.select(docs["doc_id"], "text", "spans"))
