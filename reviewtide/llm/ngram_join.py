"""N-gram Jaccard join by a token-group matrix.

A document is its set of word shingles. Sets that are likely similar are put into one
group (by their smallest shingle hash, large groups dealt further). For each shingle the
matrix tells the groups it occurs in; two groups are candidates if they share one of the
shingles that two linked sets must share. Of a candidate pair, the overlap of each set of
one group with the union of the other bounds its similarity, and only if the bound allows
a link the groups are opened and their sets compared.

Which shingles must be shared: a set of n shingles may lack n - ceil(t n) of them in a
set of Jaccard similarity t. So in any order of all shingles, the first n - ceil(t n) + k
of both have k in common. The order here is by rarity, as counted by a sketch of fixed
size, so that passages in many documents come last. A set that shares fewer than k of its
first shingles with all others together has no link and is left out at once. The sketch
bears on cost alone, not on the result.

Only components are asked for, so groups are first compared with the first group of
their shingles, which connects the groups of a hot family at a cost linear in their
number. The groups of a component are then brought together, and what remains are pairs of
groups not yet known to be connected; all of these are compared too. So no link between
components is lost, while the pairs inside a component are never listed. A pair is listed
about once, not for each shingle that its groups share.

Shingles are 64-bit hashes, sets are told apart by 128 bits; equal sets count once. Null
and empty texts have no shingles and no links. Rows that share a doc_id count as one
document of several texts. A null doc_id keeps a document out of all links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewtide.llm.bpe import slices
from reviewtide.llm.components import components
from reviewtide.operators.sizing import checked_broadcast
from reviewtide.session import Workspace

SLOT_BITS = 21  # the sketch: two million counters, 8 MB; compressed where it travels
MORE_PART = 20  # of a set's shingles, one in so many is looked at beyond those that may be missing
PRUNINGS = 2
GROUP_SETS = 256  # sets in a group, about
EARLY = 16  # tokens of a group that are known when it is paired with others
PARTNERS = 64  # groups that one group is compared with at once, about
COLUMNS_AT_ONCE = 4096
ROWS_PER_TASK = 2000  # sets that one task compares, about
REMEMBERED_WORDS = 150_000

# Odd multipliers that mix hashes.
MIXERS = tuple(np.array([m], np.uint64) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; sets are linked from ``percent`` on."""

    words: int = 5
    percent: int = 80

    def may_miss(self, n: int) -> int:
        """How many of its ``n`` shingles a set may have that a linked one has not."""
        return n - -(-self.percent * n // 100)

    def must_share(self, n: int) -> int:
        """How many of its first shingles it has to share with the first ones of a linked set,
        be that as small as it may."""
        return 1 + -(-self.percent * n // 100) // MORE_PART

    def first(self, n: int) -> int:
        """How many of its shingles count as the first, in any order of all shingles."""
        return self.may_miss(n) + 1 + n // MORE_PART


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: bytes | None, n: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingle hashes of a UTF-8 text, ascending."""
    words = (text or b"").lower().split()  # for bytes: A-Z, and the ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    each = np.array(list(map(hashes.__getitem__, words)), np.uint64)
    n = min(n, len(words))
    mixed = np.full(len(each) - n + 1, n, np.uint64)
    for k in range(n):
        mixed = (mixed ^ each[k : len(each) - n + 1 + k]) * MIXERS[k % 3]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _shingled(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    hashes = WordHashes()
    for batch in slices(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        yield batch.column("doc_id").to_pylist(), [shingles(t, n, hashes) for t in texts]


def _signed(values: Iterable[int]) -> pa.Array:
    return pa.array(np.fromiter(values, np.uint64).view(np.int64))


def _digests(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    both = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)
    halves = np.frombuffer(both, np.int64).reshape(-1, 2)
    return pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())


def scan(docs: DataFrame, n: int) -> DataFrame:
    """Per document doc_id, n_shingles, d1, d2 (its set), first (its smallest shingle);
    per task one more row that has a ``sketch``."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "d1", "d2", "first", "sketch"]
        sketch, waiting, size = np.zeros(1 << SLOT_BITS, np.uint32), [], 0

        def count() -> np.ndarray:
            slots = (np.concatenate(waiting) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
            return np.bincount(slots, minlength=1 << SLOT_BITS).astype(np.uint32)

        for ids, sets in _shingled(batches, n):
            d1, d2 = _digests(sets)
            columns = [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), d1, d2,
                       _signed(s[0] if len(s) else 0 for s in sets), pa.nulls(len(ids), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
            waiting += sets
            size += sum(map(len, sets))
            if size > 1 << 20:
                sketch += count()
                waiting, size = [], 0
        if waiting:
            sketch += count()
        none = [pa.nulls(1, pa.int64())] * 5
        yield pa.RecordBatch.from_arrays([*none, pa.array([_pressed(sketch)], pa.binary())], names)

    return docs.select("doc_id", "text").mapInArrow(
        task, "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, first bigint, sketch binary"
    )


def _pressed(sketch: np.ndarray) -> bytes:
    """A sketch as compressed bytes; counts stop at the largest 32-bit number."""
    counts = np.minimum(sketch, 2**32 - 1).astype(np.uint32)
    planes = counts.view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpressed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).reshape(-1)


def summed_sketch(scanned: DataFrame) -> np.ndarray:
    """How often shingles occur, by slot. Summed up in a tree; of fixed size."""
    sketches = scanned.filter("sketch IS NOT NULL").select("sketch").rdd.map(lambda row: bytes(row["sketch"]))
    return _unpressed(
        sketches.treeReduce(lambda a, b: _pressed(_unpressed(a).astype(np.uint64) + _unpressed(b)))
    )


def prefixes(docs: DataFrame, like: Similarity, sketch: np.ndarray) -> DataFrame:
    """Per document that has shingles: rep, its first shingles, rarest first, how many it must
    share, and of how many it must share one (``keys``)."""
    rarity = docs.sparkSession.sparkContext.broadcast(sketch)

    def rarest(s: np.ndarray) -> np.ndarray:
        counts = rarity.value[s >> np.uint64(64 - SLOT_BITS)]
        return s[np.lexsort((s, counts))[: like.first(len(s))]]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _shingled(batches, like.words):
            found = [(d, s) for d, s in zip(ids, sets) if len(s)]
            if not found:
                continue
            picked = [rarest(s) for _, s in found]
            offsets = np.cumsum([0, *map(len, picked)], dtype=np.int32)
            flat = np.concatenate(picked).view(np.int64)
            must = [like.must_share(len(s)) for _, s in found]
            keys = [like.may_miss(len(s)) + 1 for _, s in found]
            numbers = [pa.array(x, pa.int64()) for x in ([d for d, _ in found], must, keys)]
            yield pa.RecordBatch.from_arrays(
                [*numbers, pa.ListArray.from_arrays(offsets, flat)], ["rep", "must", "keys", "first"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        task, "rep bigint, must bigint, keys bigint, first array<bigint>"
    )


def shared_rows(rows: DataFrame) -> DataFrame:
    """The rows (rep, token, ...) whose token another set has as well."""
    owners = rows.groupBy("token").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
    return rows.join(owners.filter("low < high").select("token"), "token", "left_semi")


def whole_sets(docs: DataFrame, n: int) -> DataFrame:
    """Per document doc_id and tokens, its sorted shingles as bytes."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _shingled(batches, n):
            tokens = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), tokens], ["doc_id", "tokens"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id bigint, tokens binary")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of two lists of sets, a block of shingles at a time."""
    flat = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    column = np.cumsum(np.concatenate([[0], flat[1:] != flat[:-1]]))
    found = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, int(column[-1]) + 1, COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, [at, at + COLUMNS_AT_ONCE])
        block = np.zeros((len(left) + len(right), COLUMNS_AT_ONCE), np.float32)
        block[owner[a:b], column[a:b] - at] = 1
        found += block[: len(left)] @ block[len(left) :].T
    return found


def overlaps_union(queries: list[np.ndarray], group: list[np.ndarray]) -> np.ndarray:
    """How many shingles of each query the union of a group has."""
    union = np.unique(np.concatenate(group))
    return np.array([np.isin(q, union, assume_unique=True).sum() for q in queries])


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """All links (i, j) between two groups; only sets that the other's union allows are opened."""

    def allowed(queries: list[np.ndarray], group: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(q) for q in queries])
        return np.flatnonzero(100 * overlaps_union(queries, group) >= percent * sizes)

    rows = allowed(left, right)
    columns = allowed(right, [left[i] for i in rows]) if len(rows) else rows
    if not len(columns):
        return
    shared = overlaps([left[i] for i in rows], [right[j] for j in columns])
    sizes = [np.array([len(s[k]) for k in at]) for s, at in ((left, rows), (right, columns))]
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    for i, j in zip(*np.nonzero(100 * shared >= percent * union)):
        yield int(rows[i]), int(columns[j])


class Connected:
    """Which nodes are connected so far."""

    def __init__(self):
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        while self.root.setdefault(x, x) != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Connects two nodes; whether they were apart. The smallest is the root."""
        a, b = sorted((self.find(a), self.find(b)))
        self.root[b] = a
        return a != b


def _sets(column: pd.Series) -> list[np.ndarray]:
    """Sets of shingles, from bytes or from lists of 64-bit numbers."""
    return [
        np.frombuffer(x, np.uint64) if isinstance(x, bytes) else np.asarray(x, np.int64).view(np.uint64)
        for x in column
    ]


def _dealt(pairs: DataFrame, members: DataFrame, ws: Workspace) -> DataFrame:
    """The members of both groups of each pair, dealt to tasks.

    The larger group of a pair goes to a task once for some ``PARTNERS`` of its partners,
    so what travels grows with the smaller groups. Columns: deal, p, q (null in rows of
    the larger group ``p``), and those of the members.
    """
    sizes = ws.write(members.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "sizes")
    sized = pairs
    for own in ("p", "q"):
        sized = sized.join(sizes.select(F.col("grp").alias(own), F.col("n").alias(f"n_{own}")), own)
    swap = F.col("n_p") < F.col("n_q")
    large = F.when(swap, F.col("q")).otherwise(F.col("p"))
    small = F.when(swap, F.col("p")).otherwise(F.col("q"))
    oriented = ws.write(sized.select(large.alias("p"), small.alias("q")), "oriented")
    parts = oriented.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("parts"))
    part = F.pmod(F.xxhash64("q"), F.col("parts")).alias("part")
    dealt = ws.write(oriented.join(parts, "p").select("p", "q", part), "dealt")
    least = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, dealt.count() // PARTNERS)
    # The larger groups, and the partners of each.
    once = dealt.select("p", "part").distinct().withColumn("q", F.lit(None).cast("string"))
    sides = [
        rows.join(members, F.col(own) == F.col("grp")).drop("grp").select("p", "q", "part", *[c for c in members.columns if c != "grp"])
        for rows, own in ((once, "p"), (dealt, "q"))
    ]
    sides[1] = sides[1].withColumn("q", F.col("q").cast("string"))  # numbers with nulls are floats in pandas
    deal = F.pmod(F.xxhash64("p", "part"), F.lit(tasks))
    return sides[0].unionByName(sides[1]).withColumn("deal", deal).groupBy("deal")


def _each_pair(rows: pd.DataFrame) -> Iterator[tuple[int, int, pd.DataFrame, pd.DataFrame]]:
    for (p, _), own in rows.groupby(["p", "part"], sort=False):
        large = own[own["q"].isna()]
        for q, small in own[own["q"].notna()].groupby("q", sort=False):
            if len(large):
                yield p, int(q), large, small


def qualifying(pairs: DataFrame, firsts: DataFrame, ws: Workspace) -> DataFrame:
    """The pairs of groups whose overlap lets sets of both be linked, by first shingles."""

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for p, q, left, right in _each_pair(rows):
            a, b = _sets(left["tokens"]), _sets(right["tokens"])
            if (overlaps_union(a, b) >= left["must"]).any() and (overlaps_union(b, a) >= right["must"]).any():
                found.append((p, q))
        return pd.DataFrame(found, columns=["p", "q"], dtype="int64")

    pairs = ws.write(pairs, "pairs")
    return ws.write(_dealt(pairs, firsts, ws).applyInPandas(task, "p bigint, q bigint"), "qualifying")


def compare(pairs: DataFrame, members: DataFrame, percent: int, ws: Workspace) -> DataFrame:
    """Links (a, b) that connect what links between paired groups connect.

    ``members``: grp, rep, tokens, label. Sets of one label are connected already, so two
    labels get one link at most.
    """

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, _, left, right in _each_pair(rows):
            if left["label"].nunique() == 1 and set(right["label"]) == {left["label"].iloc[0]}:
                continue
            known = Connected()
            reps = left["rep"].tolist(), right["rep"].tolist()
            labels = left["label"].tolist(), right["label"].tolist()
            for i, j in linked(_sets(left["tokens"]), _sets(right["tokens"]), percent):
                if known.join(labels[0][i], labels[1][j]):
                    found.append((reps[0][i], reps[1][j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return ws.write(_dealt(pairs, members, ws).applyInPandas(task, "a bigint, b bigint"), "links")


def inside_groups(members: DataFrame, rows: int, percent: int, ws: Workspace) -> DataFrame:
    """``members`` (grp, rep, tokens) with label, the smallest rep connected inside the group.

    ``rows``: at most how many members there are."""

    def task(group: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for _, own in group.groupby("grp", sort=False):
            known, reps, sets = Connected(), own["rep"].tolist(), _sets(own["tokens"])
            if len(own) > 1:
                for i, j in linked(sets, sets, percent):
                    known.join(reps[i], reps[j])
            parts.append(own.assign(label=[known.find(rep) for rep in reps]))
        columns = ["grp", "rep", "tokens", "label"]
        return pd.concat(parts)[columns] if parts else pd.DataFrame(columns=columns)

    least = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-rows // ROWS_PER_TASK))
    dealt = members.withColumn("deal", F.pmod(F.xxhash64("grp"), F.lit(tasks))).groupBy("deal")
    return ws.write(
        dealt.applyInPandas(task, "grp bigint, rep bigint, tokens binary, label bigint"), "members"
    )


def _group(first: Column, parts: Column, d2: Column) -> Column:
    """A group's number: of the smallest shingle, and of the part the set is dealt to."""
    return F.xxhash64(first, F.pmod(d2, F.coalesce(parts, F.lit(1))))


def by_component(placed: DataFrame, labels: DataFrame) -> DataFrame:
    """Per group (``grp``) the one that it becomes part of (``to``), and what that goes by.

    A group of one component (own 0) goes by its label, any other by itself. The groups of a
    component are brought together, up to about ``GROUP_SETS`` sets each, so that most
    components are one group (``alone``) and are compared with others as one.
    """
    known = placed.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "label", F.coalesce("label", "rep")
    )
    one = F.min("label") == F.max("label")
    groups = known.groupBy("grp").agg(
        F.count(F.lit(1)).alias("sets"),
        F.when(one, 0).otherwise(1).alias("own"),
        F.when(one, F.min("label")).otherwise(F.first("grp")).alias("name"),
    )
    sizes = groups.groupBy("own", "name").agg(
        F.count(F.lit(1)).alias("groups"), F.ceil(F.sum("sets") / GROUP_SETS).alias("parts")
    )
    several = F.col("groups") > 1
    part = F.xxhash64("name", F.pmod(F.xxhash64("grp"), F.col("parts")))
    alone = ~several | (F.col("parts") == 1)
    return groups.join(sizes, ["own", "name"]).select(
        "grp", F.when(several, part).otherwise(F.col("grp")).alias("to"), "own", "name", alone.alias("alone")
    )


def moved(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the groups that theirs have become part of, see :func:`by_component`."""
    whole = rows.join(groups.select("grp", "to"), "grp").withColumn("grp", F.col("to"))
    return whole.select(rows.columns)


def one_of_like_tokens(named: DataFrame) -> DataFrame:
    """The rows (token, grp, ...) of one token of those that occur in the same groups, which are
    told apart by 128 bits. All of them give the same pairs, and once is enough."""
    both = [F.bit_xor(F.xxhash64("grp", F.lit(k))).alias(f"g{k}") for k in range(2)]
    lists = named.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *both)
    first = lists.groupBy("n", "g0", "g1").agg(F.min("token").alias("token"))
    return named.join(first.select("token"), "token", "left_semi")


def unlike_names(named: DataFrame, ws: Workspace) -> DataFrame:
    """Pairs of names (x, y) that share a token, with such tokens.

    In an order of all tokens, frequent ones first, two names are paired by the first token
    they share. Each knows its first ``EARLY`` tokens; where both have one of these before a
    token, that token need not pair them again. Of a name of several groups, each token may
    pair other groups, so it pairs by all.
    """
    names = named.select("token", "own", "name", "alone").distinct()
    order = names.groupBy("token").agg((-F.count(F.lit(1))).alias("order"))
    at = F.struct("order", "token").alias("at")
    ranked = ws.write(names.join(order, "token").select("token", "own", "name", "alone", at), "ranked")
    early = ranked.filter("alone").groupBy("own", "name").agg(  # of the tokens of one group
        F.slice(F.sort_array(F.collect_list("at")), 1, EARLY).alias("early")
    )
    before = F.transform(F.filter("early", lambda u: u < F.col("at")), lambda u: u["token"])
    before = F.coalesce(before, F.array().cast("array<bigint>"))
    whole = ranked.join(early, ["own", "name"], "left")
    low, high = (
        whole.select("token", F.struct("own", "name").alias(x), before.alias(f"before_{x}")) for x in ("x", "y")
    )
    pairs = low.join(high, "token").filter("x < y AND NOT arrays_overlap(before_x, before_y)")
    return ws.write(pairs.select("token", "x", "y"), "unlike")


def open_pairs(matrix: DataFrame, groups: DataFrame, ws: Workspace) -> DataFrame:
    """Pairs of groups that share a shingle and are not known to be connected; ``groups`` are a
    written table of :func:`by_component`."""
    named = matrix.join(groups, "grp").select("token", F.col("to").alias("grp"), "own", "name", "alone").distinct()
    names = named.select("token", "own", "name").distinct()
    mixed = names.groupBy("token").count().filter("count > 1").select("token")
    named = ws.write(one_of_like_tokens(named.join(mixed, "token", "left_semi")), "named")
    unlike = unlike_names(named, ws)
    sides = [
        named.select("token", F.struct("own", "name").alias(own), F.col("grp").alias(grp))
        for own, grp in (("x", "p"), ("y", "q"))
    ]
    pairs = unlike.join(sides[0], ["token", "x"]).join(sides[1], ["token", "y"])
    ordered = pairs.select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct()
    return ordered.join(matrix.select(F.col("hub").alias("p"), F.col("grp").alias("q")), ["p", "q"], "left_anti")


def similar_groups(docs: DataFrame, ws: Workspace, like: Similarity = Similarity()) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    scanned = ws.write(scan(docs, like.words), "scanned")
    sketch = summed_sketch(scanned)
    documents = scanned.filter("sketch IS NULL").drop("sketch")
    with_set = documents.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = ws.write(
        with_set.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.min("first").alias("first")),
        "sets",
    )
    # One document of each set goes on: those of equal sets are left out, and those without.
    copies = with_set.join(sets.select("d1", "d2", "rep"), ["d1", "d2"]).filter("doc_id <> rep")
    copies = ws.write(copies.select("doc_id").distinct(), "copies")
    single = docs.filter("doc_id IS NOT NULL").join(checked_broadcast(copies), "doc_id", "left_anti")
    chosen = ws.write(prefixes(single, like, sketch), "prefixes")

    # Sets that share too few of their first shingles with any others have no link at all.
    rows = chosen.select("rep", "must", "keys", F.posexplode("first").alias("at", "token"))
    rows = rows.select("rep", "must", "token", (F.col("at") < F.col("keys")).alias("key"))
    hits = ws.write(shared_rows(rows), "hits")
    for _ in range(PRUNINGS):
        enough = hits.groupBy("rep", "must").count().filter(F.col("count") >= F.col("must")).select("rep")
        hits = ws.write(shared_rows(hits.join(enough, "rep", "left_semi")), "hits")
    left = hits.select("rep").distinct()

    placed = sets.join(left, "rep", "left_semi")
    large = (
        placed.groupBy("first").count().filter(F.col("count") > GROUP_SETS)
        .select("first", F.ceil(F.col("count") / GROUP_SETS).alias("parts"))
    )
    grp = _group(F.col("first"), F.col("parts"), F.col("d2")).alias("grp")
    placed = ws.write(placed.join(large, "first", "left").select("rep", grp), "placed")
    known = checked_broadcast(placed)
    found_in = ws.write(hits.filter("key").join(known, "rep").select("token", "grp").distinct(), "found_in")
    hubs = found_in.groupBy("token").agg(F.min("grp").alias("hub"), F.max("grp").alias("last"))
    matrix = ws.write(found_in.join(hubs.filter("hub < last").drop("last"), "token"), "matrix")

    # Groups are opened where their overlap allows links, first those sharing a hub.
    firsts = ws.write(chosen.join(known, "rep").select("grp", "must", F.col("first").alias("tokens")), "firsts")

    def members_of(groups: DataFrame, placed: DataFrame) -> DataFrame:
        """grp, rep and whole sets of all in ``groups``."""
        reps = ws.write(placed.join(groups.distinct(), "grp", "left_semi"), "opened")
        reps = checked_broadcast(reps)
        ids = reps.select(F.col("rep").alias("doc_id"))
        tokens = whole_sets(docs.join(ids, "doc_id", "left_semi"), like.words)
        return tokens.withColumnRenamed("doc_id", "rep").join(reps, "rep").select("grp", "rep", "tokens")

    def of_pairs(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("p").alias("grp")).union(pairs.select("q"))

    to_hub = matrix.filter("grp <> hub").select(F.col("hub").alias("p"), F.col("grp").alias("q"))
    to_hub = qualifying(to_hub.distinct(), firsts, ws)
    several = placed.groupBy("grp").count().filter("count > 1").select("grp")
    members = members_of(several.union(of_pairs(to_hub)), placed)
    members = inside_groups(members, placed.count(), like.percent, ws)
    inside = members.filter("label <> rep").select(F.col("rep").alias("a"), F.col("label").alias("b"))
    links = inside.unionByName(compare(to_hub, members, like.percent, ws))
    labels = components(links, ws)
    groups = ws.write(by_component(placed, labels), "groups")
    rest = qualifying(open_pairs(matrix, groups, ws), moved(firsts, groups), ws)
    if not rest.isEmpty():
        members = ws.write(members_of(of_pairs(rest), moved(placed, groups)), "members").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        members = members.withColumn("label", F.coalesce("label", "rep"))
        labels = components(links.unionByName(compare(rest, members, like.percent, ws)), ws)

    of_set = ws.write(
        sets.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
            "d1", "d2", F.coalesce("label", "rep").alias("component_id")
        ),
        "set_components",
    )
    return documents.join(of_set, ["d1", "d2"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, ws: Workspace, like: Similarity = Similarity()) -> DataFrame:
    """``docs`` without those that are similar to one of a smaller doc_id, in a chain or directly."""
    groups = similar_groups(docs, ws, like)
    gone = ws.write(groups.filter("component_id <> doc_id").select("doc_id").distinct(), "similar")
    return docs.join(checked_broadcast(gone), "doc_id", "left_anti").select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
