"""Alignment of two tokenizers' tokens, by galloping intersection of their ends.

Both tokenizers cut the same bytes, a space and the text, so their tokens are given by the
places where they end. Of a document's two lists of ends the shorter one drives: each of its
ends is looked for in the longer one, from a guessed place by steps that double, then by
halving between the last two. Ends found are common; they cut both sequences into groups.
The ranks found also tell which tokens of the longer list each token of the shorter one
overlaps. A link is a pair of tokens that end together: the last ones of a group.

All documents of a batch are searched at once, one behind another: their bytes are as many
on both sides, so the ends keep rising from one document to the next.

The second part scores the links by how often their pair of ids is linked in all documents.
Each document keeps its distinct pairs and how often it has them; those are summed over the
corpus. Pairs that make up at least a ``HOT_SHARE``-th of all links are at most ``HOT_SHARE``
many, whatever the corpus, so they are broadcast; the rows of the other pairs, which are
rare, are joined by a shuffle in which no key is hot. The best count of each id of the
second tokenizer has at most a row for each id.

Odd input. Null and empty texts, and texts whose bytes one of the tokenizers does not give
back, have no tokens: zeros, no groups. Strings of special tokens are ordinary text. Rows
that repeat a doc_id, or whole rows, are documents of their own and count each, null doc_ids
too. Only doc_id and text are read, further columns may have any name; an empty table gives
an empty result. A task holds one Arrow batch (see ``ARROW_BATCH_BYTES``) and its tokens, or
one document where that is larger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.llm.bpe import slices
from reviewtide.llm.common import text_or_empty
from reviewtide.llm.tokenfile import byte_letters, text_ids_of
from reviewtide.session import Workspace

HOT_SHARE = 100_000
REMEMBERED_WORDS = 600_000
SPACE_SIGN = "▁"  # fixed value: how pieces write a space

ALIGNED = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_overlaps bigint, {groups} string, "
    "pairs array<bigint>, times array<int>"
)


def gallop(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each value of ``short`` the first place in ``long`` (rising) with no smaller value.

    From its guessed place each value steps on, or back, by 1, 2, 4 ... until it is passed,
    and then halves what lies between.
    """
    n = len(long)
    low, high = np.zeros(len(short), np.int64), np.full(len(short), n, np.int64)
    if not n:
        return low
    place = np.clip(guess, 0, n - 1)
    smaller = long[place] < short
    low[smaller] = place[smaller] + 1
    high[~smaller] = place[~smaller]
    for onward in (True, False):
        todo = np.flatnonzero(smaller if onward else ~smaller)
        step = 1
        while len(todo):
            if onward:
                place = np.minimum(low[todo] + step - 1, n - 1)
                open_ = low[todo] < high[todo]
            else:
                place = np.maximum(high[todo] - step, 0)
                open_ = low[todo] < high[todo]
            todo, place = todo[open_], place[open_]
            below = long[place] < short[todo]
            low[todo[below]] = place[below] + 1
            high[todo[~below]] = np.minimum(high[todo[~below]], place[~below])
            todo = todo[below if onward else ~below]
            step *= 2
    todo = np.flatnonzero(low < high)
    while len(todo):
        middle = (low[todo] + high[todo]) // 2
        below = long[middle] < short[todo]
        low[todo[below]] = middle[below] + 1
        high[todo[~below]] = middle[~below]
        todo = todo[low[todo] < high[todo]]
    return low


def signed_ids(n: int) -> np.ndarray:
    """The numbers below ``n`` as text, followed by a comma, a bar, a semicolon: a row for each."""
    return np.array([[f"{k}{sign}" for k in range(n)] for sign in ",|;"], object)


class Tokens:
    """Token ids of several documents, one behind another, with the bytes they stand for."""

    def __init__(self, ids: list[np.ndarray], sizes: np.ndarray):
        self.counts = np.array([len(x) for x in ids], np.int64)
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        self.ends = np.cumsum(sizes[self.ids])
        self.begins = np.cumsum(self.counts) - self.counts
        self.doc = np.repeat(np.arange(len(ids)), self.counts)


class Alignment:
    """Common ends of two tokenizations ``a`` and ``b`` of the same documents."""

    def __init__(self, a: Tokens, b: Tokens):
        self.a, self.b = a, b
        first = a.counts <= b.counts  # documents in which a is the shorter list
        in_a, in_b = first[a.doc], first[b.doc]
        short = self._merged(a, in_a, b, ~in_b)
        long = self._merged(b, in_b, a, ~in_a)
        per_short, per_long = np.where(first, a.counts, b.counts), np.where(first, b.counts, a.counts)
        starts = np.cumsum(per_long) - per_long
        doc = np.repeat(np.arange(len(first)), per_short)
        turn = np.arange(len(short)) - np.repeat(np.cumsum(per_short) - per_short, per_short)
        guess = starts[doc] + turn * per_long[doc] // np.maximum(per_short[doc], 1)
        rank = gallop(short, long, guess)
        found = rank < len(long)
        found[found] = long[rank[found]] == short[found]
        self.n_groups = np.bincount(doc[found], minlength=len(first))
        # A token overlaps those from the first that ends after the token before it, to the
        # first that does not end before itself.
        before = np.concatenate([[-1], (rank + found - 1)[:-1]])
        self.n_overlaps = np.bincount(doc, weights=rank - before, minlength=len(first)).astype(np.int64)
        # Where a document's list drives, its place in all of ``short`` or ``long`` is its
        # place in its own list, moved by what the document is moved.
        in_short = np.flatnonzero(found)
        in_long = rank[in_short]
        doc = doc[in_short]
        short_start = np.cumsum(per_short) - per_short
        at_a = np.where(first[doc], in_short - short_start[doc], in_long - starts[doc])
        at_b = np.where(first[doc], in_long - starts[doc], in_short - short_start[doc])
        self.doc, self.last_a, self.last_b = doc, a.begins[doc] + at_a, b.begins[doc] + at_b

    @staticmethod
    def _merged(x: Tokens, of_x: np.ndarray, y: Tokens, of_y: np.ndarray) -> np.ndarray:
        """The ends of some documents of x and of the others of y, in order."""
        ends = np.concatenate([x.ends[of_x], y.ends[of_y]])
        ends.sort(kind="stable")
        return ends

    def texts(self, words: np.ndarray) -> list[str]:
        """Per document its groups as ``a1,a2|b1;a3|b2,b3``; ``words`` from :func:`signed_ids`."""
        n_a, n_b = len(self.a.ids), len(self.b.ids)
        sign = np.zeros(n_a + n_b, np.int64)
        sign[self.last_a] = 1
        sign[n_a + self.last_b] = 2
        # The tokens of group g of a stand before those of b, and these before group g + 1 of a.
        done_a, done_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
        done_a[self.last_a[:-1] + 1] = np.diff(self.last_b, prepend=-1)[:-1]
        done_b[np.append(0, self.last_b[:-1] + 1)[: len(self.last_b)]] = np.diff(self.last_a, prepend=-1)
        place = np.concatenate([np.arange(n_a) + np.cumsum(done_a), np.arange(n_b) + np.cumsum(done_b)])
        ordered = np.empty(n_a + n_b, object)
        ordered[place] = words[sign, np.concatenate([self.a.ids, self.b.ids])]
        strings = ordered.tolist()
        sizes = self.a.counts + self.b.counts
        stops = np.cumsum(sizes)
        return ["".join(strings[a:b])[:-1] for a, b in zip((stops - sizes).tolist(), stops.tolist())]

    def pairs(self, n_b_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked pairs of each document: document, pair number, how often."""
        pair = self.a.ids[self.last_a] * n_b_ids + self.b.ids[self.last_b]
        order = np.lexsort((pair, self.doc))
        doc, pair = self.doc[order], pair[order]
        new = np.ones(len(pair), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(pair)))
        return doc[first], pair[first], times


class ByteLevel:
    """A byte-level BPE of the tokenizers library, for texts with a space before."""

    def __init__(self, description: str):
        self.encode = text_ids_of(description, plain=True, remembered=REMEMBERED_WORDS)
        tokenizer = self.encode.tokenizer
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        names = [tokenizer.id_to_token(k) or "" for k in range(tokenizer.get_vocab_size())]
        self.tokens = [
            bytes(map(byte_of.__getitem__, name)) if set(name) <= byte_of.keys() else name.encode()
            for name in names
        ]

    def __call__(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(" " + text), np.uint32).astype(np.int64)


class Pieces:
    """A sentencepiece model, which puts the space before by itself."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(k) for k in range(self.model.vocab_size())]
        self.tokens = [
            bytes([int(name[3:-1], 16)]) if self.model.is_byte(k) else name.replace(SPACE_SIGN, " ").encode()
            for k, name in enumerate(names)
        ]

    def __call__(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.int64)


class Spelling:
    """The bytes of a vocabulary's tokens, one behind another."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def gives(self, ids: list[np.ndarray], data: list[bytes]) -> bool:
        """Whether the tokens of each document are its bytes, for all documents at once."""
        each = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        sizes = self.sizes[each]
        stops = np.cumsum(sizes)
        ends = np.append(0, stops)[np.cumsum([len(x) for x in ids], dtype=np.int64)]
        if not np.array_equal(ends, np.cumsum([len(x) for x in data], dtype=np.int64)):
            return False
        place = np.repeat(self.begins[each] - stops + sizes, sizes) + np.arange(sizes.sum())
        return self.bytes[place].tobytes() == b"".join(data)


class Both:
    """Two encoders whose tokens are bytes, and the tokens of a text by both."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.words = signed_ids(max(len(a.tokens), len(b.tokens)))
        self.spelling_a, self.spelling_b = Spelling(a.tokens), Spelling(b.tokens)
        self.sizes_a, self.sizes_b = self.spelling_a.sizes, self.spelling_b.sizes

    def tokens(self, texts: Iterable[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by both; none where one does not give the bytes back."""
        none = np.zeros(0, np.int64)
        texts = list(texts)
        ids_a = [self.a(text) if text else none for text in texts]
        ids_b = [self.b(text) if text else none for text in texts]
        data = [(" " + text).encode() if text else b"" for text in texts]
        if not (self.spelling_a.gives(ids_a, data) and self.spelling_b.gives(ids_b, data)):
            for k, whole in enumerate(data):
                for encoder, ids in ((self.a, ids_a[k]), (self.b, ids_b[k])):
                    if b"".join(map(encoder.tokens.__getitem__, ids.tolist())) != whole:
                        ids_a[k] = ids_b[k] = none
                        break
        return ids_a, ids_b

    def align(self, texts: Iterable[str]) -> Alignment:
        ids_a, ids_b = self.tokens(texts)
        return Alignment(Tokens(ids_a, self.sizes_a), Tokens(ids_b, self.sizes_b))


_kept: dict[int, Both] = {}


def align(
    docs: DataFrame, byte_level_path: str, pieces_path: str, digest: bool = False
) -> tuple[DataFrame, int]:
    """Per row of ``docs``: doc_id, numbers of tokens, groups, links and overlapping pairs, the
    groups as text (``groups``; its hash ``groups_sha256`` with ``digest``), and the distinct
    linked pairs with how often each occurs. A pair of ids is ``a * n + b``; n comes second.
    """
    context = docs.sparkSession.sparkContext
    with open(byte_level_path, encoding="utf-8") as file, open(pieces_path, "rb") as model:
        files = context.broadcast((file.read(), model.read()))  # of the vocabularies' size
    n_b_ids = len(Pieces(files.value[1]).tokens)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if n_b_ids not in _kept:
            _kept[n_b_ids] = Both(ByteLevel(files.value[0]), Pieces(files.value[1]))
        both = _kept[n_b_ids]
        for batch in slices(batches):
            found = both.align(batch.column("text").to_pylist())
            groups = found.texts(both.words)
            if digest:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            doc, pair, times = found.pairs(n_b_ids)
            offsets = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            columns = [
                batch.column("doc_id"),
                *(pa.array(c.astype(np.int64)) for c in (
                    found.a.counts, found.b.counts, found.n_groups, found.n_groups, found.n_overlaps
                )),
                pa.array(groups, pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(pair)),
                pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    plain = docs.select("doc_id", text_or_empty().alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, {ALIGNED.format(groups='groups_sha256' if digest else 'groups')}"
    names = [field.split()[0] for field in schema.split(", ")]
    return plain.mapInArrow(task, schema), n_b_ids


def link_scores(aligned: DataFrame, n_b_ids: int, ws: Workspace, hot_share: int = HOT_SHARE) -> DataFrame:
    """Per ``row`` of ``aligned`` (a written table): ``n_best``, its links whose pair is the most
    frequent one of its second id, ties included, and ``count_sum``, the sum of its links' counts.
    Rows without links have none.
    """
    links = aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).toDF("row", "pair", "n")
    counts = ws.write(links.groupBy("pair").agg(F.sum("n").alias("count")), "pair_counts")
    b = F.col("pair") % n_b_ids
    highest = counts.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    scored = counts.join(F.broadcast(highest), b == F.col("b")).select(
        "pair", "count", (F.col("count") == F.col("highest")).cast("int").alias("best")
    )
    is_hot = F.col("count") * hot_share >= total
    hot = F.broadcast(scored.filter(is_hot))
    rare = links.join(F.broadcast(counts.filter(is_hot).select("pair")), "pair", "left_anti")

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("row").agg(
            F.sum(F.col("n") * F.col("best")).alias("n_best"),
            F.sum(F.col("n") * F.col("count")).alias("count_sum"),
        )

    parts = summed(links.join(hot, "pair")).unionByName(summed(rare.join(scored.filter(~is_hot), "pair")))
    return parts.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n_best", "count_sum")))


def aligned_tokens(
    docs: DataFrame, ws: Workspace, byte_level_path: str, pieces_path: str, digest: bool = False
) -> DataFrame:
    """The rows of :func:`align` without their pairs, with ``n_best`` and ``count_sum``."""
    found, n_b_ids = align(docs, byte_level_path, pieces_path, digest)
    table = ws.write(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    scores = link_scores(table.select("row", "pairs", "times"), n_b_ids, ws)
    zero = F.lit(0).cast("bigint")
    return table.drop("pairs", "times").join(scores, "row", "left").select(
        *(c for c in table.columns if c not in ("row", "pairs", "times")),
        *(F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")),
    )
