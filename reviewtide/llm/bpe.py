"""Byte-level BPE by monoid tree reduction.

The tokens of a byte string are found by halving it, encoding the halves, and joining
their tokens; joining is associative, with the empty string as its unit. A join
re-encodes a window around the seam, and lets it grow until the tokens outside cannot
change. That is known from two facts of merging the lowest rank first, leftmost first:

* tokens next to each other in an encoding are the encoding of their own bytes;
* if each two neighbours of a token sequence are the encoding of their own bytes, so is
  the whole: the first merge across a border would also occur in those two alone.

So a window is large enough once its first and last token stand the test with the token
next to it. Decoding concatenates up the same tree.

A text is split by the pattern first. Matches never reach across a white space that
follows a word, so words are encoded one by one, and each worker remembers the words it
has met. Null texts count as empty and have no tokens. Rows are independent, nothing is
shuffled; other columns pass through, columns named like the added ones are replaced.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.llm.wordbatch import distinct_words, lined_up

LEAF_BYTES = 64
FEW_BYTES = 24
NO_RANK = 1 << 60
WINDOW_TOKENS = 4
TREE_IDS = 1 << 14
REMEMBERED_WORDS = 300_000
REMEMBERED_EDGES = 10_000
MOST_MARKS = 4
SHORT_WORD = 12  # longer words that end in a mark are put together from their parts
ROWS_AT_ONCE = 512

#: Where a text may not simply be split at its spaces.
_MARKS = frozenset(".,\n")
#: ASCII marks that are one match after letters; an apostrophe may begin a match of letters.
_CLOSING = "!\"#$%&()*+,-./:;<=>?@[\\]^`{|}~"
_BLANKS = re.compile(r"\s (?:\s|\Z)")


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks by token, from lines of a base64 token and its rank."""
    pairs = (line.split() for line in lines.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def spaces_by_property(pattern: str) -> str:
    r"""``pattern`` with ``\s`` meaning Unicode's White_Space, as tokenizers take it."""
    return pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(spaces_by_property(pattern))
        self.stable = lru_cache(1 << 16)(self._stable)

    def merged(self, data: bytes) -> list[int]:
        """Tokens by merging neighbours: the lowest rank first, of equal ones the leftmost."""
        return self._merged_few(data) if len(data) <= FEW_BYTES else self._merged_many(data)

    def _merged_few(self, data: bytes) -> list[int]:
        """Finds each merge by looking at all neighbours."""
        get = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [get(a + b, NO_RANK) for a, b in pairwise(parts)]
        while pairs and (rank := min(pairs)) != NO_RANK:
            i = pairs.index(rank)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], NO_RANK)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], NO_RANK)
        return [self.ranks[part] for part in parts]

    def _merged_many(self, data: bytes) -> list[int]:
        """Finds each merge in a queue."""
        ranks, n = self.ranks, len(data)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        end = list(range(1, n + 1))  # of the part that begins here; 0: begins no part
        queue = [(r, i) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapify(queue)
        while queue:
            rank, i = heappop(queue)
            j = after[i]
            if not end[i] or j >= n or ranks.get(data[i : end[j]]) != rank:
                continue  # one of the two has been merged meanwhile
            end[i], end[j], after[i] = end[j], 0, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(data[i : end[after[i]]])) is not None:
                    heappush(queue, (r, i))
            if (h := before[i]) >= 0 and (r := ranks.get(data[h : end[i]])) is not None:
                heappush(queue, (r, h))
        return [ranks[data[i : end[i]]] for i in range(n) if end[i]]

    def _stable(self, a: int, b: int) -> bool:
        return self.merged(self.tokens[a] + self.tokens[b]) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours' bytes from their encodings."""
        if not left or not right:
            return left or right
        a = b = WINDOW_TOKENS
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = [*left[len(left) - a :], *right[:b]]
            middle = self.merged(b"".join(map(self.tokens.__getitem__, window)))
            left_holds = a == len(left) or self.stable(left[-a - 1], middle[0])
            right_holds = b == len(right) or self.stable(middle[-1], right[b])
            if left_holds and right_holds:
                return [*left[: len(left) - a], *middle, *right[b:]]
            a, b = a * (2 - left_holds), b * (2 - right_holds)

    def encoded(self, data: bytes) -> list[int]:
        """The tokens of a byte string, whatever its length."""
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        half = LEAF_BYTES << ((len(data) - 1) // LEAF_BYTES).bit_length() - 1
        return self.join(self.encoded(data[:half]), self.encoded(data[half:]))

    def piece(self, data: bytes) -> list[int]:
        """The tokens of one match of the pattern: itself, if it is a token."""
        rank = self.ranks.get(data)
        return self.encoded(data) if rank is None else [rank]

    def matches(self, text: str) -> np.ndarray:
        ids = [i for match in self.pattern.findall(text) for i in self.piece(match.encode())]
        return np.array(ids, np.int32)

    def letters(self, text: str) -> bytes:
        return array("i", self.piece(text.encode())).tobytes()

    def decoded(self, ids: np.ndarray) -> bytes:
        if len(ids) <= TREE_IDS:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decoded(ids[:half]) + self.decoded(ids[half:])


def _lines(word: str) -> list[str]:
    """``word``, split at the line ends that have no white space on either side."""
    first, *rest = word.split("\n")
    found = [[first]]
    for before, line in pairwise([first, *rest]):
        if not before or not line or before[-1].isspace() or line[0].isspace():
            found[-1].append(line)
        else:
            found.append([line])
    return ["\n".join(lines) for lines in found]


class Words(dict):
    """The ids, as bytes, of words after ``before``: a space, or nothing.

    ``encode`` gives the ids of any text; ``letters``, if given, those of a text that is
    one match of letters (with a space before it or not), as bytes, at less cost. When
    ``remembered`` words are known, a sixteenth of them, those known longest, are forgotten,
    so memory is bounded and words in use are soon back. ``edges`` tells whether a word with
    white space at an end was looked up; those are remembered apart, so that each time is
    noticed.
    """

    def __init__(self, encode, letters=None, before: str = " ", remembered: int | None = None):
        self.encode, self.before = encode, before
        self.letters = letters or (lambda text: encode(text).tobytes())
        self.remembered = remembered or REMEMBERED_WORDS
        self.marks = {mark: encode(mark).tobytes() for mark in _MARKS}
        self.at_start = self if not before else Words(encode, letters, "", self.remembered // 4)
        self.edges = False
        self.edged: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            ids = self.letters(self.before + word)
            if len(word) <= LEAF_BYTES:
                self._remember(word, ids)
            return ids
        if not word or word[0].isspace() or word[-1].isspace():
            return self._with_edges(word)
        head = word.rstrip(_CLOSING)
        if head.isalpha():  # a match ends where the letters end, the marks are one
            ids = self[head] + self._tail(word[len(head) :])
        else:
            ids = self._parts(word)
        if len(word) <= SHORT_WORD:
            self._remember(word, ids)
        return ids

    def _tail(self, marks: str) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            ids = self.encode(marks).tobytes()
            if len(marks) <= MOST_MARKS:
                self.marks[marks] = ids
        return ids

    def _remember(self, word: str, ids: bytes) -> None:
        if len(self) >= self.remembered:
            for known_longest in list(islice(self, max(1, self.remembered >> 4))):
                del self[known_longest]
        self[word] = ids

    def _with_edges(self, word: str) -> bytes:
        self.edges = True
        ids = self.edged.get(word)
        if ids is None:
            ids = self.encode(self.before + word).tobytes()
            if len(word) <= SHORT_WORD:
                if len(self.edged) >= min(self.remembered, REMEMBERED_EDGES):
                    self.edged.clear()
                self.edged[word] = ids
        return ids

    def _parts(self, word: str) -> bytes:
        """A word that is not of letters alone, by parts that are matches of their own."""
        first, *rest = _lines(word) if "\n" in word else (word,)
        if rest:
            line_end, start = self.marks["\n"], self.at_start
            return line_end.join([self[first], *map(start.__getitem__, rest)])
        return self.encode(self.before + word).tobytes()


def text_ids(text: str, words: Words) -> bytes:
    """The ids of a text as bytes.

    A space always begins a match unless white space is before it and also after it, or the
    text ends there, and a single line end between words is a match, so the text is split
    there and each part encoded by itself. Only parts with white space at an end can be of
    the other kind.
    """
    if not text:
        return b""
    first, *rest = text.split(" ")
    words.edges = words.at_start.edges = False
    ids = (words.at_start[first] if first else b"") + b"".join(map(words.__getitem__, rest))
    if (words.edges or words.at_start.edges) and _BLANKS.search(text):
        return words.encode(text).tobytes()
    return ids


def batch_ids(
    texts: pa.Array, words: Words, end: bytes, whole: dict[int, bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch of texts as :func:`text_ids` gives them, each text's with ``end``, in one
    row, and where each text's begin. ``whole`` has those of texts that are encoded already, and
    gets those that have to be encoded as a whole."""
    offsets, numbers, distinct = distinct_words(texts)
    words.edges = False
    ids = list(map(words.__getitem__, distinct))
    if words.edges:
        edged = np.array([not w or w[0].isspace() or w[-1].isspace() for w in distinct])
        for k in np.flatnonzero(np.logical_or.reduceat(edged[numbers], offsets[:-1])).tolist():
            if k not in whole and _BLANKS.search(text := texts[k].as_py()):
                whole[k] = words.encode(text).tobytes()
    starts, first = np.unique(numbers[offsets[:-1]], return_inverse=True)
    numbers = numbers.copy()
    numbers[offsets[:-1]] = len(ids) + first
    found = (distinct[k] for k in starts.tolist())
    ids += [words.at_start[word] if word else b"" for word in found]
    return lined_up(ids, numbers, offsets, end, whole)


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


_kept: dict[tuple, tuple[Encoder, Words]] = {}


def _encoder(ranks, pattern: str) -> tuple[Encoder, Words]:
    """An encoder and the words it has met, which the tasks of a worker process share."""
    if (ranks.id, pattern) not in _kept:
        _kept.clear()
        encoder = Encoder(read_ranks(ranks.value), pattern)
        _kept[ranks.id, pattern] = encoder, Words(encoder.matches, encoder.letters)
    return _kept[ranks.id, pattern]


class _Ranks:
    """The rank file's content, broadcast: its size is that of the vocabulary."""

    def __init__(self, spark, path: str):
        with open(path, "rb") as file:
            content = file.read()
        self.broadcast = spark.sparkContext.broadcast(content)
        self.id = xxhash.xxh64_hexdigest(content)

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self) -> bytes:
        return self.broadcast.value


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, name])


def _mapped(df: DataFrame, name: str, kind: str, task) -> DataFrame:
    """``df`` with one more column that ``task`` adds to its batches; names may clash freely."""
    names = [c for c in df.columns if c != name]
    plain = df.select(*(F.col(f"`{c}`") for c in names))
    schema = ", ".join(f"`{c}` {k}" for c, k in plain.dtypes) + f", `{name}` {kind}"
    return plain.mapInArrow(task, schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids``: the tokens of the column ``text``."""
    ranks = _Ranks(docs.sparkSession, ranks_path)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, words = _encoder(ranks, pattern)
        for batch in slices(batches):
            ids = [text_ids(text, words) for text in batch.column("text").to_pylist()]
            flat = np.frombuffer(b"".join(ids), np.int32)
            offsets = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
            yield _with_column(batch, "ids", pa.ListArray.from_arrays(offsets, flat))

    return _mapped(docs, "ids", "array<int>", task)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the column ``ids``."""
    ranks = _Ranks(encoded.sparkSession, ranks_path)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _encoder(ranks, pattern)
        for batch in slices(batches):
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy()
            bounds = (ids.offsets.to_numpy() - ids.offsets[0].as_py()).tolist()
            texts = [encoder.decoded(flat[a:b]) for a, b in pairwise(bounds)]
            yield _with_column(batch, "decoded", pa.array(texts, pa.binary()))

    return _mapped(encoded, "decoded", "binary", task)


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` of the column ``text`` and what they decode to, ``decoded``, in one
    pass: one encoder a worker, and the ids do not leave it in between."""
    ranks = _Ranks(docs.sparkSession, ranks_path)
    names = [c for c in docs.columns if c not in ("ids", "decoded")]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, words = _encoder(ranks, pattern)
        for batch in slices(batches):
            ids = [text_ids(text, words) for text in batch.column("text").to_pylist()]
            texts = [encoder.decoded(np.frombuffer(x, np.int32)) for x in ids]
            offsets = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(ids), np.int32))
            columns = [*batch.columns, lists, pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "ids", "decoded"])

    plain = docs.select(*(F.col(f"`{c}`") for c in names))
    schema = ", ".join(f"`{c}` {k}" for c, k in plain.dtypes)
    return plain.mapInArrow(task, f"{schema}, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and hashes of ``ids`` and ``decoded`` in place of both and of the text."""
    gone = ("ids", "decoded", "text", "n_tokens", "ids_sha256", "decoded_sha256")
    names = [c for c in decoded.columns if c not in gone]
    return decoded.select(
        *(F.col(f"`{c}`") for c in names),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
