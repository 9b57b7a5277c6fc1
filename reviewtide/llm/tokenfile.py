"""Token ids in bit-plane shuffled chunk files.

A file set is a folder of Parquet files that hold one chunk a row. The documents are
dealt to parts by ranges of doc_id; a part's ids, each document's followed by the end
id, are one stream that is cut into chunks of a fixed number of ids. A chunk is turned
by 90 degrees: plane k has byte k (or bit k) of all its ids, so that like values lie
together; each plane is compressed with zstandard. The narrow columns are the chunk
index: part, chunk, number of ids, and the documents with their place in the chunk. It
can be read without the planes, and where the ids of a document begin in the whole
follows from sums over it. Spark writes and commits the files, so a lost task leaves
none behind, and they can lie in any store.

The strings of special tokens in texts are those tokens, as the library has it. Null
texts count as empty: the end id alone. Null doc_ids come first; rows that repeat
a doc_id are documents of their own, next to each other.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewtide.llm.bpe import Words, batch_ids, text_ids
from reviewtide.llm.wordbatch import gathered, holding
from reviewtide.operators.sizing import checked_broadcast

CHUNK_IDS = 1 << 16
LEVEL = 1
REMEMBERED_WORDS = 1_200_000  # of some 250 bytes each

SCHEMA = (
    "part int, chunk bigint, n_ids bigint, "
    "docs array<struct<doc bigint, doc_id bigint, at bigint, n bigint, whole boolean>>, "
    "planes array<binary>"
)


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The byte planes, lowest first, or the bit planes of 32-bit ids."""
    columns = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        columns = np.unpackbits(columns, axis=1, bitorder="little")
        return [np.packbits(plane).tobytes() for plane in columns.T]
    return [plane.tobytes() for plane in columns.T]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 32:
        rows = [np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes]
        columns = np.packbits(np.stack(rows, axis=1), axis=1, bitorder="little")
    else:
        columns = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    return np.ascontiguousarray(columns).view("<u4").reshape(-1)


_DOC = pa.struct(
    [("doc", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int64()),
     ("whole", pa.bool_())]
)


class _Part:
    """The chunks of one part, as documents arrive in order. Only an open chunk is held, as
    columns of its documents' pieces."""

    def __init__(self, part: int, bits: bool, size: int):
        self.part, self.bits, self.size = part, bits, size
        self.waiting: list[np.ndarray] = []
        self.pieces: list[list[np.ndarray]] = []
        self.n = self.chunk = self.docs = 0

    def add(self, doc_ids: pa.Array, stream: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Append documents, whose ids lie in ``stream`` between ``bounds``; gives the chunks that
        they fill."""
        n = np.diff(bounds)
        stops = self.n + np.cumsum(n)
        begins = stops - n
        doc = np.arange(self.docs, self.docs + len(n))
        self.docs += len(n)
        done = 0
        while True:
            space = self.size - self.n
            here = np.flatnonzero((begins < self.size) & (stops > 0))
            at = np.maximum(begins[here], 0)
            end = np.minimum(stops[here], self.size)
            whole = (begins[here] >= 0) & (stops[here] <= self.size)
            self.pieces.append([doc[here], doc_ids.take(pa.array(here)), at, end - at, whole])
            now = stream[done : done + space]
            self.waiting.append(now)
            self.n += len(now)
            done += len(now)
            if self.n < self.size:
                return
            yield self.row()
            begins, stops = begins - self.size, stops - self.size

    def row(self) -> pa.RecordBatch:
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        planes = list(map(compress, to_planes(np.concatenate(self.waiting), self.bits)))
        doc, doc_id, at, n, whole = zip(*self.pieces)
        docs = pa.StructArray.from_arrays(
            [*(pa.array(np.concatenate(x)) for x in (doc,)), pa.concat_arrays(doc_id),
             *(pa.array(np.concatenate(x)) for x in (at, n, whole))],
            fields=list(_DOC),
        )
        row = pa.RecordBatch.from_arrays(
            [pa.array([self.part], pa.int32()), pa.array([self.chunk], pa.int64()),
             pa.array([self.n], pa.int64()), pa.ListArray.from_arrays([0, len(docs)], docs),
             pa.array([planes], pa.list_(pa.binary()))],
            ["part", "chunk", "n_ids", "docs", "planes"],
        )
        self.waiting, self.pieces, self.n, self.chunk = [], [], 0, self.chunk + 1
        return row


class TextIds:
    """The ids of texts, as bytes, as the tokenizers library gives them without adding special
    tokens.

    Texts are taken apart into words whose ids are remembered, see :class:`Words`. Where a
    text may hold a special token, which the library takes as one token, it is encoded as a
    whole by the library; with ``plain`` such strings are ordinary text.
    """

    def __init__(self, description: str, plain: bool, remembered: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is its share
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.encode_special_tokens = plain
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.signs = () if plain else tuple({token.content for token in added})
        self.words = Words(self.whole, _letters(self.tokenizer), remembered=remembered)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def __call__(self, text: str) -> bytes:
        for sign in self.signs:
            if sign in text:
                return self.whole(text).tobytes()
        return text_ids(text, self.words)

    def batch(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a batch of texts, each followed by ``end``, in one row, and their bounds."""
        texts = pc.fill_null(texts, "")
        signed = np.flatnonzero(holding(texts, self.signs)).tolist()
        whole = {k: self.whole(texts[k].as_py()).tobytes() for k in signed}
        return batch_ids(texts, self.words, end, whole)


_kept: dict[tuple, TextIds] = {}


def text_ids_of(description: str, plain: bool = False, remembered: int | None = None) -> TextIds:
    """The one that the tasks of a worker process share, with the words they have met."""
    key = (description, plain)
    if key not in _kept:
        _kept.clear()
        _kept[key] = TextIds(description, plain, remembered or REMEMBERED_WORDS)
    return _kept[key]


def byte_letters() -> dict[int, str]:
    """The visible character by which byte-level vocabularies write each byte."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def _letters(tokenizer):
    """The ids of one match of letters by the tokenizer's model alone.

    For byte-level tokenizers that neither normalise nor put a space before: there, letters
    (and a space before them) always are one match, and the model gets their bytes as
    visible characters. For others there is no such short way.
    """
    before = tokenizer.pre_tokenizer
    if type(before).__name__ != "ByteLevel" or before.add_prefix_space or tokenizer.normalizer:
        return None
    table = byte_letters()
    tokenize = tokenizer.model.tokenize

    space = table[32]

    def letters(text: str) -> bytes:
        if text.isascii():
            shown = text.replace(" ", space)
        else:
            shown = text.encode().decode("latin-1").translate(table)
        return array("I", [token.id for token in tokenize(shown)]).tobytes()

    return letters


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 0,
    bits: bool = False,
    chunk_ids: int = CHUNK_IDS,
) -> None:
    """Write the ids of ``docs`` (doc_id, text) to the folder ``path``, in chunks of ``chunk_ids``."""
    with open(tokenizer_path, encoding="utf-8") as file:
        description = docs.sparkSession.sparkContext.broadcast(file.read())

    end = np.array([end_id], np.uint32).tobytes()

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_ids_of(description.value)
        part = _Part(TaskContext.get().partitionId(), bits, chunk_ids)
        for batch in gathered(batches):
            stream, bounds = encode.batch(batch.column("text"), end)
            yield from part.add(batch.column("doc_id").cast(pa.int64()), stream, bounds)
        if part.n:
            yield part.row()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(task, SCHEMA).write.option("compression", "uncompressed").parquet(path)


def _spans(planes: list[bytes], n_ids: int, at: np.ndarray, n: np.ndarray) -> pa.Array:
    """The ids of spans of a chunk as one binary column; only what the spans hold is put
    together again, in one go where they adjoin."""
    if len(planes) == 4 and not (at[1:] == at[:-1] + n[:-1]).all():
        spans = zip(at.tolist(), n.tolist())
        parts = [from_planes([p[a : a + m] for p in planes], m).tobytes() for a, m in spans]
        return pa.array(parts, pa.binary())
    whole = from_planes(planes, n_ids).tobytes()
    if (at[1:] == at[:-1] + n[:-1]).all():
        offsets = np.append(at, at[-1] + n[-1]).astype(np.int32) * 4
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(whole)]
        return pa.BinaryArray.from_buffers(pa.binary(), len(at), buffers)
    return pa.array([whole[4 * a : 4 * (a + m)] for a, m in zip(at, n)], pa.binary())


def read_pieces(chunks: DataFrame, whole: bool, chunk_ids: int) -> DataFrame:
    """A row for each document and chunk: part, doc, doc_id, at (in the part), ids (bytes); of the
    documents that lie in one chunk whole, or of the others."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k in range(batch.num_rows):
                part, chunk, n_ids = (batch.column(c)[k].as_py() for c in ("part", "chunk", "n_ids"))
                docs = batch.column("docs")[k].values
                docs = docs.filter(pc.equal(docs.field("whole"), whole))
                if not len(docs):
                    continue
                planes = [decompress(p) for p in batch.column("planes")[k].as_py()]
                at, n = docs.field("at").to_numpy(), docs.field("n").to_numpy()
                ids = _spans(planes, n_ids, at, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(docs), part, np.int32)), docs.field("doc"),
                     docs.field("doc_id"), pa.array(at + chunk * chunk_ids), ids],
                    ["part", "doc", "doc_id", "at", "ids"],
                )

    return chunks.mapInArrow(task, "part int, doc bigint, doc_id bigint, at bigint, ids binary")


def read_ids(spark: SparkSession, path: str, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), ids (32-bit, little-endian).

    Only documents that reach over the end of a chunk are brought together by a shuffle.
    """
    chunks = spark.read.schema(SCHEMA).parquet(path)
    sums = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    whole = read_pieces(chunks, True, chunk_ids)
    cut = chunks.filter(F.exists("docs", lambda d: ~d["whole"]))
    joined = (
        read_pieces(cut, False, chunk_ids)
        .groupBy("part", "doc", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("p"))
        .select(
            "part", "doc", "doc_id", F.col("p")[0]["at"].alias("at"),
            F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"),
        )
    )
    return (
        whole.unionByName(joined)
        .join(checked_broadcast(begins), "part")
        .select("doc_id", (F.col("before") + F.col("at")).alias("start"), "ids")
    )
