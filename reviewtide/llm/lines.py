"""Line deduplication by levelled sorted runs of line hashes.

The index is a set of runs: tables bucketed and sorted by line hash, each with the
number of documents that hold a line and the largest doc_id among them. A batch of
documents is merge-anti-joined with the runs, so that lines which they have settled
(found often enough, in a document of larger id) are not recorded again, and what is
left becomes a run of level 0. ``fanout`` runs of one level are merged into one of the
next. Equal bucket counts let all these joins read the runs as they lie, without a
shuffle. Merged at last, the runs tell which lines go, and from which documents.

A line's key is the line without white space at its ends and with A-Z in lower case;
lines are compared by 128 bits of the key's SHA-256. Null texts count as empty: one
empty line. Null doc_ids count as smaller than all others. Rows that share a doc_id
count as documents each, and keep or lose their lines alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewtide.llm.common import SPACES, ascii_lower, free, let, text_or_empty
from reviewtide.session import Workspace

MIN_CHARS = 20
MIN_DOCS = 3
_NO_ID = -(2**63)


def line_hash(line: Column) -> Column:
    """128 bits of a line's key, null for keys that are too short to count."""
    key = F.btrim(line, F.lit(SPACES))
    hashed = F.unhex(F.substring(F.sha2(ascii_lower(key), 256), 1, 32))
    return F.when(F.length(key) >= MIN_CHARS, hashed)


def lines_of(docs: DataFrame) -> DataFrame:
    """A row (id, line) for each document and line hash in it."""
    hashes = F.transform(F.split(text_or_empty(), "\n"), line_hash)
    distinct = F.array_distinct(F.filter(hashes, lambda h: h.isNotNull()))
    return docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), F.explode(distinct).alias("line"))


class LineRuns:
    """The levelled runs. ``buckets``: the same for all runs, so one for each merge task."""

    def __init__(self, ws: Workspace, buckets: int, fanout: int = 2, min_docs: int = MIN_DOCS):
        self.ws, self.buckets, self.fanout, self.min_docs = ws, buckets, fanout, min_docs
        self.levels: list[list[DataFrame]] = []

    def add(self, lines: DataFrame) -> None:
        """Record the rows (id, line) of one batch of documents."""
        new = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("holder"))
        for run in (run for level in self.levels for run in level):
            settled = run.filter(F.col("n_docs") >= self.min_docs).select(
                F.col("line").alias("known"), F.col("holder").alias("known_holder")
            )
            new = new.join(
                settled,
                (F.col("line") == F.col("known")) & (F.col("known_holder") >= F.col("holder")),
                "left_anti",
            )
        self._put(self._write(new), 0)

    def _put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._write(reduce(self._merge, self.levels[level]))
            self.levels[level] = []
            self._put(merged, level + 1)

    @staticmethod
    def _merge(a: DataFrame, b: DataFrame) -> DataFrame:
        other = b.select(
            "line", F.col("n_docs").alias("more"), F.col("holder").alias("other_holder")
        )
        return a.join(other, "line", "full_outer").select(
            "line",
            (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"),
            F.greatest("holder", "other_holder").alias("holder"),
        )

    def _write(self, df: DataFrame) -> DataFrame:
        table = self.ws.table_name(self.ws.fresh("run"))
        (
            df.repartition(self.buckets, "line")
            .sortWithinPartitions("line")
            .write.bucketBy(self.buckets, "line")
            .sortBy("line")
            .saveAsTable(table, format="parquet")
        )
        return self.ws.spark.table(table)

    def repeated(self) -> DataFrame:
        """The lines found in at least ``min_docs`` documents: line, holder."""
        runs = [run for level in self.levels for run in level]
        return reduce(self._merge, runs).filter(F.col("n_docs") >= self.min_docs).select("line", "holder")


def batches_of(docs: DataFrame, n: int) -> list[DataFrame]:
    """``docs`` in ``n`` batches of about equal numbers of rows, largest doc_ids first."""
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 1000)).first()[0]
    cuts = sorted(set(cuts or []))
    above = [None, *cuts]
    below = [*cuts, None]
    parts = []
    for low, high in zip(above, below):
        inside = F.lit(True)
        if low is not None:
            inside &= F.col("doc_id") > low
        if high is not None:
            inside &= F.col("doc_id") <= high
        if low is None:
            inside |= F.col("doc_id").isNull()
        parts.append(docs.filter(inside))
    return parts[::-1]


def dedup_lines(docs: DataFrame, ws: Workspace, batches: int = 4) -> DataFrame:
    """``docs`` with its repeated lines left out of ``text``, and n_lines, n_dropped."""
    runs = LineRuns(ws, int(ws.spark.conf.get("spark.sql.shuffle.partitions")))
    for batch in batches_of(docs, batches):
        runs.add(lines_of(batch))
    repeated = ws.write(runs.repeated(), "repeated_lines")
    own_id, own_lines, kept_ = free(docs, "_id", "_dropped", "_kept")
    dropped = (
        lines_of(docs)
        .join(repeated, "line")
        .filter(F.col("id") != F.col("holder"))
        .groupBy(F.col("id").alias(own_id))
        .agg(F.collect_set("line").alias(own_lines))
    )
    known = [f"`{c}`" for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    joined = docs.join(
        ws.write(dropped, "dropped_lines"),
        F.coalesce("doc_id", F.lit(_NO_ID)) == F.col(own_id),
        "left",
    )
    lines = F.split(text_or_empty(), "\n")

    def stays(line: Column) -> Column:
        return ~F.coalesce(F.array_contains(F.col(own_lines), line_hash(line)), F.lit(False))

    kept = F.when(F.col(own_lines).isNull(), lines).otherwise(F.filter(lines, stays))
    result = let(
        kept,
        lambda k: F.struct(
            F.array_join(k, "\n").alias("text"),
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(k)).cast("bigint").alias("n_dropped"),
        ),
    )
    return joined.select(*known, result.alias(kept_)).select(
        *known, *(f"`{kept_}`.{c}" for c in ("text", "n_lines", "n_dropped"))
    )
