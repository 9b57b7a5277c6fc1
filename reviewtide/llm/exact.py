"""Exact deduplication by content-defined chunk recipes.

A text without its white space is cut into chunks where its content says so: at the
end of a sentence, between a least and a largest length. Each chunk gets an identifier,
its hash, which is verified against the chunks of all documents: every chunk travels
once, and a hash that stands for two chunks is found out. A document is then its recipe,
the ordered list of its identifiers, and equal texts are equal recipes; where a hash was
found to be ambiguous, the chunks themselves are added to the recipes that use it. So
long documents never travel; recipes do.

Null texts count as empty, and empty texts equal each other. Of equal texts the row with
the longest original text stays, then the one of smallest doc_id (null last); of rows
that repeat a doc_id and a text, one stays. A hot group is counted before it is shuffled,
and the join that hands out its result is one that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewtide.llm.common import free, text_or_empty, without_spaces
from reviewtide.operators.sizing import checked_broadcast
from reviewtide.session import Workspace

MIN_CHUNK = 64
MAX_CHUNK = 1024
#: A chunk ends with a sentence, if one of these letters begins the next: about every second.
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 1}}}?[.!?](?=[A-MÀ-Ý]|$)|.{{1,{MAX_CHUNK}}}"

Hash = Callable[[Column], Column]


def _chunked(docs: DataFrame) -> DataFrame:
    narrow = docs.select("doc_id", text_or_empty().alias("text"))
    normal = narrow.select(
        "doc_id", F.length("text").alias("n_chars"), without_spaces(F.col("text")).alias("normal")
    )
    return normal.select(
        "doc_id",
        "n_chars",
        F.sha2("normal", 256).alias("text_sha256"),
        F.regexp_extract_all("normal", F.lit(CHUNK), F.lit(0)).alias("chunks"),
    )


def ambiguous_hashes(docs: DataFrame, hash_: Hash) -> DataFrame:
    """Hashes of more than one chunk, found by comparing the chunks of all documents."""
    chunks = _chunked(docs).select(F.explode(F.array_distinct("chunks")).alias("chunk"))
    distinct = chunks.select(hash_(F.col("chunk")).alias("id"), "chunk").distinct()
    return distinct.groupBy("id").count().filter("count > 1").select("id")


def recipes(docs: DataFrame, ws: Workspace, hash_: Hash = F.xxhash64) -> DataFrame:
    """A written table: doc_id, n_chars, text_sha256, recipe, doubted (array), row (unique)."""
    row = F.monotonically_increasing_id()
    plain = ws.write(
        _chunked(docs).select(
            "doc_id",
            "n_chars",
            "text_sha256",
            F.transform("chunks", lambda c: hash_(c)).alias("recipe"),
            F.array().cast("array<string>").alias("doubted"),
            row.alias("row"),
        ),
        "recipes",
    )
    ambiguous = ws.write(ambiguous_hashes(docs, hash_), "ambiguous")
    if ambiguous.isEmpty():
        return plain
    # Row numbers hold within one table only, so this one has the chunks as well.
    whole = ws.write(
        _chunked(docs).select("*", F.transform("chunks", lambda c: hash_(c)).alias("recipe"), row.alias("row")),
        "chunked",
    )
    doubted = (
        whole.select("row", F.posexplode("chunks").alias("at", "chunk"))
        .withColumn("id", hash_(F.col("chunk")))
        .join(ambiguous, "id", "left_semi")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("at", "chunk")))["chunk"].alias("doubted"))
    )
    none = F.array().cast("array<string>")
    return ws.write(
        whole.drop("chunks").join(doubted, "row", "left").withColumn("doubted", F.coalesce("doubted", none)),
        "recipes",
    )


def exact_duplicates(docs: DataFrame, ws: Workspace, hash_: Hash = F.xxhash64) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    known = recipes(docs, ws, hash_)
    best = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("row")))
    groups = (
        known.groupBy("recipe", "doubted")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .filter("group_size > 1")
        .select(
            "recipe",
            "doubted",
            "group_size",
            F.bitwise_not("best.id").alias("keep_id"),
            F.bitwise_not("best.row").alias("keep_row"),
        )
    )
    # Written, so that both sides of the join are shuffled for it and a hot group can be split.
    of = known.join(ws.write(groups, "groups"), ["recipe", "doubted"], "left")
    alone = F.col("group_size").isNull()
    return of.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame, ws: Workspace) -> DataFrame:
    """One row of each group of equal texts, in the columns of ``docs``.

    Only (doc_id, hash) of rows that go are joined; their size is measured before they
    are broadcast. Rows that share both with a row that stays are settled apart.
    """
    marks = ws.write(exact_duplicates(docs, ws), "marks")
    own_id, own_sha, sha, rest = free(docs, "_id", "_sha", "_sha256", "_row")
    by_row = ws.write(
        marks.groupBy(F.col("doc_id").alias(own_id), F.col("text_sha256").alias(own_sha))
        .agg(F.max("kept").alias("_stays"), (F.count(F.lit(1)) > 1).alias("_repeated"))
        .filter("_repeated OR NOT _stays"),
        "marked",
    )
    keys = by_row.select(own_id, own_sha)
    hashed = docs.withColumn(sha, F.sha2(without_spaces(text_or_empty()), 256))
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(sha) == F.col(own_sha))
    others = hashed.join(checked_broadcast(keys), same, "left_anti").drop(sha)
    repeated = by_row.filter("_repeated AND _stays").select(own_id, own_sha)
    if repeated.isEmpty():
        return others
    names = [c for c in docs.columns if c != "doc_id"]
    longest = F.max_by(F.struct(*(F.col(f"`{c}`") for c in names)), F.coalesce(F.length("text"), F.lit(-1)))
    settled = (
        hashed.join(repeated, same, "left_semi")
        .groupBy("doc_id", sha)
        .agg(longest.alias(rest))
        .select(*("doc_id" if c == "doc_id" else F.col(f"`{rest}`.`{c}`") for c in docs.columns))
    )
    return others.unionByName(settled)
