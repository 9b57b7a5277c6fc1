"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm import (
    alignment,
    bpe,
    exact,
    html_extract,
    lines,
    mixing,
    ngram_join,
    packing,
    quality,
    runs,
    sharding,
    suffix_dedup,
    tokenfile,
)
from reviewtide.llm.common import (
    documents,
    let,
    text_or_empty,
    visible_to_workers,
    words_of,
    workspace_of,
)
from reviewtide.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: Weights near equal, no source more than four times, as many tokens as there are.
MIX = mixing.Mix(entropy=0.95, max_repeats=4.0, budget=1.0)


def register(query: Query) -> Query:
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(visible_to_workers(use_utc(spark)), sf_dir)

    QUERIES[query.__name__] = in_utc
    return query


@register
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixture(documents(spark, sf_dir), workspace_of(spark), MIX)
    return mixed.select(
        "doc_id", "source", "n_tokens",
        F.round("exponent", 9).alias("exponent"), F.round("weight", 9).alias("weight"), "copies",
    )


@register
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir))
    return judged.select("doc_id", *(c for c in quality.COLUMNS if c != "clean_text"))


@register
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe.digests(bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN))


@register
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(documents(spark, sf_dir), workspace_of(spark))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@register
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    like = ngram_join.Similarity(words=3, percent=90)
    return ngram_join.similar_groups(documents(spark, sf_dir), workspace_of(spark), like)


@register
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), workspace_of(spark)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_extract.extract(pages, html_extract.trained(pages))


@register
def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace_of(spark).path("token_ids")
    tokenfile.write_ids(
        documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json")
    )
    return tokenfile.read_ids(spark, path).select(
        "doc_id",
        "start",
        F.expr("length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@register
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(documents(spark, sf_dir), workspace_of(spark))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@register
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(documents(spark, sf_dir), workspace_of(spark))


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text; the words of every tenth document (by hash) repeat from some word on."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(hashed / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        begin = F.pmod(g, n)
        period = F.lit(1) + F.floor((n - begin) / (3 + F.pmod(g, F.lit(8))))

        def source(_: Column, i: Column) -> Column:
            at = F.when(i < begin, i.cast("bigint")).otherwise(begin + F.pmod(i - begin, period))
            return F.get(words, at.cast("int"))

        return F.when(n > 0, F.array_join(F.transform(words, source), " ")).otherwise("")

    text = F.when(hashed % 10 == 0, let(words_of(text_or_empty()), repeated)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@register
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse_runs(looped(documents(spark, sf_dir)), workspace_of(spark))
    run = runs.longest()
    line_ends = F.transform(
        "runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *(run[c].alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * run["length"] / run["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(line_ends, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@register
def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = public_tokenizers.path("word_bpe_49k.json")
    found = packing.pack(documents(spark, sf_dir), workspace_of(spark), words, end_id=1)
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@register
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_level, pieces = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    docs = documents(spark, sf_dir)
    return alignment.aligned_tokens(docs, workspace_of(spark), byte_level, pieces, digest=True)
