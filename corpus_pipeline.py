"""From raw documents to token ids: clean, deduplicate, mix, encode.

``run`` applies the stages one after another; each reads what the one before has written.
All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewtide.llm import bpe, exact, mixing, ngram_join, quality
from reviewtide.llm.common import documents, packed, visible_to_workers, workspace_of
from reviewtide.session import use_utc

#: Small sources up to twice; as few tokens as use every document at least once.
MIX = mixing.Mix(max_repeats=2.0)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    return quality.clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest of each group of texts that are equal but for white space."""
    return exact.deduplicated(docs, workspace_of(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group linked by similar word 5-grams."""
    return ngram_join.one_of_each(docs, workspace_of(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each use of a document in the mixture."""
    whole, back = packed(docs, "doc_id", "source", "text")
    return mixing.realised(whole, workspace_of(spark), MIX).select(*back)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mixture doc_id, source, ids, and hashes of the ids and of the text they decode to."""
    visible_to_workers(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = docs.select("doc_id", "source", "text")
    both = bpe.encode_and_decode(texts, ranks, public_tokenizers.PATTERN)
    return bpe.digests(both.withColumn("token_ids", F.col("ids")))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources", mix_sources),
    ("byte-level BPE", byte_bpe),
]

#: SQL cannot express the chains of near duplicates, nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible_to_workers(use_utc(spark))
    ws = workspace_of(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = ws.path(name.replace(" ", "_").replace("-", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
