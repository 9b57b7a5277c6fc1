"""The registered queries: against SQL, against brute force, and the pipeline as a whole."""

import os
from collections import Counter

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from reviewtide.llm import bpe
from reviewtide.llm.oracle import oracles
from reviewtide.llm.queries import QUERIES
from reviewtide.session import Workspace

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return con


@pytest.fixture(scope="module")
def table(duck):
    return duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def result(spark, name, *columns):
    return {tuple(r) for r in QUERIES[name](spark, SF).select(*columns).collect()}


def test_all_are_registered():
    assert set(QUERIES) < set(contract.queries()) and "pipeline" in contract.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(oracles()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(oracles()))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(oracles()[name])
    at = [c[0] for c in cursor.description]
    assert sorted(at) == columns
    expected = sorted((tuple(r[at.index(c)] for c in columns) for r in cursor.fetchall()), key=repr)
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == expected


def test_op3(spark, table):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = bpe.read_ranks(file.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = set()
    for doc_id, text in table:
        ids = library.encode_ordinary(text or "")
        expected.add((doc_id, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text or "")))
    assert result(spark, "op3_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected


def test_op4(spark, table):
    columns = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert result(spark, "op4_line_dedup", *columns) == brute.line_dedup(table)


def test_op5(spark, table):
    columns = ("doc_id", "n_shingles", "component_id")
    assert result(spark, "op5_ngram_jaccard", *columns) == brute.jaccard_components(table)


def test_op6(spark, table):
    rows = result(spark, "op6_sharding", "doc_id", "size", "text_crc32", "shard", "slot", "law", "grown_shard")
    groups, sizes = Counter(), Counter()
    for doc_id, size, crc, shard, _, law, grown in rows:
        text = (table[doc_id][1] or "").encode()
        assert (size, crc, law, grown) == (len(text) + 1, brute.crc(text), "bytes", None)
        groups[brute.sha(text)] += size
        sizes[shard] += size
    assert len(rows) == len(table)
    assert max(sizes.values()) <= brute.min_capacity([groups[g] for g in sorted(groups)], 16)


def test_op7(spark, duck):
    """The article's blocks, as its own markup has them."""
    import html
    import re

    found = {r["page_id"]: r["text"] for r in QUERIES["op7_html_extraction"](spark, SF).collect()}
    for page_id, page in duck.execute("SELECT page_id, html FROM pages").fetchall():
        article = page[page.index("<article>") : page.index("</article>")]
        parts = re.split(r"</?(?:p|h1)>", article)
        texts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in parts]
        assert found[page_id] == "\n\n".join(t for t in texts if t)


def test_op8(spark, table):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, expected = 0, set()
    for doc_id, text in table:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected.add((doc_id, start, len(ids), brute.crc(ids.tobytes())))
        start += len(ids)
    assert result(spark, "op8_token_file", "doc_id", "start", "n_tokens", "ids_crc32") == expected


def test_op9(spark, table):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert result(spark, "op9_suffix_dedup", *columns) == brute.suffix_dedup(table)


def test_pipeline(spark, table):
    """Each stage against brute force on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ws = Workspace(spark)
    try:
        kept = []
        for name, stage in corpus_pipeline.STAGES:
            before = docs
            path = ws.path(name.replace(" ", "_").replace("-", "_"))
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
            kept.append([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()] if "text" in docs.columns else None)
            if name != "byte-level BPE":
                assert docs.columns == before.columns
        cleaned, exact, near, mixed, _ = kept
        passing = {d for d, t in table if (s := brute.base_statistics(t))[0] >= 10 and 5 * s[4] <= s[0]}
        assert {d for d, _ in cleaned} <= passing
        assert {d for d, _ in exact} == {x[0] for x in brute.exact(cleaned) if x[3]}
        assert {d for d, _ in near} == {c for _, _, c in brute.jaccard_components(exact, 5, 80)}
        assert {d for d, _ in mixed} == {d for d, _ in near}
        assert max(Counter(d for d, _ in mixed).values()) <= 2
        texts = dict(mixed)
        for r in docs.collect():
            assert r["decoded_sha256"] == brute.sha(texts[r["doc_id"]])
        assert docs.count() == len(mixed)
        whole = corpus_pipeline.run(spark, SF)
        columns = ("doc_id", "n_tokens", "ids_sha256")
        assert sorted(map(tuple, whole.select(*columns).collect())) == sorted(map(tuple, docs.select(*columns).collect()))
    finally:
        ws.drop()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_tables(spark, frame, empty, name, stage):
    assert stage(spark, empty, SF).count() == 0
    prose = " ".join(f"word{k}" for k in range(30))
    odd = frame([(None, prose), (1, None), (2, ""), (3, prose), (3, prose), (4, f"{prose}\n | a | b | c |")])
    result = stage(spark, odd, SF)
    assert result.count() > 0
    if name != "byte-level BPE":
        assert result.columns == odd.columns
        own = [c for c in odd.columns if c not in ("doc_id", "text", "source", "n_chars")]
        assert all(set(row) == {"en"} for row in result.select(*own).collect())
