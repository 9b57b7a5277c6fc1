"""Exact, line, n-gram and suffix deduplication against their contracts in plain Python."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewtide.llm import exact, lines, ngram_join, suffix_dedup
from reviewtide.llm.components import components
from reviewtide.llm.loser_tree import common, front_coded, merge

EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def got(df, *columns):
    return set(map(tuple, df.select(*columns).collect()))


def test_exact(frame, docs, ws):
    assert got(exact.exact_duplicates(frame(docs), ws), *EXACT) == brute.exact(docs)


def test_exact_with_hashes_that_collide(frame, docs, ws):
    """Identifiers are verified: a hash of four values gives the same result."""
    weak = exact.exact_duplicates(frame(docs), ws, lambda c: F.pmod(F.xxhash64(c), F.lit(4)))
    assert got(weak, *EXACT) == brute.exact(docs)


def test_exact_odd_rows(frame, empty, ws):
    assert exact.exact_duplicates(empty, ws).count() == 0
    assert exact.deduplicated(empty, ws).columns == empty.columns
    odd = frame([(None, "a b"), (2, "ab"), (3, None), (3, ""), (4, "ab "), (4, "ab "), (None, None)])
    marks = exact.exact_duplicates(odd, ws)
    assert marks.filter("kept").count() == 2
    assert got(marks.filter("text_sha256 = sha2('ab', 256)"), "keep_id", "group_size") == {(4, 4)}
    kept = exact.deduplicated(odd, ws)
    assert sorted(kept.columns) == sorted(odd.columns)
    assert sorted(r["text"] or "" for r in kept.select("text").collect()) == ["", "ab "]


def test_deduplicated_rows_of_null_texts(frame, ws):
    """Repeated doc_ids whose texts are all null keep their other columns."""
    odd = frame([(5, None), (5, None), (6, "a")])
    kept = exact.deduplicated(odd, ws).select(*odd.columns)
    assert got(kept, *odd.columns) == got(odd, *odd.columns) and kept.count() == 2


def test_deduplicated_keeps_one_of_each(frame, docs, ws):
    kept = exact.deduplicated(frame(docs), ws)
    assert got(kept, "doc_id") == {(x[0],) for x in brute.exact(docs) if x[3]}


def test_chunks_are_the_text(spark):
    text = "Abc. Def! " * 300 + "x" * 5000
    df = spark.createDataFrame([(text,)], "t string")
    parts = df.select(F.regexp_extract_all("t", F.lit(exact.CHUNK), F.lit(0))).first()[0]
    assert "".join(parts) == text and max(map(len, parts)) <= exact.MAX_CHUNK


@pytest.mark.parametrize("batches", [1, 2, 4, 7])
def test_lines(frame, docs, ws, batches):
    kept = lines.dedup_lines(frame(docs), ws, batches)
    columns = ("doc_id", "n_lines", "n_dropped", F.sha2("text", 256))
    assert got(kept, *columns) == brute.line_dedup(docs)


def test_line_runs_in_any_order_of_batches(frame, docs, ws):
    """Levels are compacted, and a holder may come in any batch."""
    runs = lines.LineRuns(ws, 4, fanout=3)
    all_lines = lines.lines_of(frame(docs))
    for k in (3, 0, 4, 1, 2):
        runs.add(all_lines.filter(F.col("id") % 5 == k))
    assert [len(level) for level in runs.levels] == [2, 1]
    expected = all_lines.groupBy("line").agg(F.count("*").alias("n"), F.max("id")).filter("n > 2").drop("n")
    assert got(runs.repeated(), "line", "holder") == got(expected, *expected.columns)


def test_settled_lines_are_not_recorded_again(frame, ws):
    line = "a line of more than twenty characters"
    runs = lines.LineRuns(ws, 2)
    runs.add(lines.lines_of(frame([(k, line) for k in range(10, 14)])))
    runs.add(lines.lines_of(frame([(k, line) for k in range(5)])))
    assert got(runs.repeated(), "holder") == {(13,)}
    assert runs.levels[1][0].agg(F.sum("n_docs")).first()[0] == 4


def test_lines_odd_rows(frame, empty, ws):
    assert lines.dedup_lines(empty, ws).count() == 0
    line = "This line is found in all of them."
    odd = frame([(None, line), (1, line), (2, None), (3, f" {line.upper()}\t\n{line}"), (3, line)])
    kept = got(lines.dedup_lines(odd, ws), "doc_id", "text", "n_dropped")
    assert kept == {(None, "", 1), (1, "", 1), (2, "", 0), (3, f" {line.upper()}\t\n{line}", 0), (3, line, 0)}


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (2, 50)])
def test_ngram_join(frame, docs, ws, words, percent):
    like = ngram_join.Similarity(words, percent)
    found = ngram_join.similar_groups(frame(docs), ws, like)
    assert got(found, "doc_id", "n_shingles", "component_id") == brute.jaccard_components(docs, words, percent)


def test_ngram_join_of_a_hot_family(frame, ws):
    """Some hundred near copies: several groups, compared with their first group only."""
    base = " ".join(f"w{i % 97}x{i}" for i in range(120)).split()
    docs = []
    for k in range(300):
        words = list(base)
        words[k % 120] = f"other{k}"
        if k % 3 == 0:
            words[(k * 7) % 120] = f"more{k}"
        docs.append((k, " ".join(words)))
    docs += [(1000 + k, " ".join(f"z{k}y{i}" for i in range(50))) for k in range(50)]
    found = ngram_join.similar_groups(frame(docs), ws, ngram_join.Similarity(3, 90))
    assert got(found, "doc_id", "n_shingles", "component_id") == brute.jaccard_components(docs)


def unlinked_family(n: int, changes: int, seed: int) -> list:
    """Texts of one base that share most of their shingles, too few to be linked."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for k in range(n):
        words = list(base)
        for at in rng.choice(20, changes, replace=False):
            words[int(at) * 10 + 4] = f"own{k}n{at}"
        docs.append((k, " ".join(words)))
    return docs


def test_ngram_join_pairs_names_once(frame, ws, monkeypatch):
    """Before, two names were paired for each of the shingles they share."""
    docs = unlinked_family(60, 5, 3)
    written, write = {}, type(ws).write
    monkeypatch.setattr(type(ws), "write", lambda self, df, name: written.__setitem__(name, write(self, df, name)) or written[name])
    like = ngram_join.Similarity(5, 80)
    found = ngram_join.similar_groups(frame(docs), ws, like)
    assert got(found, "doc_id", "n_shingles", "component_id") == brute.jaccard_components(docs, 5, 80)
    unlike = written["unlike"]
    assert unlike.count() <= 1.5 * unlike.select("x", "y").distinct().count()


def test_ngram_join_of_components_of_several_groups(frame, ws, monkeypatch):
    """Components of far more sets than a group has, beside sets that are linked late or not."""
    monkeypatch.setattr(ngram_join, "GROUP_SETS", 3)
    docs = unlinked_family(40, 5, 4) + [(100 + k, t) for k, t in unlinked_family(40, 2, 5)]
    docs += [(200 + k, f"{t} {docs[k][1][:300]}") for k, t in unlinked_family(20, 4, 6)]
    found = ngram_join.similar_groups(frame(docs), ws, ngram_join.Similarity(5, 70))
    assert got(found, "doc_id", "n_shingles", "component_id") == brute.jaccard_components(docs, 5, 70)


def test_ngram_join_odd_rows(frame, empty, ws):
    assert ngram_join.similar_groups(empty, ws).count() == 0
    text = "one two three four five six seven"
    odd = frame([(None, text), (2, text), (3, text.upper()), (3, None), (4, ""), (5, "one"), (6, "One")])
    found = got(ngram_join.similar_groups(odd, ws, ngram_join.Similarity(3, 90)), "doc_id", "n_shingles", "component_id")
    assert found == {(None, 5, None), (2, 5, 2), (3, 5, 2), (3, 0, 3), (4, 0, 4), (5, 1, 5), (6, 1, 5)}
    kept = ngram_join.one_of_each(odd, ws)
    assert sorted(kept.columns) == sorted(odd.columns)
    assert got(kept, "doc_id") == {(None,), (2,), (4,), (5,)}


def test_components_of_a_chain(spark, ws):
    chain = [(k, k + 1) for k in range(40) if k != 20]
    links = spark.createDataFrame([(b, a) if a % 3 else (a, b) for a, b in chain], "a bigint, b bigint")
    assert got(components(links, ws), "node", "label") == {(k, 0 if k < 21 else 21) for k in range(41)}


def test_shared_prefix_bound():
    """Linked sets share as many of their first shingles as they must, in any order."""
    rng = np.random.default_rng(2)
    for words, percent in ((3, 90), (5, 80)):
        like = ngram_join.Similarity(words, percent)
        for n in range(1, 150):
            order = rng.permutation(2 * n + 2).tolist()
            for more in range(like.may_miss(n) + 1):
                a = set(range(n))
                b = set(range(more, n)) | set(range(n, n + max(0, int(rng.integers(-1, 3)))))
                if 100 * len(a & b) < percent * len(a | b):
                    continue
                firsts = [sorted(s, key=order.__getitem__)[: like.first(len(s))] for s in (a, b)]
                must = max(like.must_share(len(a)), like.must_share(len(b)))
                assert len(set(firsts[0]) & set(firsts[1])) >= must


def test_loser_tree():
    rng = np.random.default_rng(5)
    for _ in range(50):
        runs = [
            sorted({bytes(rng.integers(97, 99, rng.integers(0, 9)).tolist()) for _ in range(rng.integers(0, 12))})
            for _ in range(rng.integers(1, 8))
        ]
        coded = [((n, rest, 1) for n, rest in list(front_coded(run))) for run in runs]
        merged = list(merge(coded))
        assert [s for _, s, _ in merged] == sorted(s for run in runs for s in run)
        before = b""
        for n, s, _ in merged:
            assert n == common(before, s)
            before = s


SUFFIX = ("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2)


def removed(df, many=suffix_dedup.MANY, ws=None):
    kept = suffix_dedup.remove_repeats(df, ws, many)
    return got(kept, "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))


@pytest.mark.parametrize("many", [suffix_dedup.MANY, 1])
def test_suffixes(frame, docs, ws, many):
    """Also with each place counted as crowded, so that strings are told apart by hashes."""
    assert removed(frame(docs), many, ws) == brute.suffix_dedup(docs)


def test_suffixes_of_cut_passages(frame, ws):
    """Repeats that begin and end anywhere, of lengths about the limit."""
    rng = np.random.default_rng(11)
    base = ["".join(map(chr, rng.integers(97, 123, 500))) for _ in range(3)]
    docs = []
    for k in range(60):
        own = "".join(map(chr, rng.integers(97, 123, int(rng.integers(0, 150)))))
        b, i = base[k % 3], int(rng.integers(0, 300))
        n = int(rng.choice([190, 199, 200, 201, 215, 260, 330]))
        docs.append((k, own + b[i : i + n] + own[::-1]))
    assert removed(frame(docs), ws=ws) == brute.suffix_dedup(docs)


def test_crowded_anchors_are_not_brought_together(frame, ws, monkeypatch):
    """A passage in many surroundings: its anchors reach no merge task, others do."""
    rng = np.random.default_rng(6)

    def letters(n):
        return "".join(map(chr, rng.integers(97, 123, n)))

    passage, rare = letters(400), letters(300)
    docs = [(k, letters(120) + passage + letters(120)) for k in range(50)]
    docs += [(100 + k, letters(50) + rare + passage[150:390] + letters(50)) for k in range(3)]
    merged, merge_ = [], suffix_dedup.merged_reaches

    def seen(runs, *rest):
        merged.extend(runs.collect())
        return merge_(runs, *rest)

    monkeypatch.setattr(suffix_dedup, "merged_reaches", seen)
    assert removed(frame(docs), 10, ws) == brute.suffix_dedup(docs)
    sent = {}
    for run in merged:
        string = b""
        for n, end, _ in suffix_dedup._run(run):
            string = string[:n] + end
            sent.setdefault(string[: suffix_dedup.SURE], []).append(string)
    assert sent and max(map(len, sent.values())) <= 10


@pytest.mark.parametrize("many", [2, 5])
def test_suffixes_partly_crowded(frame, docs, ws, many):
    assert removed(frame(docs), many, ws) == brute.suffix_dedup(docs)


def test_suffixes_odd_rows(frame, empty, ws):
    assert suffix_dedup.remove_repeats(empty, ws).count() == 0
    text = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(250))
    found = removed(frame([(None, text), (1, text), (2, None), (3, "é" * 99)]), ws=ws)
    assert {x[:4] for x in found} == {(None, 250, 250, 1), (1, 250, 250, 1), (2, 0, 0, 0), (3, 198, 0, 0)}
