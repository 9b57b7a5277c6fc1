"""Sharding and mixing."""

import zlib
from collections import Counter, defaultdict
from math import exp, log

import brute
import pytest
from pyspark.sql import functions as F

from reviewtide.llm import mixing, sharding
from reviewtide.llm.sharding import Cutter, Leaf


def placed(df, ws, shards=16):
    columns = ("doc_id", "size", "text_crc32", "shard", "slot", "text_sha256")
    return [tuple(r) for r in sharding.shard(df, ws, shards).select(*columns).collect()]


def check_shards(rows, docs, shards):
    texts = defaultdict(list)
    for doc_id, text in docs:
        texts[doc_id].append(text or "")
    assert Counter(r[0] for r in rows) == Counter(d for d, _ in docs)
    slots, sizes, of_text = defaultdict(list), Counter(), defaultdict(set)
    for doc_id, size, crc, shard, slot, sha in rows:
        match = [t for t in texts[doc_id] if brute.sha(t) == sha]
        assert size == len(match[0].encode()) + 1 and crc == zlib.crc32(match[0].encode())
        slots[shard].append(slot)
        sizes[shard] += size
        of_text[sha].add(shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())
    groups = Counter()
    for _, size, *_, sha in rows:
        groups[sha] += size
    in_order = [groups[sha] for sha in sorted(groups)]
    order = [next(iter(of_text[sha])) for sha in sorted(groups)]
    assert order == sorted(order) and set(order) <= set(range(shards))
    assert max(sizes.values()) <= brute.min_capacity(in_order, shards)


@pytest.mark.parametrize("shards", [1, 4, 16, 200])
def test_sharding(frame, docs, ws, shards):
    check_shards(placed(frame(docs), ws, shards), docs, shards)


@pytest.mark.parametrize("digits", [1, 2])
def test_leaves_are_split(frame, ws, monkeypatch, digits):
    """With few leaves at first, cuts fall inside them until they are split."""
    monkeypatch.setattr(sharding, "FIRST_DIGITS", digits)
    docs = [(k, "x" * (k * 37 % 101)) for k in range(400)]
    check_shards(placed(frame(docs, clash=False), ws, 7), docs, 7)


def test_a_group_larger_than_a_share(frame, ws):
    docs = [(k, "the same text in half of them") for k in range(100)]
    docs += [(100 + k, f"text {k} of its own, here") for k in range(100)]
    check_shards(placed(frame(docs, clash=False), ws), docs, 16)
    counts = Counter(r[3] for r in placed(frame(docs, clash=False), ws))
    assert len(counts) >= 15


def test_sharding_odd_rows(frame, empty, ws):
    assert placed(empty, ws) == []
    docs = [(None, None), (None, ""), (1, "a"), (1, "a"), (1, "b")]
    check_shards(placed(frame(docs), ws, 3), docs, 3)


def test_smallest_capacity():
    for sizes in ([3, 1, 4, 1, 5, 9, 2, 6], [1] * 10, [100, 1, 1], [7]):
        leaves = [Leaf(f"{k:03x}", size, 1) for k, size in enumerate(sizes)]
        for shards in (1, 2, 3, 5):
            assert Cutter(leaves, shards).capacity() == brute.min_capacity(sizes, shards)


def weights_of(tokens, a):
    total = sum(tokens.values())
    power = {s: exp(a * log(n / total)) for s, n in tokens.items() if n}
    z = sum(power.values())
    return {s: p / z for s, p in power.items()}


def entropy(weights):
    return -sum(w * log(w) for w in weights.values())


SOURCES = {"big": 60, "middle": 25, "small": 6, "tiny": 3}


def sourced(frame, extra=()):
    docs, k = [], 0
    for source, n in SOURCES.items():
        for i in range(n):
            docs.append((k, " ".join(["word"] * (5 + (k * 7) % 11)), source))
            k += 1
    df = frame([(d, t) for d, t, _ in docs], clash=False)
    of = F.create_map(*(x for d, _, s in docs for x in (F.lit(d).cast("bigint"), F.lit(s))))
    tokens = Counter()
    for _, t, s in docs:
        tokens[s] += len(t.split())
    return df.withColumn("source", of[F.col("doc_id")]), tokens


def mixed(df, ws, mix):
    return mixing.mixture(df, ws, mix).select("doc_id", "source", "n_tokens", "exponent", "weight", "copies").collect()


@pytest.mark.parametrize("target", [0.8, 0.95, 1.0])
def test_target_entropy(frame, ws, target):
    df, tokens = sourced(frame)
    rows = mixed(df, ws, mixing.Mix(entropy=target, budget=1.0))
    (a,) = {r["exponent"] for r in rows}
    assert entropy(weights_of(tokens, a)) >= target * log(4) - 1e-9
    assert a == 1.0 or entropy(weights_of(tokens, a + 1e-9)) < target * log(4) + 1e-12
    expected = weights_of(tokens, a)
    assert all(abs(r["weight"] - expected[r["source"]]) < 1e-12 for r in rows)


@pytest.mark.parametrize("budget", [None, 0.4, 1.0, 1.7])
def test_quotas_are_met(frame, ws, budget):
    """Each source gives its quota of tokens, but for less than one document."""
    df, tokens = sourced(frame)
    rows = mixed(df, ws, mixing.Mix(entropy=0.9, budget=budget))
    used, copies = Counter(), defaultdict(set)
    for r in rows:
        used[r["source"]] += r["copies"] * r["n_tokens"]
        copies[r["source"]].add(r["copies"])
    weights = {r["source"]: r["weight"] for r in rows}
    total = sum(tokens.values())
    least = max(tokens[s] / weights[s] for s in tokens) if budget is None else budget * total
    for s in tokens:
        quota = round(weights[s] * least)
        assert quota - 16 < used[s] <= quota
        assert max(copies[s]) - min(copies[s]) <= 1
    if budget is None:
        assert min(r["copies"] for r in rows) == 1


def test_repetition_limit(frame, ws):
    df, tokens = sourced(frame)
    rows = mixed(df, ws, mixing.Mix(max_repeats=2.0))
    assert {r["copies"] for r in rows} == {1, 2}
    (a,) = {r["exponent"] for r in rows}
    shares = [n / sum(tokens.values()) for n in tokens.values()]
    assert abs((max(shares) / min(shares)) ** (1 - a) - 2) < 1e-6
    both = mixed(df, ws, mixing.Mix(entropy=1.0, max_repeats=3.0, budget=1.0))
    w = {r["source"]: r["weight"] for r in both}
    assert max(w[s] * sum(tokens.values()) / tokens[s] for s in tokens) <= 3.0 + 1e-6
    with pytest.raises(ValueError):
        mixing.Mix(max_repeats=1.0, budget=2.0)


def test_realised_passes(frame, ws):
    df, _ = sourced(frame)
    mix = mixing.Mix(entropy=1.0, budget=1.3, seed=5)
    copies = {r["doc_id"]: r["copies"] for r in mixed(df, ws, mix)}
    rows = mixing.realised(df, ws, mix).select("doc_id", "source", "pass", "block_key", "document_key").collect()
    assert Counter(r["doc_id"] for r in rows) == Counter({d: c for d, c in copies.items() if c})
    orders = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["block_key"], r["document_key"])):
        orders[r["source"], r["pass"]].append(r["doc_id"])
    assert orders["tiny", 0] != orders["tiny", 1] and sorted(orders["tiny", 0]) == sorted(orders["tiny", 1])


def test_mixing_odd_rows(frame, empty, ws):
    assert mixing.mixture(empty, ws, mixing.Mix(entropy=0.9, budget=1.0)).count() == 0
    df = frame([(1, "a b"), (2, None), (3, ""), (None, "a"), (4, "a b c"), (4, "a b c")])
    df = df.withColumn("source", F.when(F.col("doc_id") == 4, "s").when(F.col("doc_id") == 2, "none"))
    rows = mixing.mixture(df, ws, mixing.Mix(max_repeats=2.0))
    assert sorted(rows.columns) == sorted(df.columns)
    found = Counter((r["doc_id"], r["source"], r["copies"] > 0) for r in rows.collect())
    assert found[(4, "s", True)] == 2 and found[(1, None, True)] == 1 and found[(None, None, True)] == 1
    assert found[(2, "none", False)] == 1
