"""Alignment of two tokenizers against a plain walk over both token sequences."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reviewtide.llm import alignment
from reviewtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_of_letters() -> dict[str, int]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


@pytest.fixture(scope="module")
def both():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = byte_of_letters()

    def a(text):
        ids = tokenizer.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(letters[c] for c in tokenizer.id_to_token(i))) for i in ids]

    def b(text):
        def data(i):
            piece = pieces.id_to_piece(i)
            return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

        return [(i, data(i)) for i in pieces.encode(text)]

    return a, b


def walked(both, text):
    """Both token lists, the groups, and how many pairs overlap."""
    if not text:
        return [], [], [], 0
    x, y = (encode(text) for encode in both)
    whole = (" " + text).encode()
    if any(b"".join(t for _, t in side) != whole for side in (x, y)):
        return [], [], [], 0
    groups, i, j, at_a, at_b = [], 0, 0, 0, 0
    now = ([], [])
    while i < len(x) or j < len(y):
        if at_a <= at_b and i < len(x) and (at_a < at_b or not now[0]):
            now[0].append(x[i][0])
            at_a += len(x[i][1])
            i += 1
        else:
            now[1].append(y[j][0])
            at_b += len(y[j][1])
            j += 1
        if at_a == at_b:
            groups.append(now)
            now = ([], [])
    # Inside a group no two ends are common, so each end but the last starts one more overlap.
    overlaps = sum(len(g[0]) + len(g[1]) - 1 for g in groups)
    return x, y, groups, overlaps


def expected(both, docs):
    found = [(d, *walked(both, text)) for d, text in docs]
    links = [[(g[0][-1], g[1][-1]) for g in groups] for _, _, _, groups, _ in found]
    counts = Counter(pair for pairs in links for pair in pairs)
    highest: Counter = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    rows = []
    for (d, x, y, groups, overlaps), pairs in zip(found, links):
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        best = sum(counts[p] == highest[p[1]] for p in pairs)
        rows.append((d, len(x), len(y), len(groups), len(pairs), best, sum(counts[p] for p in pairs), digest, overlaps, text))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_gallop(seed):
    rng = np.random.default_rng(seed)
    for _ in range(200):
        long = np.unique(rng.integers(0, 300, rng.integers(0, 80)))
        short = np.unique(rng.integers(0, 300, rng.integers(0, 40)))
        guess = rng.integers(-5, 100, len(short))
        assert (alignment.gallop(short, long, guess) == np.searchsorted(long, short)).all()


def odd_texts() -> list[str]:
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\t", "the", "Der", "été", "naïve", "12", "3.5", "!!", "🙂", "𐍈", "▁", " ", "<s>",
             "<0x41>", "<|endoftext|>", "don't", "x" * 40, "日本語", "\x00"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(200)]


@pytest.mark.parametrize("hot_share", [1, 50, 100_000])
def test_table(frame, docs, ws, both, monkeypatch, hot_share):
    """With none, some and nearly all pairs among the frequent ones."""
    given = [*docs, *enumerate(odd_texts(), 1000), (None, "a b c"), (7, docs[7][1]), (7, None)]
    monkeypatch.setattr(alignment.link_scores, "__defaults__", (hot_share,))
    got = alignment.aligned_tokens(frame(given), ws, A, B)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_overlaps", "groups")
    rows = sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)
    want = sorted(((*r[:7], *r[8:]) for r in expected(both, given)), key=repr)
    assert rows == want
    assert sum(r[1] == 0 for r in rows) > 20


def test_bytes_of_a_batch_are_checked_at_once():
    """Before, each token's bytes were looked up by themselves."""

    class Refusing(list):
        def __getitem__(self, k):
            raise AssertionError("looked up one by one")

    with open(A, encoding="utf-8") as file, open(B, "rb") as model:
        both = alignment.Both(alignment.ByteLevel(file.read()), alignment.Pieces(model.read()))
    strange = "\u2581"  # read as a space by the pieces
    mixed = ["some words", "", strange, "more of them"]
    assert [len(x) > 0 for x in both.tokens(mixed)[0]] == [True, False, False, True]
    both.a.tokens, both.b.tokens = Refusing(both.a.tokens), Refusing(both.b.tokens)
    for ids in both.tokens(["some words", "", "more of them"]):
        assert [len(x) > 0 for x in ids] == [True, False, True]


def test_no_rows(empty, ws):
    assert alignment.aligned_tokens(empty, ws, A, B).count() == 0


def test_op13(spark, both):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in QUERIES["op13_token_alignment"](spark, SF).select(*COLUMNS).collect()}
    assert got == {r[:8] for r in expected(both, map(tuple, rows))}
