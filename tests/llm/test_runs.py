"""Periodic runs: tiles and stitching against all runs found by comparing words."""

import hashlib
import random
import re
import zlib
from functools import partial

import pytest

from reviewtide.llm import runs
from reviewtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(words: list) -> list[tuple[int, int, int]]:
    """(start, period, length) of all runs."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in found.items())


def kept(words: list, found) -> list:
    gone = {i for s, q, n in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def words_of(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def invented(rng: random.Random, n: int) -> str:
    words: list[str] = []
    few = rng.choice([1, 2, 3, 60])
    while len(words) < n:
        some = [str(rng.randrange(few)) for _ in range(rng.randint(1, max(1, n // 5)))]
        words += some * rng.choice([1, 1, 2, 4, 9])
    return rng.choice([" ", " \n", "\t"]).join(words[:n])


def texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    return [invented(rng, rng.choice([0, 1, 5, 6, 7, 9, 25, 80, 300])) for _ in range(150)]


def result(df) -> list[tuple]:
    return sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
        for r in df.collect()
    )


def expected(docs) -> list[tuple]:
    rows = []
    for doc_id, text in docs:
        words = words_of(text)
        found = brute(words)
        rows.append((doc_id is not None, doc_id or 0, len(words), found, " ".join(kept(words, found))))
    return sorted(rows)


def test_z_function():
    rng = random.Random(3)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        z = runs.z_function(s)
        for i in range(1, len(s)):
            n = next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i)
            assert z[i] == n


def test_whole_texts(frame, docs, ws):
    given = [*docs, *enumerate(texts(1), 1000)]
    assert result(runs.collapse_runs(frame(given), ws)) == expected(given)


@pytest.mark.parametrize("tile, low", [(8, 1), (16, 2), (64, 3)])
def test_tiles_and_stitching(frame, ws, tile, low):
    """Tiny tiles: nearly every text is cut, and runs reach over many tiles."""
    sizes = runs.Tiles(tile, low)
    given = list(enumerate(texts(tile)))
    plain = frame(given).select("doc_id", "text")
    assert result(runs.collapse_runs(plain, ws, sizes)) == expected(given)
    pieces = plain.selectExpr("doc_id row", "text").mapInArrow(
        partial(runs.cut, tiles=sizes), "row bigint, level int, at bigint, n_words bigint, words binary"
    )
    assert pieces.groupBy("row", "level").count().filter("count > 3").count() > 10


def test_one_long_text(frame, ws):
    """Above the size of a tile, with the tiles as they are."""
    rng = random.Random(8)
    some = [str(rng.randrange(50)) for _ in range(30_000)]
    words = [*(str(k) for k in range(90_000)), *(some * 5), "x", *(["y", "z"] * 70_000)]
    got = result(runs.collapse_runs(frame([(1, " ".join(words)), (2, "a")]), ws))
    assert [r[2] for r in got] == [len(words), 1]
    long = {(s, q, n) for s, q, n in got[0][3] if n > 1000}
    assert long == {(90_000, 30_000, 150_000), (240_001, 2, 140_000)}
    assert got[0][4] == " ".join(kept(words, got[0][3]))


def test_odd_rows(frame, empty, ws):
    assert runs.collapse_runs(empty, ws).count() == 0
    given = [(None, "a " * 8), (None, None), (3, "a b " * 4), (3, "a b " * 4), (3, ""), (4, "\u00a0 " * 6), (5, " \n")]
    assert result(runs.collapse_runs(frame(given), ws)) == expected(given)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_op11(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = {tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).select(*columns).collect()}
    want, changed = set(), 0
    for doc_id, text in rows:
        words = words_of(text)
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        found = brute(words)
        best = min(found, key=lambda r: (-r[2], r[0], r[1]), default=None)
        four = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
        lines = "".join(f"{s},{k},{q}\n" for s, q, k in found)
        want.add((doc_id, len(found), *four, sha(lines), sha(" ".join(kept(words, found)))))
    assert changed > 5 and got == want
