"""Byte-level BPE and token files, against the tokenizer libraries."""

import hashlib
import os
import random
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewtide.llm import bpe, tokenfile

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "the", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", " ", "　", "é", "漢", "🙂", "'s", "'", "1", "!!", ",", ".", "-", "<|endoftext|>"]


@pytest.fixture(scope="module")
def encoder():
    with open(RANKS, "rb") as file:
        return bpe.Encoder(bpe.read_ranks(file.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={}
    )


def odd_texts(n: int = 1500) -> list[str]:
    rng = random.Random(8)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def ids_of(text, words):
    return np.frombuffer(bpe.text_ids(text, words), np.int32)


def test_equals_the_library(encoder, library):
    words = bpe.Words(encoder.matches, encoder.letters)
    for text in odd_texts():
        ids = ids_of(text, words)
        assert ids.tolist() == library.encode_ordinary(text), repr(text)
        assert encoder.decoded(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 30_001, "ab" * 4000, "é" * 3001, "the" * 2500 + "x" * 333, "!?" * 2000])
def test_long_matches(encoder, library, text):
    assert encoder.matches(text).tolist() == library.encode_ordinary(text)


def test_joins_at_any_place(encoder):
    """The operation is associative, with the empty string as its unit."""
    rng = random.Random(3)
    for _ in range(200):
        data = "".join(rng.choice(["th", "e", "in", "g", "aa", "é", "0"]) for _ in range(60)).encode()
        a, b = sorted((rng.randint(0, len(data)), rng.randint(0, len(data))))
        x, y, z = (encoder.encoded(part) for part in (data[:a], data[a:b], data[b:]))
        whole = encoder.merged(data)
        assert encoder.join(encoder.join(x, y), z) == encoder.join(x, encoder.join(y, z)) == whole
        assert all(encoder.stable(i, j) for i, j in pairwise(whole))


def test_both_ways_to_merge(encoder):
    for text in odd_texts(300):
        data = text.encode()
        assert encoder._merged_few(data) == encoder._merged_many(data)


def test_forgetting_words(encoder, library):
    words = bpe.Words(encoder.matches, encoder.letters, remembered=3)
    text = "one two three, four five.\nSix one two seven, eight one."
    assert ids_of(text, words).tolist() == library.encode_ordinary(text)
    assert len(words) <= 3


@pytest.mark.parametrize("line_end", ["\n", "\n\n", "\r\n"])
def test_many_short_lines(encoder, library, line_end):
    """Lines without a blank between them: no deeper call for each, no copy of the rest."""
    lines = [f"word{k}" if k % 3 else ("end.", "12", "x")[k % 9 // 3] for k in range(100_000)]
    text = line_end.join([*lines, "a\n\nb\nc", "last."])
    words = bpe.Words(encoder.matches, encoder.letters)
    for _ in range(2):
        assert ids_of(text, words).tolist() == library.encode_ordinary(text)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    words = tokenfile.text_ids_of(tokenizer.to_str()).words
    assert ids_of(text, words).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


NBSP = "\u00a0"
BLANKS = [
    f"a {NBSP} {NBSP} {NBSP} {NBSP} b",
    f"c {NBSP} {NBSP} d",
    f"{NBSP} {NBSP} a {NBSP} {NBSP} ",
    f"a\n {NBSP} b\n  c\n",
    "a   b  c ",
    "a  ",
    "  a",
    "a \n \n b",
    " ",
    "  ",
    "   ",
]


def test_runs_of_blanks_in_any_order():
    """The ids do not depend on the texts met before."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    words = tokenfile.text_ids_of(tokenizer.to_str()).words
    for text in [*BLANKS, *BLANKS, *reversed(BLANKS)]:
        assert ids_of(text, words).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_tokens_of_several_blanks(encoder):
    ranks = dict(encoder.ranks)
    for token in ("  ", "    ", " \n", "\n ", "\n\n", NBSP + " ", " " + NBSP, f" {NBSP} "):
        ranks.setdefault(token.encode(), max(ranks.values()) + 1)
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = bpe.Words(own.matches, own.letters)
    rng = random.Random(5)
    drawn = ["".join(rng.choice([" ", " ", "\n", "a", "b.", NBSP]) for _ in range(rng.randint(0, 9))) for _ in range(2000)]
    for text in [*BLANKS, *BLANKS, *drawn]:
        assert ids_of(text, words).tolist() == library.encode_ordinary(text), repr(text)


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_bpe_of_a_table(frame, empty, docs, library):
    docs = [*docs, (None, "no id"), (1, docs[1][1])]
    encoded = bpe.encode(frame(docs), RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    found = [tuple(r) for r in bpe.digests(decoded).select(*columns).collect()]
    expected = []
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    both = bpe.encode_and_decode(frame(docs), RANKS, public_tokenizers.PATTERN)
    found = [tuple(r) for r in bpe.digests(both).select(*columns).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert bpe.encode_and_decode(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    planes = tokenfile.to_planes(ids, bits)
    assert len(planes) == (32 if bits else 4)
    assert (tokenfile.from_planes(planes, n) == ids).all()


@pytest.mark.parametrize("bits, chunk", [(False, 1 << 16), (True, 100)])
def test_token_files(spark, frame, docs, ws, bits, chunk):
    """Also with chunks so small that documents reach over several."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    docs = [*docs, *((100 + k, text) for k, text in enumerate(odd_texts(60)))]
    path = ws.path("ids")
    tokenfile.write_ids(frame(docs), path, VOCABULARY, bits=bits, chunk_ids=chunk)
    found = {
        r["doc_id"]: (r["start"], bytes(r["ids"])) for r in tokenfile.read_ids(spark, path, chunk).collect()
    }
    start = 0
    for doc_id, text in sorted(docs):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert found[doc_id] == (start, ids.tobytes())
        start += len(ids)
    assert len(found) == len(docs)
    index = spark.read.parquet(path).agg(F.sum("n_ids")).first()[0]
    assert index == start


END = "<|endoftext|>"


@pytest.mark.parametrize(
    "text",
    [f"{END} at the start", f"in {END} the middle", f"at the end {END}", f"{END}{END} {END}", f"glued{END}on",
     f"no{END[:-1]}", f"lines\n{END}\n\n{END}.", END],
)
def test_special_tokens_as_the_library_has_them(text):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    encode = tokenfile.text_ids_of(tokenizer.to_str())
    for _ in range(2):
        ids = np.frombuffer(encode(text), np.uint32).tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
    plain = Tokenizer.from_file(VOCABULARY)
    plain.encode_special_tokens = True
    ids = np.frombuffer(tokenfile.text_ids_of(tokenizer.to_str(), plain=True)(text), np.uint32)
    assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_token_files_odd_rows(spark, frame, empty, ws):
    path = ws.path("ids")
    tokenfile.write_ids(empty, path, VOCABULARY)
    assert tokenfile.read_ids(spark, path).count() == 0
    path = ws.path("ids")
    tokenfile.write_ids(frame([(None, "a"), (3, None), (3, "a b"), (3, None)]), path, VOCABULARY)
    found = tokenfile.read_ids(spark, path).collect()
    assert sorted(len(r["ids"]) // 4 for r in found) == [1, 1, 2, 3]
    assert min(found, key=lambda r: r["start"])["doc_id"] is None
    assert os.path.isdir(path.removeprefix("file:"))


def test_a_batch_of_texts():
    """Equals the library for each text, whatever else is in the batch."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(12)
    marks = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    marked = [f"{w}{a}{b}" for w in ("word", "\u00c9t\u00e9", "\u0130", "a1") for a in marks for b in ("", a, "!", "'", "\nThe")]
    rng.shuffle(marked)
    runs = [" ".join(marked[k : k + 7]) for k in range(0, len(marked), 7)]
    texts = [*odd_texts(400), *BLANKS, None, "", *runs, "x" * 5000, "\n", " a", "a\n\nb"]
    texts += ["<|endoftext|>", "a <|endoftext|><|endoftext|> b"]
    end = np.array([7], np.uint32).tobytes()
    encode = tokenfile.TextIds(tokenizer.to_str(), False, 500)
    for at in (0, 1):  # one batch, then each text alone
        for some in [texts] if not at else [[t] for t in texts]:
            ids, bounds = encode.batch(pa.array(some, pa.string()), end)
            assert len(bounds) == len(some) + 1 and bounds[-1] == len(ids)
            for text, (a, b) in zip(some, pairwise(bounds.tolist())):
                want = tokenizer.encode(text or "", add_special_tokens=False).ids
                assert ids[a:b].tolist() == [*want, 7], repr(text)


def test_a_word_is_looked_up_once_a_batch(monkeypatch):
    """And words with marks after them or a line end within are not left to the library."""
    encode = tokenfile.TextIds(Tokenizer.from_file(VOCABULARY).to_str(), False, 500)
    seen, encoded = [], []
    missing = bpe.Words.__missing__
    monkeypatch.setattr(bpe.Words, "__missing__", lambda self, word: seen.append(word) or missing(self, word))
    monkeypatch.setattr(bpe.Words, "_remember", lambda self, word, ids: None)
    whole = encode.words.encode
    for words in (encode.words, encode.words.at_start):
        words.encode = lambda text: encoded.append(text) or whole(text)
    texts = ["start " + "more words&&& end.\nNext here " * 50] * 40
    encode.batch(pa.array(texts), b"")
    assert seen.count("more") == seen.count("here") == seen.count("words&&&") == 1
    assert encoded.count("&&&") == 1 and not any("Next" in text or "words" in text for text in encoded)
