"""The operators' contracts in plain Python, over lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACES = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def bare(text):
    return "".join(c for c in text or "" if c not in SPACES)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def base_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {
        i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        len("".join(words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(inside),
    )


def exact(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[bare(text)].append((-len(text or ""), doc_id))
    return {
        (doc_id, min(groups[bare(text)])[1], len(groups[bare(text)]), min(groups[bare(text)])[1] == doc_id, sha(bare(text)))
        for doc_id, text in docs
    }


def line_dedup(docs):
    def key(line):
        return ascii_lower(line.strip(SPACES))

    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(doc_id)
    result = set()
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 3 or max(holders[key(x)]) == doc_id]
        result.add((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return result


def shingle_set(text, n=3):
    words = [ascii_lower(w) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def jaccard_components(docs, n=3, percent=90):
    sets = {d: shingle_set(t, n) for d, t in docs}
    by_shingle = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by_shingle[x].append(d)
    label = {d: d for d in sets}

    def find(d):
        while label[d] != d:
            d = label[d]
        return d

    for d, s in sets.items():
        shared = Counter(e for x in s for e in by_shingle[x] if e < d)
        for e, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[e]) - both):
                a, b = sorted((find(d), find(e)))
                label[b] = a
    return {(d, len(sets[d]), find(d)) for d in sets}


def suffix_dedup(docs, length=200):
    texts = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    result = set()
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        result.add((d, len(t), sum(gone), spans, sha(kept)))
    return result


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def min_capacity(sizes, shards):
    """The smallest largest sum of ``shards`` contiguous runs of ``sizes``."""

    def feasible(capacity):
        used, room = 1, capacity
        for size in sizes:
            if size > capacity:
                return False
            if size > room:
                used, room = used + 1, capacity
            room -= size
        return used <= shards

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    return low
