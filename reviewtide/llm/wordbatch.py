"""Ids of a batch of texts, put together from the ids of its distinct words.

Most words of a batch occur in it many times. Arrow splits the texts and numbers their
distinct words, so that each is looked up once a batch, and Arrow lines up the ids again. What
is held is in proportion to the batch, which is bounded in bytes or is one text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GATHERED_BYTES = 8 << 20


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of some ``GATHERED_BYTES``; more only if a given batch has more."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
        if sum(b.nbytes for b in waiting) >= GATHERED_BYTES:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting = []
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Texts split at each space: where the words of each text begin (and the last one's end),
    the number of each word, and the distinct words by number. A text has one word at least."""
    lists = pc.split_pattern(texts, " ")
    words = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
    return offsets - offsets[:1], words.indices.to_numpy(), distinct


def holding(texts: pa.Array, signs, ignore_case: bool = False) -> np.ndarray:
    """Which texts hold one of ``signs``."""
    found = np.zeros(len(texts), bool)
    for sign in signs:
        held = pc.match_substring(texts, sign, ignore_case=ignore_case)
        found |= held.to_numpy(zero_copy_only=False)
    return found


def lined_up(
    ids: list[bytes], numbers: np.ndarray, offsets: np.ndarray, end: bytes, whole: dict[int, bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit ids of all texts in one row, and where those of each begin (and the last one's
    end). ``ids`` are those of the words by number; ``end`` follows each text; ``whole`` has the
    ids of texts that do not go by their words, by the text's place."""
    numbers = np.insert(numbers, offsets[1:], len(ids))
    found = pa.array([*ids, end], pa.large_binary()).take(pa.array(numbers))
    _, places, data = found.buffers()
    bounds = np.frombuffer(places, np.int64)[offsets + np.arange(len(offsets))]
    if not whole:
        return _numbers(data, bounds[-1]), bounds // 4
    every = memoryview(data)
    parts = [
        whole[k] + end if k in whole else every[a:b] for k, (a, b) in enumerate(pairwise(bounds.tolist()))
    ]
    return in_a_row(parts)


def in_a_row(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    joined = b"".join(parts)
    return _numbers(joined, len(joined)), np.cumsum([0, *(len(x) // 4 for x in parts)], dtype=np.int64)


def _numbers(data, n_bytes: int) -> np.ndarray:
    return np.frombuffer(data, np.uint32, n_bytes // 4) if n_bytes else np.zeros(0, np.uint32)
