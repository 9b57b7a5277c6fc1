"""Ids of texts by a tokenizer for which white space only parts words.

Such tokenizers (BPE with word ends, for instance) drop white space, so a text's ids are
those of its words, one after another, and words can be remembered. Whether a tokenizer is of
this kind is tried out on probes; if not, texts are encoded as a whole. The library encodes
every word that is not remembered; Latin letters can go to its model directly, and marks after
letters can be looked up apart, if that gives the same on the probes.
"""

from __future__ import annotations

import os
from array import array
from itertools import islice, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reviewtide.llm.tokenfile import byte_letters
from reviewtide.llm.wordbatch import distinct_words, holding, in_a_row, lined_up

LETTERS = byte_letters()
REMEMBERED_WORDS = 900_000
SHORT_WORD = 12
_LATIN_END = "\u0250"  # letters below it have long been settled
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PROBES = ("a", "Word", "don't", "end.", "x,y", "(12)", "3rd", "über", "é", "é", "_", "!!", "AND")


class SpacedIds(dict):
    """The ids of words, as bytes; calling it gives those of a text.

    Words of up to ``SHORT_WORD`` characters and words of letters are remembered, of the latter
    only of a length that natural words have; a sixteenth is forgotten when ``remembered`` is
    reached, so memory is bounded.
    """

    def __init__(self, description: str, remembered: int = REMEMBERED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is its share
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.signs = tuple({token.content.lower() for token in added})
        self.starts = {letter for sign in self.signs for letter in (sign[0], sign[0].upper())}
        self.remembered = remembered
        self.tails: dict[str, bytes] = {}
        ids = self.whole
        self.spaced = all(
            ids(x + gap + y) == ids(x) + ids(y) and ids(gap + x + gap) == ids(x)
            for gap in (" ", "\n", "  ", "\n \n")
            for x, y in product(_PROBES, _PROBES)
        )
        letters = ("a", "word", "andthethe", "zzqx", "abcdefghijklmnop")
        self.direct = all(self._by_model(x) == ids(x) for x in (*letters, *map(str.title, letters)))
        accents = ("\u00e9", "\u00c9t\u00e9", "\u00fcber", "\u00d1and\u00fa", "\u0153uvre", "\u00e8\u00e9\u00ea\u00e7", "stra\u00dfe", "\u0130a")
        self.accented = self.direct and all(self._by_bytes(x) in (None, ids(x)) for x in accents)
        self.closing = "".join(m for m in _MARKS if self._parts(m, "!") and self._parts(m, m))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _by_model(self, word: str) -> bytes:
        tokens = self.tokenizer.model.tokenize(word.lower())
        return array("I", [token.id for token in tokens]).tobytes()

    def _normal(self, word: str) -> str | None:
        """Latin letters as the model gets them, if they are letters alone even then."""
        if not word.isalpha() or max(word) >= _LATIN_END:
            return None
        normal = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        return normal if normal.isalpha() and max(normal) < _LATIN_END else None

    def _by_bytes(self, word: str) -> bytes | None:
        """The same for Latin letters with accents."""
        normal = self._normal(word)
        if normal is None:
            return None
        tokens = self.tokenizer.model.tokenize(normal.encode().decode("latin-1").translate(LETTERS))
        return array("I", [token.id for token in tokens]).tobytes()

    def _parts(self, mark: str, other: str) -> bool:
        """Whether marks after letters are by themselves."""
        ids, marks = self.whole, mark + other
        return all(
            ids(x + y) == ids(x) + ids(y) for x in ("a", "Word", "zzqx") for y in (mark, marks, marks[::-1])
        )

    def _letters(self, word: str) -> bytes:
        if self.direct and word.isascii():
            return self._by_model(word)
        ids = self._by_bytes(word) if self.accented else None
        return self.whole(word) if ids is None else ids

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            ids = self._letters(word)
            if len(word) <= 2 * SHORT_WORD:
                self._remember(word, ids)
            return ids
        head = word.rstrip(self.closing)
        letters = head.isalpha() if head.isascii() else self._normal(head) is not None
        if letters:  # a run of marks after letters is by itself
            ids = self[head] + self._tail(word[len(head) :])
        else:
            ids = self.whole(word)
        if len(word) <= SHORT_WORD:
            self._remember(word, ids)
        return ids

    def _tail(self, marks: str) -> bytes:
        ids = self.tails.get(marks)
        if ids is None:
            ids = self.whole(marks)
            if len(marks) <= 4:
                self.tails[marks] = ids
        return ids

    def _remember(self, word: str, ids: bytes) -> None:
        if len(self) >= self.remembered:
            for known_longest in list(islice(self, max(1, self.remembered >> 4))):
                del self[known_longest]
        self[word] = ids

    def __call__(self, text: str) -> bytes:
        if not self.spaced:
            return self.whole(text)
        if any(start in text for start in self.starts):
            low = text.lower()
            if any(sign in low for sign in self.signs):
                return self.whole(text)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def batch(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a batch of texts, each followed by ``end``, in one row, and their bounds."""
        texts = pc.fill_null(texts, "")
        if not self.spaced:
            return in_a_row([self.whole(text) + end for text in texts.to_pylist()])
        whole = {}
        for k in np.flatnonzero(holding(texts, self.starts)).tolist():
            low = (text := texts[k].as_py()).lower()
            if any(sign in low for sign in self.signs):
                whole[k] = self.whole(text)
        offsets, numbers, distinct = distinct_words(pc.replace_substring(texts, "\n", " "))
        return lined_up(list(map(self.__getitem__, distinct)), numbers, offsets, end, whole)


_kept: dict[str, SpacedIds] = {}


def spaced_ids_of(description: str) -> SpacedIds:
    """The one that the tasks of a worker process share, with the words they have met."""
    if description not in _kept:
        _kept.clear()
        _kept[description] = SpacedIds(description)
    return _kept[description]
