"""Ids of a word-level BPE, many texts at once.

The normalizer and pre-tokenizer of such a vocabulary never look across white
space (it is dropped, and neither composition nor lower-casing reaches over a
blank), so the ids of a text are the ids of its blank-separated words in
order; inside a word it always cuts between ASCII letters and marks, so they
are looked up apart. Distinct words of a slice are tokenized once and the ids of every
occurrence are gathered with numpy. A fixed-size cache keeps words between
slices. Other white space than ASCII
is handled by the tokenizer inside a word.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

from touchline.llm.text import Hasher, Texts

_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[33:127] = ~_LETTER[33:127]
CACHE_WORDS = 1 << 21


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


class _Places:
    """Numbers of 64-bit keys in sorted arrays: a large one, and a small one for new keys that it takes in now and then."""

    def __init__(self):
        self.parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int32)) for _ in range(2)]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 if unknown; ``keys`` are sorted."""
        out = np.full(len(keys), -1, np.int32)
        for known, number in self.parts:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                out[hit] = number[at[hit]]
        return out

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        self.parts[1] = self._merged(self.parts[1], (keys, numbers))
        if len(self.parts[1][0]) > max(1 << 15, len(self.parts[0][0]) // 4):
            self.parts = [self._merged(*self.parts), (np.zeros(0, np.uint64), np.zeros(0, np.int32))]

    @staticmethod
    def _merged(a, b):
        keys = np.concatenate((a[0], b[0]))
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate((a[1], b[1]))[order]


class WordIds:
    """Ids of words by their 64-bit hash; forgets all when more than ``limit`` words are held."""

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        self.tokenizer, self.limit = tokenizer(path), limit
        self._forget()

    def _forget(self) -> None:
        self.places = _Places()
        self.at, self.ids = np.zeros(1, np.int32), np.zeros(0, np.uint32)
        self.n_words = self.n_ids = 0

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        new = np.fromiter(itertools.chain.from_iterable(found), np.uint32, size.sum())
        self.at = _room(self.at, self.n_words + 1 + len(words))
        self.ids = _room(self.ids, self.n_ids + len(new))
        self.at[self.n_words + 1 : self.n_words + 1 + len(words)] = self.n_ids + np.cumsum(size)
        self.ids[self.n_ids : self.n_ids + len(new)] = new
        self.places.add(keys, np.arange(self.n_words, self.n_words + len(words), dtype=np.int32))
        self.n_words, self.n_ids = self.n_words + len(words), self.n_ids + len(new)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids begin (and the end)."""
        start, end, first = texts.words(_joints(texts.data))
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        if self.n_words > self.limit:
            self._forget()
        back, distinct = pd.factorize(Hasher(texts.data).spans(start, end))
        order = np.argsort(distinct)
        keys = distinct[order]
        place = self.places.find(keys)
        new = np.flatnonzero(place < 0)
        if len(new):
            sample = np.empty(len(keys), np.int64)
            sample[back] = np.arange(len(back))
            words = [texts.data[start[i] : end[i]].tobytes().decode() for i in sample[order[new]].tolist()]
            place[new] = np.arange(self.n_words, self.n_words + len(new))
            self._learn(keys[new], words)
        number = np.empty(len(keys), np.int32)
        number[order] = place
        at = number[back]
        begin = self.at[at].astype(np.int64)
        size = self.at[at + 1] - begin
        stops = np.concatenate(([0], np.cumsum(size)))
        return self.ids[np.repeat(begin - stops[:-1], size) + np.arange(stops[-1])], stops[first]


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if len(a) >= n else np.concatenate((a, np.zeros(max(n, len(a) + len(a) // 2) - len(a), a.dtype)))


@functools.lru_cache(maxsize=2)
def shared(path: str) -> WordIds:
    """One cache for all tasks that a Python worker runs."""
    return WordIds(path)


def _joints(data: np.ndarray) -> np.ndarray:
    """Where an ASCII letter meets an ASCII mark or digit: the pre-tokenizer always cuts there, but after an apostrophe."""
    letter, mark = _LETTER[data], _MARK[data]
    out = np.zeros(len(data), bool)
    out[1:] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:] & (data[:-1] != ord("'")))
    return out
