"""Whole texts as flat byte arrays: words, lines and hashes computed with numpy.

Separators are single ASCII bytes, so everything here works on UTF-8 bytes
without decoding. Hashes have 61 bits: equal strings always have equal hashes,
and two different ones of n bytes differ but for a chance of about n / 2**61,
whatever their pattern (polynomials modulo a prime).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# one random number below 2**30 for each byte value, and a base below the prime modulus
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2**30, 256, dtype=np.uint64)
_BASE = 0x11D2F5B4C957F2D7
_PRIME = np.uint64(2**61 - 1)
_LOW30, _LOW31 = np.uint64(2**30 - 1), np.uint64(2**31 - 1)
_30, _31, _61 = np.uint64(30), np.uint64(31), np.uint64(61)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit numbers modulo the prime."""
    x = (x & _PRIME) + (x >> _61)
    return np.where(x >= _PRIME, x - _PRIME, x)


def _shifted(x: np.ndarray) -> np.ndarray:
    """Numbers below 2**62 times 2**31: congruent, and below 2**62."""
    return (x >> _30) + ((x & _LOW30) << _31)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it."""
    a1, a0, b1, b0 = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    return _reduced(np.uint64(2) * a1 * b1 + _shifted(a1 * b0 + a0 * b1) + a0 * b0)


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base (high and low part) and of its inverse, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        tables = []
        for base in (_BASE, pow(_BASE, -1, int(_PRIME))):
            table = np.ones(1, np.uint64)
            while len(table) < size:
                table = np.concatenate((table, _product(table, np.uint64(pow(base, len(table), int(_PRIME))))))
            tables.append(table[:size])
        _powers[:] = [tables[0] >> _31, tables[0] & _LOW31, tables[1]]
    return _powers


class Hasher:
    """Hashes of any spans of one byte array in constant time each."""

    def __init__(self, data: np.ndarray):
        high, low, self._down = _power_tables(len(data) + 1)
        value = _BYTE_VALUE[data]
        terms = _shifted(value * high[: len(data)])
        terms += value * low[: len(data)]
        self._high = np.zeros(len(data) + 1, np.uint64)
        self._low = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms >> _31, out=self._high[1:])
        np.cumsum(terms & _LOW31, out=self._low[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = _shifted(_reduced(self._high[end] - self._high[start])) + _reduced(self._low[end] - self._low[start])
        raw = _product(_reduced(raw), self._down[start])
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


class Texts:
    """Some texts one after another: ``data`` bytes, ``off`` where each begins (and the end)."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off = data, off

    def __len__(self) -> int:
        return len(self.off) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.off[i] : self.off[i + 1]].tobytes()

    def lowered(self) -> Texts:
        return Texts(LOWER[self.data], self.off)

    def words(self, cut: np.ndarray | None = None, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and where each text's words begin in them (and the end).

        ``cut``: whether words are also cut before each byte. ``within``: for
        each of the 256 bytes whether it is part of a word, else all but white space.
        """
        inside = ~IS_SPACE[self.data] if within is None else within[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        if cut is not None:
            first |= cut & inside
            last[:-1] |= cut[1:] & inside[:-1]
        cuts = self.off[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(self.data))]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return start, end, np.searchsorted(start, self.off)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every line (split at \\n; an empty text is one empty line), and each text's first line."""
        breaks = np.flatnonzero(self.data == 10)
        per_text = np.diff(np.searchsorted(breaks, self.off))
        first = np.concatenate(([0], np.cumsum(per_text + 1)))
        start = np.empty(first[-1], np.int64)
        opens = np.zeros(first[-1], bool)
        opens[first[:-1]] = True
        start[opens] = self.off[:-1]
        start[~opens] = breaks + 1
        end = np.empty(first[-1], np.int64)
        closes = np.zeros(first[-1], bool)
        closes[first[1:] - 1] = True
        end[closes] = self.off[1:]
        end[~closes] = breaks
        return start, end, first

    def stripped(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The spans without white space at both ends."""
        solid = np.flatnonzero(~IS_SPACE[self.data])
        a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
        some = b > a
        padded = np.append(solid, 0)
        return np.where(some, padded[a], start), np.where(some, padded[b - 1] + 1, start)

    def code_points(self) -> np.ndarray:
        """Code points before each byte (and in all)."""
        return np.concatenate(([0], np.cumsum((self.data & 0xC0) != 0x80)))


def texts_of(column: pa.Array) -> Texts:
    """A string column as flat bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    off = np.frombuffer(column.buffers()[1], wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return Texts(data[off[0] : off[-1]], off - off[0])


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The rows in runs of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
            part = batch.slice(at, to - at)
            yield part, texts_of(part.column(column))
            at = to


def within(first: np.ndarray) -> np.ndarray:
    """The text of each item, from where each text's items begin."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``k`` words that stays in its text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = within(first)
    start = np.flatnonzero(owner[:n] == owner[k - 1 :])
    out = np.zeros(len(start), np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(0xE7037ED1A0B428DB) + hashes[start + j] + np.uint64(j + 1))
    return out, start


def digits(values: np.ndarray) -> list[str]:
    return [format(int(v), "x") for v in values]
