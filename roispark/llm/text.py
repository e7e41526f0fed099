"""Vectorised words of Arrow string columns, used inside tasks.

A task sees its texts as one UTF-8 buffer.  Words are found and hashed with array
operations on slices of about ``SLICE`` bytes (at least one whole document), so
memory follows the slice or the longest single text, never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


class Alphabet:
    """Which bytes separate words, and the letters that count as equal (A-Z is lower-cased)."""

    def __init__(self, separators) -> None:
        self.separator = np.zeros(256, bool)
        self.separator[list(separators)] = True
        letters = np.random.Generator(np.random.PCG64(20240501)).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
        letters[65:91] = letters[97:123]
        letters[self.separator] = 0
        self.letter = letters


# White space: \x20 and \x09-\x0D.
SPACED = Alphabet([32, *range(9, 14)])
# Everything in ASCII that is neither letter nor digit.
ALNUM = Alphabet([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

# Powers are looked up as (high part, low part) of their exponent, so tables stay small for slices of any size.
_LOW = 1 << 12


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[:1] = _U(1)
    return np.multiply.accumulate(out)


_INVERSE = pow(_BASE, -1, 1 << 64)
_low, _low_inverse = _power_table(_BASE, _LOW), _power_table(_INVERSE, _LOW)


def _times_powers(values: np.ndarray) -> None:
    """Multiply every value, in place, by the hash base to the power of its place (mod 2^64)."""
    high = _power_table(pow(_BASE, _LOW, 1 << 64), len(values) // _LOW + 1)
    even = len(values) // _LOW * _LOW
    rows = values[:even].reshape(-1, _LOW)
    rows *= _low
    rows *= high[:-1, None]
    values[even:] *= _low[:len(values) - even] * high[-1]


def _inverse_powers(at: np.ndarray) -> np.ndarray:
    """The inverse of the hash base to the given powers, which ascend."""
    high = _power_table(pow(_INVERSE, _LOW, 1 << 64), int(at[-1]) // _LOW + 1 if len(at) else 0)
    return high[at // _LOW] * _low_inverse[at % _LOW]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(29))) * _U(0xA0761D6478BD642F)
    return h ^ (h >> _U(32))


class Slice:
    """Whole consecutive documents: bytes, byte offsets, and the words with their bounds."""

    def __init__(self, rows: range, data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> None:
        self.rows, self.data, self.offsets = rows, data, offsets
        n = len(data)
        if n == 0:
            self.begin = self.end = np.zeros(0, np.int64)
            self.word = np.zeros(0, np.uint64)
            self.first = np.zeros(len(offsets), np.int64)
            return
        gap = alphabet.separator[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        begin = ~gap
        begin[1:] &= gap[:-1] | cut[1:-1]
        end = ~gap
        end[:-1] &= gap[1:] | cut[1:-1]
        self.begin, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        total = np.zeros(n + 1, np.uint64)
        np.take(alphabet.letter, data, out=total[1:], mode="clip")
        _times_powers(total[1:])
        np.cumsum(total[1:], out=total[1:])
        self.word = mix((total[self.end] - total[self.begin]) * _inverse_powers(self.begin))
        self.first = np.searchsorted(self.begin, offsets)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``k`` consecutive words per document, and where each document begins in them.

        A document with fewer words, but not none, has its whole word sequence as its one shingle.
        """
        count = np.diff(self.first)
        sizes = np.where(count >= k, count - k + 1, np.minimum(count, 1))
        start = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(start[-1]) + np.repeat(self.first[:-1] - start[:-1], sizes)
        length = np.repeat(np.minimum(count, k), sizes)
        value = np.zeros(len(at), np.uint64)
        last = max(len(self.word) - 1, 0)
        for j in range(k):
            more = value * _U(0x9FB21C651E98DF25) + self.word[np.minimum(at + j, last)] if len(at) else value
            value = np.where(j < length, more, value)
        return mix(value + length.astype(np.uint64)), start


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, alphabet: Alphabet, size: int = SLICE) -> Iterator[Slice]:
    """The column as slices of about ``size`` bytes, in order."""
    data, offsets = utf8(column)
    row, n = 0, len(column)
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield Slice(range(row, stop), data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row], alphabet)
        row = stop
