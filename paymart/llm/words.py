"""Words of UTF-8 texts and their hashes, computed on whole Arrow columns.

A word is a run of bytes other than 0x20 and 0x09-0x0D. Hashes are polynomial
over bytes (or over word hashes), taken from prefix sums modulo 2**64 and then
mixed, so that a column costs a few passes of numpy and no loop over words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts hashed at a time, so that the arrays stay in the cache

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64

PUNCTUATION = _SPACE.copy()  # blanks, control characters and ASCII punctuation
PUNCTUATION[:48] = PUNCTUATION[58:65] = PUNCTUATION[91:97] = PUNCTUATION[123:128] = True


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of MurmurHash3: every input bit reaches every output bit."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BYTES_LOWER = _BYTES.copy()
_BYTES_LOWER[65:91] = _BYTES[97:123]


class _Powers:
    """Powers of an odd base and of its inverse, grown when needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (
                np.concatenate([[_U(1)], np.cumprod(np.full(size - 1, b, np.uint64), dtype=np.uint64)])
                for b in (self.base, self.inverse)
            )
        return self.up, self.down


_BYTE_POWERS = _Powers(0x9E3779B97F4A7C15 | 1)
_WORD_POWERS = _Powers(0xD6E8FEB86659FD93)


def utf8_column(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Word hashes of several texts one after the other; text i has counts[i] words."""

    hashes: np.ndarray
    counts: np.ndarray

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.counts)])

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the window that starts at each word, and which windows lie in one text."""
        n = len(self.hashes)
        left = np.repeat(self.offsets[1:], self.counts) - np.arange(n)
        inside = left >= length
        if n < length:
            return np.zeros(n, np.uint64), inside
        up, down = _WORD_POWERS(n + 1)
        sums = np.concatenate([[_U(0)], np.cumsum(self.hashes * up[:n], dtype=np.uint64)])
        whole = np.zeros(n, np.uint64)
        whole[: n - length + 1] = mix(
            (sums[length:] - sums[: n - length + 1]) * down[: n - length + 1] + _U(length)
        )
        return whole, inside

    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def fold_latin(data: np.ndarray) -> np.ndarray:
    """UTF-8 with the capitals of the Latin-1 block made small."""
    data = data.copy()
    accented = np.zeros(len(data), bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data[accented] += 0x20
    return data


def hash_words(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = _SPACE
) -> Words:
    """The words of all texts; ``lower`` reads A-Z as a-z."""
    table = _BYTES_LOWER if lower else _BYTES
    hashes, counts = [], np.zeros(len(offsets) - 1, np.int64)
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        chunk, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        if len(chunk):
            part, starts = _hash_chunk(chunk, cuts, table, separators)
            hashes.append(part)
            counts[first:last] = np.diff(np.searchsorted(starts, cuts))
        first = last
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts)


def _hash_chunk(
    chunk: np.ndarray, cuts: np.ndarray, table: np.ndarray, separators: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    n = len(chunk)
    word = ~separators[chunk]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[cuts] = True
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1] | edge[1:n]
    ends[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _BYTE_POWERS(n + 1)
    sums = np.concatenate([[_U(0)], np.cumsum(table[chunk] * up[:n], dtype=np.uint64)])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts
