"""Words of a column of texts as 64-bit hashes, computed for many rows at once.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; since these
are ASCII, the UTF-8 bytes can be scanned without decoding. A word's hash is a
polynomial over its bytes modulo 2^64, taken as a difference of running sums, and
mixed. Two different words share a hash with a chance near 2^-64; the operators
say where they rely on that.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 2 << 20  # of text that is worked on at once; a single longer text is taken whole
_BASE = U(0x9E3779B97F4A7C15)
_POWERS_STEP = 1 << 18  # powers are grown by this many
_libc = ctypes.CDLL(None)

# Classes of bytes: 0 separates, and a word is a run of one class.
WORDS = np.ones(256, dtype=np.uint8)
WORDS[[0x20, *range(0x09, 0x0E)]] = 0
# Letters, digits and all beyond ASCII apart from runs of punctuation.
WORDS_AND_MARKS = WORDS.copy()
WORDS_AND_MARKS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 2
# The same without the punctuation.
PLAIN_WORDS = np.where(WORDS_AND_MARKS == 1, 1, 0).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U) * _BASE)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[ord("A"): ord("Z") + 1] = _BYTE[ord("a"): ord("z") + 1]


class _Powers:
    """Powers of an odd number modulo 2^64 and their inverses, grown on demand."""

    def __init__(self, base: int):
        self._base, self._inverse = U(base), U(pow(base, -1, 1 << 64))
        self._up = self._down = np.ones(1, dtype=U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = -(-n // _POWERS_STEP) * _POWERS_STEP
            self._up, self._down = (
                np.cumprod(np.concatenate(([U(1)], np.full(size - 1, x, dtype=U)))) for x in (self._base, self._inverse)
            )
        return self._up[:n], self._down[:n]


_byte_powers = _Powers(0xD6E8FEB86659FD93)
_word_powers = _Powers(0xA0761D6478BD642F)


@dataclass
class Words:
    """Words of ``n_rows`` texts: ``row`` owns ``bounds[row]`` up to ``bounds[row + 1]``."""

    first: int  # number of the first text within its batch
    bounds: np.ndarray
    hashes: np.ndarray
    data: np.ndarray  # the bytes of the texts
    starts: np.ndarray  # of each word in data
    ends: np.ndarray

    @property
    def n_rows(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        """The text of each word, counted within this slice."""
        return np.repeat(np.arange(self.n_rows), self.counts)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words, for the run starting at each word, and which of them end inside their text."""
        total = len(self.hashes)
        ends = np.repeat(self.bounds[1:], self.counts)
        inside = np.arange(total) + n <= ends
        if total == 0:
            return np.zeros(0, dtype=U), inside
        up, down = _word_powers(total + 1)
        sums = np.zeros(total + 1, dtype=U)
        np.cumsum(self.hashes * up[1:], out=sums[1:])
        stop = np.minimum(np.arange(total) + n, total)
        return mix((sums[stop] - sums[:-1]) * down[:-1] + U(n)), inside


def release_memory() -> None:
    """Give back what this Python worker has freed: workers live on from stage to stage, and so would the memory."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):  # glibc alone
        _libc.malloc_trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)


def _slice_words(first: int, offsets: np.ndarray, data: np.ndarray, lower: bool, classes: np.ndarray) -> Words:
    offsets = offsets - offsets[0]
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(first, np.zeros(len(offsets), dtype=np.int64), none.astype(U), data, none, none)
    kind = classes[data]
    letter = kind > 0
    begin, end = letter.copy(), letter.copy()
    change = kind[1:] != kind[:-1]
    begin[1:] &= change
    end[:-1] &= change
    borders = inner_borders(offsets)
    begin[borders] = letter[borders]
    end[borders - 1] = letter[borders - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    hashes = hash_runs(data, starts, ends, lower)
    return Words(first, np.searchsorted(starts, offsets), hashes, data, starts, ends)


def inner_borders(offsets: np.ndarray) -> np.ndarray:
    """Where one text ends and another begins, inside the bytes that ``offsets`` (from 0) divide."""
    borders = offsets[1:-1]
    return borders[(borders > 0) & (borders < offsets[-1])]


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Hashes of runs of bytes."""
    n = len(data)
    up, down = _byte_powers(n + 1)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * up[:n], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(U) * _BASE)


def words_of(
    column: pa.Array, lower: bool = False, classes: np.ndarray = WORDS, step: int = SLICE_BYTES
) -> Iterator[Words]:
    """The words of every text, in slices of whole texts of about ``step`` bytes; ``lower`` maps A-Z to a-z."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    offsets, data = text_bytes(column)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + step, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield _slice_words(at, offsets[at: to + 1], data[offsets[at]: offsets[to]], lower, classes)
        at = to
    release_memory()


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of each text and where each text's begin.

    A text with fewer words gives its whole sequence as one shingle; a text
    without words gives none. Sorted within each text.
    """
    grams, inside = words.grams(n)
    counts = words.counts
    for row in np.flatnonzero((counts > 0) & (counts < n)):
        a, b = words.bounds[row], words.bounds[row + 1]
        value = np.full(1, b - a, dtype=U)
        for h in words.hashes[a:b]:
            value = mix(value * _BASE + h)
        grams[a], inside[a] = value[0], True
    found, sizes = [], np.zeros(words.n_rows, dtype=np.int64)
    for row in range(words.n_rows):
        a, b = words.bounds[row], words.bounds[row + 1]
        if a == b:
            continue
        last = b - n + 1 if b - a >= n else a + 1
        own = np.unique(grams[a:last])
        sizes[row] = len(own)
        found.append(own)
    values = np.concatenate(found) if found else np.zeros(0, dtype=U)
    return values, np.concatenate(([0], np.cumsum(sizes)))
