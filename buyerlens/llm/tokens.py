"""Token ids of a column of texts, encoding each distinct piece of text once.

The tokenizer drops white space, lower-cases, and never merges across the border of a
run of letters and a run of ASCII punctuation. Texts are therefore cut at white space
and at such borders, apart from those at an apostrophe (contractions) or a character
that may combine, and each piece is looked up in a table of pieces already encoded.
Texts that spell a special token are encoded whole. The ids are those of encoding the
text in one go.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from buyerlens.llm.words import U, WORDS, hash_runs, inner_borders, release_memory, text_bytes

STEP = 1 << 19  # bytes of text that are encoded at once; a single longer text is taken whole
TABLE_BITS = 21
MAX_PIECES = 1 << 20  # the table is emptied when it holds this many

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'"]] = True
# Of the characters that UTF-8 begins with C3, all but the signs x and : are letters.
_LATIN = 0xC3
_NO_LETTER = (0x97, 0xB7)


class PieceTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self._keys = np.zeros(1 << TABLE_BITS, dtype=U)
        self._values = np.zeros(1 << TABLE_BITS, dtype=np.int32)
        self._ids = np.zeros(1 << 16, dtype=np.uint32)
        self._starts = np.zeros(MAX_PIECES + 1, dtype=np.int64)
        self._n = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each piece, -1 if unknown."""
        mask = U((1 << TABLE_BITS) - 1)
        found = np.full(len(hashes), -1, dtype=np.int64)
        at = hashes & mask
        seen = self._keys[at]
        hit = seen == hashes
        found[hit] = self._values[at[hit]]
        left = np.flatnonzero(~hit & (seen != 0))
        while len(left):
            at[left] = (at[left] + U(1)) & mask
            seen = self._keys[at[left]]
            hit = seen == hashes[left]
            found[left[hit]] = self._values[at[left[hit]]]
            left = left[~hit & (seen != 0)]
        return found

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        mask = (1 << TABLE_BITS) - 1
        for a in range(0, len(pieces), 20_000):
            for h, e in zip(hashes[a: a + 20_000].tolist(), self._tokenizer.encode_batch_fast(
                    pieces[a: a + 20_000], add_special_tokens=False)):
                ids = e.ids
                start = self._starts[self._n]
                if start + len(ids) > len(self._ids):
                    self._ids = np.concatenate((self._ids, np.zeros(max(len(self._ids), len(ids)), dtype=np.uint32)))
                self._ids[start: start + len(ids)] = ids
                at = h & mask
                while self._keys[at]:
                    at = (at + 1) & mask
                self._keys[at], self._values[at] = h, self._n
                self._n += 1
                self._starts[self._n] = start + len(ids)

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Slices of the column: number of the first text, bounds of the texts' ids, ids."""
        if len(column) == 0:
            return
        offsets, data = text_bytes(column)
        at = 0
        while at < len(column):
            to = int(np.searchsorted(offsets, offsets[at] + STEP, side="right")) - 1
            to = min(max(to, at + 1), len(column))
            yield at, *self._slice(offsets[at: to + 1] - offsets[at], data[offsets[at]: offsets[to]])
            at = to
        release_memory()

    def _slice(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if n == 0:
            return np.zeros(len(offsets), dtype=np.int64), np.zeros(0, dtype=np.uint32)
        letter = _LETTER[data]
        mark = _MARK[data]
        latin = data == _LATIN
        second = np.zeros(n, dtype=bool)
        second[1:] = latin[:-1] & (data[1:] != _NO_LETTER[0]) & (data[1:] != _NO_LETTER[1])
        ends_letter = letter | second
        starts_letter = letter.copy()
        starts_letter[:-1] |= second[1:]
        full = WORDS[data] > 0
        begin = full.copy()
        begin[1:] &= ~full[:-1] | (ends_letter[:-1] & mark[1:]) | (mark[:-1] & starts_letter[1:])
        borders = inner_borders(offsets)
        begin[borders] = full[borders]
        end = full.copy()
        end[:-1] &= begin[1:] | ~full[1:]
        end[borders - 1] = full[borders - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        hashes = hash_runs(data, starts, ends, lower=True)
        hashes[hashes == 0] = 1
        found = self._find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            _, first = np.unique(hashes[new], return_index=True)
            if self._n + len(first) > MAX_PIECES:
                self._clear()
                new = np.arange(len(hashes))
                _, first = np.unique(hashes, return_index=True)
            first = new[first]
            raw = data.tobytes()
            pieces = [raw[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            for a in range(0, len(first), MAX_PIECES // 2):
                self._learn(hashes[first[a: a + MAX_PIECES // 2]], pieces[a: a + MAX_PIECES // 2])
            found[new] = self._find(hashes[new])
        lengths = self._starts[found + 1] - self._starts[found]
        sums = np.concatenate(([0], np.cumsum(lengths)))
        ids = self._ids[np.arange(sums[-1]) + np.repeat(self._starts[found] - sums[:-1], lengths)]
        bounds = sums[np.searchsorted(starts, offsets)]
        special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
        if not len(special):
            return bounds, ids
        raw, parts = data.tobytes(), []
        whole = set((np.searchsorted(offsets, special, side="right") - 1).tolist())
        for row in range(len(offsets) - 1):
            if row in whole:
                text = raw[offsets[row]: offsets[row + 1]].decode()
                parts.append(np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32))
            else:
                parts.append(ids[bounds[row]: bounds[row + 1]])
        return np.concatenate(([0], np.cumsum([len(p) for p in parts]))), np.concatenate(parts)


_loaded: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    """The tokenizer of this Python worker, which keeps its table until ``forget``."""
    if path not in _loaded:
        _loaded[path] = PieceTokenizer(path)
    return _loaded[path]


def forget() -> None:
    """Give up the tokenizers of this worker: it lives on in stages that have no use for their tables."""
    _loaded.clear()
