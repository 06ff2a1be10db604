"""Substring deduplication by relative Lempel-Ziv parsing.

A window is ``window`` consecutive words of one document; it is a repeat if the same
words also start earlier (smaller doc_id, or the same document further ahead). Words
covered by repeats are removed; repeats are judged on the input.

The corpus is divided into reference blocks by content: every window has an anchor, the
smallest hash among its runs of ``ANCHOR`` words, and equal windows have equal anchors, so
a block that holds all windows of an anchor can be searched without the others. Each
document is parsed against every block that one of its anchors leads to: within a
stretch of words under one anchor, a factor is the longest run of windows that the block's
index has from an earlier place. Factors shorter than a window do not count. A
factor that goes on in another block is cut where the anchor changes; as each counts whole
windows, which reach over that border, joining the factors of a document by their word
ranges loses nothing there.

A task first resolves repeats among its own texts, slice by slice, and sends each distinct
window of a slice once. A passage that very many documents share thus reaches
its block once per slice rather than once per document. Blocks are dealt by the hash of
the anchor. ``HASH_BYTES`` bytes of each window's 64-bit hash travel; windows of one block
are equal when these are.

Defined results: null and blank texts have no words and keep none; a null doc_id comes
last; rows that repeat id and text are one document, each getting the same result; rows
that share an id with different texts come in the order of a hash of the text. Columns
but id and text are ignored. Texts of any length are taken whole. No rows give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.shared import dealt, from_planes, parts, planes, table
from buyerlens.llm.words import U, Words, words_of

WINDOW = 20
ANCHOR = 8
_LAST = (1 << 63) - 1  # stands for a null id
HASH_BYTES = 7
FLUSH = 1 << 20  # windows that a task gathers before it hands them on

# Of each stretch: document (id and text), first word, number of windows; and the windows' hashes.
PACKED = "part int, ids binary, texts binary, firsts binary, lengths binary, windows binary"
_BYTES = (8, 4, 4, 4, HASH_BYTES)
SPANS = "id_key long, text_key long, first int, last int"
_NAMES = [x.split()[0] for x in PACKED.split(", ")]
_SPAN_NAMES = [x.split()[0] for x in SPANS.split(", ")]


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values from every position; past the end, of what is there."""
    have, out = 1, values.copy()
    while have < width:
        step = min(have, width - have)
        out[:-step or None] = np.minimum(out[:-step or None], out[step:]) if len(out) > step else out
        have += step
    return out


def _runs(*same: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run in which ``follows`` holds and the other arrays stay equal."""
    new = ~follows
    for values in same:
        new[1:] |= values[1:] != values[:-1]
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(new))[: len(first)]


def _ranks(ids: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The place of each document among the given ones; rows with equal id and text share it."""
    order = np.lexsort((texts, ids))
    rank = np.empty(len(ids), dtype=np.int64)
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[order[1:]] != ids[order[:-1]]) | (texts[order[1:]] != texts[order[:-1]])
    rank[order] = np.cumsum(new)
    return rank


def _repeats(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which entries have the key of another one with a smaller place."""
    order = np.argsort(key)
    equal = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    some = order[twice]
    out = np.zeros(len(key), dtype=bool)
    if not len(some):
        return out
    some = some[np.lexsort((place[some], key[some]))]
    new = np.ones(len(some), dtype=bool)
    new[1:] = key[some[1:]] != key[some[:-1]]
    least = place[some[np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))]]
    out[some] = place[some] > least
    return out


def _parse_slice(w: Words, ids: np.ndarray, texts: np.ndarray, window: int):
    """Spans repeated within the slice, and per stretch of the windows left: row, first, length, anchor; and their hashes."""
    hashes, inside = w.grams(window)
    at = np.flatnonzero(inside)
    anchors = _sliding_minimum(w.grams(ANCHOR)[0], window - ANCHOR + 1)[at]
    hashes = hashes[at]
    row = w.rows()[at]
    start = at - w.bounds[row]
    rank = _ranks(ids, texts)
    again = _repeats(hashes, (rank[row] << 32) | start)
    follows = np.zeros(len(at), dtype=bool)
    follows[1:] = (at[1:] == at[:-1] + 1) & (row[1:] == row[:-1])

    def stretches(which, *same):
        picked = np.flatnonzero(which)
        joined = np.zeros(len(picked), dtype=bool)
        joined[1:] = (picked[1:] == picked[:-1] + 1) & follows[picked[1:]]
        first, last = _runs(*(s[picked] for s in same), follows=joined)
        return picked, first, last

    picked, first, last = stretches(again)
    spans = (row[picked[first]], start[picked[first]], start[picked[last - 1]] + window)
    picked, first, last = stretches(~again, anchors)
    head = picked[first]
    return spans, (row[head], start[head], last - first, anchors[head]), hashes[picked]


def _parse(window: int, n_parts: int):
    """Parse every text against its own slice; what stays open goes to the blocks of its anchors."""
    none = np.zeros(0, dtype=np.int64)

    def packed(ids, texts, held):
        closed, open_, windows = zip(*held)
        rows = []
        row, first, last = (np.concatenate(x) for x in zip(*closed))
        for part, own in _by(n_parts + row % n_parts):
            rows.append((part, *map(planes, (ids[row[own]], texts[row[own]], first[own], last[own], none), _BYTES)))
        row, first, length, anchor = (np.concatenate(x) for x in zip(*open_))
        windows = np.concatenate(windows)
        at = np.cumsum(length) - length
        for part, own in _by((anchor % U(n_parts)).astype(np.int64)):
            n = length[own]
            take = np.arange(n.sum()) + np.repeat(at[own] - (np.cumsum(n) - n), n)
            rows.append((part, *map(planes, (ids[row[own]], texts[row[own]], first[own], n, windows[take]), _BYTES)))
        for a in range(0, len(rows), 64):
            columns = list(zip(*rows[a: a + 64]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=_NAMES)

    def run(batches):
        for batch in batches:
            ids, texts = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            held, waiting = [], 0
            for w in words_of(batch.column(2)):
                own = slice(w.first, w.first + w.n_rows)
                spans, stretch, found = _parse_slice(w, ids[own], texts[own], window)
                held.append(((spans[0] + w.first, *spans[1:]), (stretch[0] + w.first, *stretch[1:]), found))
                waiting += len(found)
                if waiting > FLUSH:
                    yield from packed(ids, texts, held)
                    held, waiting = [], 0
            if held:
                yield from packed(ids, texts, held)

    return run


def _by(part: np.ndarray):
    """(part, indices) for each part, indices in order."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for own in np.split(order, cuts):
        if len(own):
            yield int(part[own[0]]), own


def _span_batch(ids, texts, first, last):
    return pa.RecordBatch.from_arrays([
        pa.array(ids), pa.array(texts.astype(np.int64)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
    ], names=_SPAN_NAMES)


def _factor(window: int, n_parts: int):
    """Of each block, the factors that start earlier elsewhere, as word ranges of their documents."""
    def block(part: int, rows: list[tuple]):
        ids, texts, first, length, found = (
            np.concatenate([from_planes(r[k], n_bytes) for r in rows]) for k, n_bytes in enumerate(_BYTES))
        if part >= n_parts:
            yield _span_batch(ids, texts, first, length)
            return
        at = np.cumsum(length) - length
        stretch = np.repeat(np.arange(len(length)), length)
        start = first[stretch] + np.arange(len(found)) - at[stretch]
        rank = _ranks(ids, texts)
        again = np.flatnonzero(_repeats(found, (rank[stretch] << 32) | start))
        if not len(again):
            return
        joined = np.zeros(len(again), dtype=bool)
        joined[1:] = again[1:] == again[:-1] + 1
        head, tail = _runs(stretch[again], follows=joined)
        a, b = again[head], again[tail - 1]
        yield _span_batch(ids[stretch[a]], texts[stretch[a]], start[a], start[b] + window)

    def run(batches):
        part, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != part:
                    if rows:
                        yield from block(part, rows)
                    part, rows = row[0], []
                rows.append(row[1:])
        if rows:
            yield from block(part, rows)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id_key"),
        F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("text_key"), text.alias("text"),
    )


def duplicate_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Word ranges [first, last) that repeats cover: (id_key, text_key, first, last), ranges may overlap."""
    n_parts = parts(docs.sparkSession)
    packed = _keyed(docs).select("id_key", "text_key", "text").mapInArrow(_parse(window, n_parts), PACKED)
    return dealt(packed).mapInArrow(_factor(window, n_parts), SPANS)


KEPT = "doc_id long, n_words long, n_removed long, kept_text string"


def _remove(batches):
    names = [x.split()[0] for x in KEPT.split(", ")]
    for batch in batches:
        spans = batch.column("spans")
        for w in words_of(batch.column("text")):
            n = w.n_rows
            own = spans.slice(w.first, n)
            edge = np.zeros(len(w.hashes) + 1, dtype=np.int64)
            count = np.array(own.value_lengths().fill_null(0), dtype=np.int64)
            ranges = own.flatten()
            if len(ranges):
                base = np.repeat(w.bounds[:-1], count)
                np.add.at(edge, base + ranges.field("first").to_numpy(), 1)
                np.add.at(edge, base + ranges.field("last").to_numpy(), -1)
            keep = np.cumsum(edge)[:-1] == 0
            starts, length = w.starts[keep], (w.ends - w.starts)[keep] + 1
            at = np.cumsum(length) - length
            total = int(length.sum())
            take = np.arange(total) + np.repeat(starts - at, length)
            out = np.concatenate((w.data, [np.uint8(0x20)]))[take] if total else np.zeros(0, dtype=np.uint8)
            out[at + length - 1] = 0x20
            kept = np.add.reduceat(np.append(keep, False), w.bounds[:-1], dtype=np.int64)
            kept[w.counts == 0] = 0
            ends = np.concatenate((at, [total]))[np.cumsum(kept)]
            text, raw, begin = [], out.tobytes(), 0
            for end in ends.tolist():
                text.append(raw[begin: end - 1] if end > begin else b"")
                begin = end
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(w.first, n), pa.array(w.counts), pa.array(w.counts - kept),
                pa.array(text, pa.binary()).cast(pa.string()),
            ], names=names)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words joined by one space)."""
    spans = duplicate_spans(docs, window).groupBy("id_key", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    rows = _keyed(docs).join(spans, ["id_key", "text_key"], "left")
    return rows.select("doc_id", "text", "spans").mapInArrow(_remove, KEPT)


def op5_substring_dedup(spark, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    )
