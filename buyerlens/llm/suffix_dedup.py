"""Removal of long byte strings that occur twice, by families of suffix arrays of geometric size.

A suffix counts by its first ``length`` bytes (400), its window. Windows are dealt to parts by the
smallest hash of the 64-byte strings in them, so equal windows meet in one part, and a run of
neighbouring windows with the same smallest hash travels as one region of text. A
first pass counts those hashes: a run whose hash occurs nowhere else is unique and stays where it
is. Regions that a slice of text holds several times are compared where they are read; one copy
travels on, marked as repeated.

Each part keeps a logarithmic family of indexes. What arrives is cut into batches. A batch
gets a suffix array: its windows in the order of their first four bytes, then of a fingerprint of all
of them. Neighbours of one key are compared byte by byte; so are the entries that a merge scan
finds both in the batch and in an existing level. Each is marked on both sides, and one entry of each
content stays. The batch then becomes the smallest level, and while the two smallest
levels are of equal size they are merged into one of twice the size. Equal keys of different
bytes only cost a comparison more.

A hash that holds more than its share of all runs (``1 / (share * parts)``; there are at most
``share * parts`` of those) would overload a part: text around one passage that very many documents
hold. Its windows travel one by one as two 64-bit hashes, dealt by these, and are equal if both
agree. So no part receives more than about its share, but for rows that each slice sends once.

What a part finds goes back as spans by document: id and text hashed to 128 bits, so rows that
repeat id and text share their spans, which is right as all their windows are repeated.

Defined results: null and blank texts have no windows; null is empty and has no bytes. Texts
shorter than ``length`` are kept whole. Rows that repeat are documents of their own. Null ids
pass through. An empty table gives no rows. Other columns are ignored. Texts are judged whole,
a long one in pieces that overlap by a window.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.llm.shared import dealt, from_planes, parts, planes, table, written
from buyerlens.llm.words import U, hash_runs, mix, text_bytes

_BLOCK_BITS = 15
_PARTS_PER_TASK = 4
_FEW = 64  # regions that a hash may hold in any case

COUNTS = "print long, places int, kinds int"
# kind 0: regions of text; 1: windows known to be repeated, as runs; 2: single windows as two hashes.
PACKED = "part int, kind int, text binary, sizes binary, one binary, two binary, starts binary, known binary"
SPANS = "one long, two long, spans binary"


class Shape(NamedTuple):
    """Sizes; results depend on ``length`` alone."""

    length: int = 400  # of a window
    gram: int = 64  # of the strings whose smallest hash deals windows to parts
    slice_bytes: int = 2 << 20  # of text that is read at once
    batch_bytes: int = 4 << 20  # of regions that get a suffix array of their own
    filter_bits: int = 26  # of the table that tells which hashes occur again; a full one only sends more
    share: int = 8  # a hash with more than 1 / (share * parts) of all runs is dealt window by window


def _slices(column: pa.Array, shape: Shape):
    """(bytes, bounds of the texts in them, rows, places) of about ``slice_bytes``; a longer text comes in overlapping pieces."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    offsets, data = text_bytes(column)
    at, step = 0, shape.slice_bytes
    while at < len(column):
        size = int(offsets[at + 1] - offsets[at])
        if size > step:
            for a in range(0, size - shape.length + 1, step):
                piece = data[offsets[at] + a: offsets[at] + min(size, a + step + shape.length - 1)]
                yield piece, np.array([0, len(piece)]), np.array([at]), np.array([a])
            at += 1
            continue
        to = int(np.searchsorted(offsets, offsets[at] + step, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        yield data[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at], np.arange(at, to), np.zeros(to - at, dtype=np.int64)
        at = to


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts``."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ahead = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return ahead + np.arange(total)


def stretches(flags: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each stretch of set flags within a run."""
    apart = np.ones(len(flags) + 1, dtype=bool)
    apart[1:-1] = (runs[1:] != runs[:-1]) | ~flags[1:] | ~flags[:-1]
    return np.flatnonzero(flags & apart[:-1]), np.flatnonzero(flags & apart[1:])


def runs_of(data: np.ndarray, bounds: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    """(start, number of windows, smallest hash, text) of each run of windows, and the hashes of all short strings."""
    none = np.zeros(0, dtype=np.int64)
    length, gram = shape.length, min(shape.gram, shape.length)
    n = len(data) - length + 1
    if n <= 0:
        return none, none, none.astype(U), none, none.astype(U)
    at = np.arange(len(data) - gram + 1)
    grams = smallest = hash_runs(data, at, at + gram, False)
    width, span = length - gram + 1, 1
    while 2 * span <= width:
        smallest = np.minimum(smallest[:-span], smallest[span:])
        span *= 2
    smallest = np.minimum(smallest[:n], smallest[width - span: width - span + n])
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    valid = np.arange(n) + length <= bounds[1:][text]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (smallest[1:] != smallest[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    # A run goes on to the next one, or to the end of its text's windows.
    last = np.minimum(np.append(first[1:], n), bounds[1:][text[first]] - length + 1)
    return first, last - first, smallest[first], text[first], grams


def same_bytes(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the ``sizes`` bytes at each pair of places are the same."""
    out = np.ones(len(sizes), dtype=bool)
    ends = np.cumsum(sizes)
    k = 0
    while k < len(sizes):
        to = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + (4 << 20), side="right")))
        own = sizes[k:to]
        places = _ranges(at_a[k:to], own)
        differ = a[places] != b[places + np.repeat(at_b[k:to] - at_a[k:to], own)]
        if differ.any():
            out[k + np.searchsorted(np.cumsum(own), np.flatnonzero(differ), side="right")] = False
        k = to
    return out


def same_windows(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, length: int) -> np.ndarray:
    """Whether the windows at each pair of places are equal; neighbouring pairs are compared as one string."""
    if not len(at_a):
        return np.zeros(0, dtype=bool)
    order = np.argsort(at_a, kind="stable")
    p, q = at_a[order], at_b[order]
    new = np.ones(len(p), dtype=bool)
    new[1:] = (np.diff(p) != 1) | (np.diff(q) != 1)
    first = np.flatnonzero(new)
    number = np.diff(np.append(first, len(p)))
    same = np.repeat(same_bytes(a, p[first], b, q[first], number + length - 1), number)
    doubt = np.flatnonzero(~same)  # one byte spoils a whole string, so look at its windows one by one
    same[doubt] = same_bytes(a, p[doubt], b, q[doubt], np.full(len(doubt), length))
    out = np.empty(len(p), dtype=bool)
    out[order] = same
    return out


@dataclass
class Level:
    """An index: text, the windows in it, and one entry of each content sorted by key."""

    text: np.ndarray
    places: np.ndarray  # of each window in the text
    marked: np.ndarray  # windows that are repeated
    runs: np.ndarray  # the run of each window
    one: np.ndarray  # per run: document, place of the run's first window in it
    two: np.ndarray
    starts: np.ndarray
    keys: np.ndarray  # sorted
    entries: np.ndarray  # windows, in the order of their keys
    weight: int = 1

    def same(self, mine: np.ndarray, other: "Level", others: np.ndarray, length: int) -> np.ndarray:
        return same_windows(self.text, self.places[mine], other.text, other.places[others], length)


def _window_keys(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """First four bytes of each window, then 32 bits of its fingerprint."""
    head = np.zeros(len(places), dtype=U)
    for k in range(4):
        head = (head << U(8)) | text[np.minimum(places + min(k, length - 1), len(text) - 1)].astype(U)
    return (head << U(32)) | (hash_runs(text, places, places + length, False) >> U(32))


def suffix_array(text, sizes, one, two, starts, known, length: int) -> Level:
    """The index of a batch of regions; windows that occur twice in it are marked, and one of each content is kept."""
    windows = sizes - (length - 1)
    at = np.cumsum(sizes) - sizes
    places = _ranges(at, windows)
    runs = np.repeat(np.arange(len(sizes)), windows)
    marked = known[runs].copy()
    keys = _window_keys(text, places, length)
    order = np.argsort(keys, kind="stable")
    level = Level(text, places, marked, runs, one, two, starts, keys[order], order)
    keep = np.ones(len(order), dtype=bool)
    new = np.ones(len(order), dtype=bool)
    new[1:] = level.keys[1:] != level.keys[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else np.zeros(0, dtype=np.int64)
    again = np.flatnonzero(~new)
    same = level.same(order[again], level, order[first[again]], length)
    found = again[same]
    level.marked[order[found]] = level.marked[order[first[found]]] = True
    keep[found] = False
    for k in np.unique(first[again[~same]]).tolist():  # one key, several contents
        _settle(level, [j for j in again[first[again] == k].tolist() if keep[j]], k, keep, length)
    level.keys, level.entries = level.keys[keep], level.entries[keep]
    return level


def _settle(level: Level, group: list[int], first: int, keep: np.ndarray, length: int) -> None:
    seen: dict[bytes, int] = {}
    for j in [first, *group]:
        w = int(level.entries[j])
        content = level.text[level.places[w]: level.places[w] + length].tobytes()
        if content in seen:
            level.marked[[w, seen[content]]] = True
            keep[j] = False
        else:
            seen[content] = w


def merge_scan(new: Level, old: Level, length: int) -> None:
    """Mark on both sides what both levels hold, and drop it from the entries of the new one."""
    at = np.searchsorted(old.keys, new.keys)
    at[at == len(old.keys)] = 0
    hit = np.flatnonzero(old.keys[at] == new.keys) if len(old.keys) else np.zeros(0, dtype=np.int64)
    if not len(hit):
        return
    mine, theirs = new.entries[hit], old.entries[at[hit]]
    same = new.same(mine, old, theirs, length)
    keep = np.ones(len(new.keys), dtype=bool)
    new.marked[mine[same]] = old.marked[theirs[same]] = True
    keep[hit[same]] = False
    for k in hit[~same].tolist():  # the key's first content there is another one
        place = int(at[k]) + 1
        while place < len(old.keys) and old.keys[place] == new.keys[k]:
            w, v = new.entries[k: k + 1], old.entries[place: place + 1]
            if new.same(w, old, v, length)[0]:
                new.marked[w] = old.marked[v] = True
                keep[k] = False
                break
            place += 1
    new.keys, new.entries = new.keys[keep], new.entries[keep]


def merged(a: Level, b: Level) -> Level:
    """One level of two whose entries are all different."""
    keys = np.concatenate((a.keys, b.keys))
    entries = np.concatenate((a.entries, b.entries + len(a.places)))
    order = np.argsort(keys, kind="stable")
    both = lambda f: np.concatenate((f(a), f(b)))
    return Level(
        both(lambda x: x.text), np.concatenate((a.places, b.places + len(a.text))), both(lambda x: x.marked),
        np.concatenate((a.runs, b.runs + len(a.starts))), both(lambda x: x.one), both(lambda x: x.two), both(lambda x: x.starts),
        keys[order], entries[order], a.weight + b.weight)


class Family:
    """Levels of geometric size."""

    def __init__(self, length: int):
        self.length, self.levels = length, []

    def add(self, batch: Level) -> None:
        for level in self.levels:
            merge_scan(batch, level, self.length)
        self.levels.append(batch)
        while len(self.levels) > 1 and self.levels[-1].weight == self.levels[-2].weight:
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(merged(a, b))

    def repeats(self):
        """(one, two, start, stop) of each stretch of bytes that repeated windows cover within a run."""
        for level in self.levels:
            first, last = stretches(level.marked, level.runs)
            run = level.runs[first]
            start = level.starts[run] + first - np.searchsorted(level.runs, run)
            yield level.one[run], level.two[run], start, start + last - first + self.length


def _counts(shape: Shape):
    """At how many places, and in how many regions of different content, each slice holds a hash."""
    def run(batches):
        for batch in batches:
            for data, bounds, _, _ in _slices(batch.column(0), shape):
                first, number, smallest, _, grams = runs_of(data, bounds, shape)
                if not len(first):
                    continue
                # A run whose smallest hash stands at several places may repeat within itself.
                width = number + shape.length - min(shape.gram, shape.length)
                found = grams[_ranges(first, width)] == np.repeat(smallest, width)
                places = np.add.reduceat(found.astype(np.int32), np.cumsum(width) - width)
                content = hash_runs(data, first, first + number + shape.length - 1, False)
                order = np.lexsort((content, smallest))
                s, c = smallest[order], content[order]
                new = np.ones(len(s), dtype=bool)
                new[1:] = s[1:] != s[:-1]
                other = new.copy()
                other[1:] |= c[1:] != c[:-1]
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays([
                    pa.array(s[at].view(np.int64)), pa.array(np.add.reduceat(places[order], at).astype(np.int32)),
                    pa.array(np.add.reduceat(other.astype(np.int32), at).astype(np.int32)),
                ], names=["print", "places", "kinds"])

    return run


class _Filter:
    """Which hashes occur again, and which hold more than their share."""

    def __init__(self, texts: DataFrame, n_parts: int, shape: Shape):
        bits, most = shape.filter_bits, shape.share * n_parts
        prints = written(texts.select("text").mapInArrow(_counts(shape), COUNTS).groupBy("print").agg(
            F.sum("places").alias("places"), F.sum("kinds").alias("kinds")).where("places > 1"), "prints")
        total = prints.agg(F.sum("kinds")).first()[0] or 0
        hot = prints.where(F.col("kinds") * most > total + most * _FEW).select("print").collect()
        self.hot = np.sort(np.array([r["print"] for r in hot], dtype=np.int64).view(U))
        slot = F.col("print").bitwiseAND(F.lit((1 << bits) - 1))
        low = min(bits, _BLOCK_BITS)
        blocks = prints.select(F.shiftright(slot, low).alias("block"), slot.bitwiseAND(F.lit((1 << low) - 1)).alias("bit"))
        self.bits = np.zeros(max(1, (1 << bits) // 8), dtype=np.uint8)
        width = max(1, (1 << low) // 8)
        for r in blocks.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("map")).collect():
            self.bits[r["block"] * width: (r["block"] + 1) * width] = np.frombuffer(r["map"], dtype=np.uint8)[:width]
        self.mask = U((1 << bits) - 1)

    def again(self, prints: np.ndarray) -> np.ndarray:
        slot = (prints & self.mask).astype(np.int64)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1

    def is_hot(self, prints: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(prints), dtype=bool)
        at = np.minimum(np.searchsorted(self.hot, prints), len(self.hot) - 1)
        return self.hot[at] == prints


def _by(part: np.ndarray):
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for own in np.split(order, cuts) if len(order) else ():
        yield int(part[own[0]]), own


def _row(part: int, kind: int, text: bytes, sizes, one, two, starts, known) -> tuple:
    return (part, kind, text, planes(sizes, 8 if kind == 2 else 5), one.tobytes(), two.tobytes(),
            planes(starts, 5), known.astype(np.uint8).tobytes())


def _group(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the first string with the same bytes for each string, and whether a string has another like it."""
    content = hash_runs(data, starts, starts + sizes, False)
    order = np.lexsort((sizes, content))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (content[order][1:] != content[order][:-1]) | (sizes[order][1:] != sizes[order][:-1])
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    same = same_bytes(data, starts[order], data, starts[first], sizes[order])
    lead = np.arange(len(starts))
    lead[order[same]] = first[same]
    return lead, np.bincount(lead, minlength=len(starts))[lead] > 1


def _deal(shared, n_parts: int, shape: Shape):
    length = shape.length

    def run(batches):
        filter_ = shared.value
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ones, twos = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for data, bounds, rows, bases in _slices(batch.column(2), shape):
                first, number, smallest, text, _ = runs_of(data, bounds, shape)
                keep = filter_.again(smallest)
                first, number, smallest, text = (x[keep] for x in (first, number, smallest, text))
                if not len(first):
                    continue
                out, hot = [], filter_.is_hot(smallest)
                doc = rows[text]
                where = first - bounds[:-1][text] + bases[text]
                one, two = ones[doc], twos[doc]
                if hot.any():
                    out += _hot_windows(data, first[hot], number[hot], one[hot], two[hot], where[hot], n_parts, length)
                cold = np.flatnonzero(~hot)
                if len(cold):
                    sizes = number[cold] + length - 1
                    lead, known = _group(data, first[cold], sizes)
                    out += _known(one[cold][known], two[cold][known], where[cold][known], number[cold][known], n_parts)
                    sent = np.flatnonzero(lead == np.arange(len(lead)))
                    part = (mix(smallest[cold[sent]]) % U(n_parts)).astype(np.int64)
                    for to, k in _by(part):
                        own = sent[k]
                        regions = data[_ranges(first[cold[own]], sizes[own])].tobytes()
                        out.append(_row(to, 0, squeeze.compress(regions), sizes[own], one[cold[own]], two[cold[own]],
                                        where[cold[own]], known[own]))
                names = [x.split()[0] for x in PACKED.split(", ")]
                for a in range(0, len(out), 128):
                    columns = list(zip(*out[a: a + 128]))
                    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _known(one, two, starts, number, n_parts: int) -> list[tuple]:
    """Runs of windows known to be repeated: they only pass through a part."""
    part = (mix(one.view(U)) % U(n_parts)).astype(np.int64)
    return [_row(to, 1, b"", number[k], one[k], two[k], starts[k], np.ones(len(k))) for to, k in _by(part)]


def _hot_windows(data, first, number, one, two, where, n_parts: int, length: int) -> list[tuple]:
    places = _ranges(first, number)
    run = np.repeat(np.arange(len(first)), number)
    start = _ranges(where, number)
    a = hash_runs(data, places, places + length, False)
    b = hash_runs(255 - data, places, places + length, False)
    order = np.lexsort((b, a))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
    known = np.empty(len(order), dtype=bool)
    known[order] = np.repeat(sizes > 1, sizes)
    begin, end = stretches(known, run)
    out = _known(one[run[begin]], two[run[begin]], start[begin], end - begin + 1, n_parts)
    sent = order[new]
    for to, k in _by((mix(a[sent]) % U(n_parts)).astype(np.int64)):
        own = sent[k]
        # The second hash takes the place of the text, the first that of the sizes.
        out.append(_row(to, 2, b[own].tobytes(), a[own].view(np.int64), one[run[own]], two[run[own]], start[own], known[own]))
    return out


def _find(shape: Shape):
    """Index the regions of each part and give back the repeated spans of its documents."""
    length = shape.length

    def spans(found: list[tuple]):
        if not found:
            return
        one, two, start, stop = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((start, two, one))
        one, two, start, stop = (x[order] for x in (one, two, start, stop))
        new = np.ones(len(one), dtype=bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        first = np.flatnonzero(new)
        raw = np.stack((start, stop), axis=1).astype("<i8").tobytes()
        edges = np.append(first, len(one)) * 16
        for a in range(0, len(first), 10_000):
            own = first[a: a + 10_000]
            yield pa.RecordBatch.from_arrays([
                pa.array(one[own]), pa.array(two[own]),
                pa.array([raw[edges[k]: edges[k + 1]] for k in range(a, a + len(own))], pa.binary()),
            ], names=["one", "two", "spans"])

    def index(held: list[tuple]) -> Level:
        text = np.frombuffer(b"".join(h[0] for h in held), dtype=np.uint8)
        return suffix_array(text, *(np.concatenate(x) for x in list(zip(*held))[1:]), length)

    def part_rows(rows):
        open_ = zstandard.ZstdDecompressor()
        family, found, held, size, hot = Family(length), [], [], 0, []
        for _, kind, text, sizes, one, two, starts, known in rows:
            one, two = (np.frombuffer(x, dtype=np.int64) for x in (one, two))
            starts, sizes = from_planes(starts, 5), from_planes(sizes, 8 if kind == 2 else 5)
            known = np.frombuffer(known, dtype=np.uint8).astype(bool)
            if kind == 1:
                found.append((one, two, starts, starts + sizes + length - 1))
            elif kind == 2:
                hot.append((sizes, np.frombuffer(text, dtype=np.int64), one, two, starts, known))
            else:
                raw = open_.decompress(text)
                held.append((raw, sizes, one, two, starts, known))
                size += len(raw)
                if size >= shape.batch_bytes:
                    family.add(index(held))
                    held, size = [], 0
        if held:
            family.add(index(held))
        found.extend(family.repeats())
        if hot:
            a, b, one, two, starts, known = (np.concatenate(x) for x in zip(*hot))
            order = np.lexsort((b, a))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
            first = np.flatnonzero(new)
            sizes = np.diff(np.append(first, len(order)))
            again = (sizes > 1) | np.logical_or.reduceat(known[order], first)
            own = order[np.repeat(again, sizes)]
            found.append((one[own], two[own], starts[own], starts[own] + length))
        yield from spans(found)

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        source, waiting = rows(), []

        def own(part):
            while waiting and waiting[0][0] == part:
                yield waiting.pop()
                following = next(source, None)
                if following is not None:
                    waiting.append(following)

        following = next(source, None)
        if following is not None:
            waiting.append(following)
        while waiting:
            yield from part_rows(own(waiting[0][0]))

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(F.lit(1), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), text).alias("one"),
        F.xxhash64(F.lit(2), text, F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias("two"))


def repeated_spans(keyed: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(one, two, spans): for documents that hold repeated windows, pairs of start and stop as bytes."""
    spark = keyed.sparkSession
    n_parts = _PARTS_PER_TASK * parts(spark)
    shared = spark.sparkContext.broadcast(_Filter(keyed, n_parts, shape))
    packed = dealt(keyed.select("one", "two", "text").mapInArrow(_deal(shared, n_parts, shape), PACKED))
    found = packed.mapInArrow(_find(shape), SPANS)
    return found.groupBy("one", "two").agg(F.collect_list("spans").alias("spans"))


def covered(spans: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal runs that spans cover."""
    if not spans:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pairs = np.frombuffer(b"".join(spans), dtype="<i8").reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    first = np.flatnonzero(np.append(True, pairs[1:, 0] > reach[:-1]))
    return pairs[first, 0], reach[np.append(first[1:], len(pairs)) - 1]


def without_repeats(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes, which may cut a character)."""
    keyed = _keyed(docs)
    spans = repeated_spans(keyed, shape)
    both = keyed.join(spans, ["one", "two"], "left").select("doc_id", "text", "spans")

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                own = batch.slice(at, 1000)
                offsets, data = text_bytes(own.column(1))
                n_bytes, n_removed, n_spans, kept = [], [], [], []
                for row, found in enumerate(own.column(2).to_pylist()):
                    raw = data[offsets[row]: offsets[row + 1]]
                    starts, stops = covered(found)
                    gone = int((stops - starts).sum())
                    n_bytes.append(len(raw))
                    n_removed.append(gone)
                    n_spans.append(len(starts))
                    if gone:
                        raw = raw[_ranges(np.append(0, stops), np.append(starts, len(raw)) - np.append(0, stops))]
                    kept.append(raw.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return both.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
