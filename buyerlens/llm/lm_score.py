"""Stupid-backoff language-model scores of all documents, the model being the corpus itself.

Words are told apart by 64-bit hashes and counted exactly. The most frequent ones, at most
``2^VOCABULARY_BITS``, are numbered, and one table of that bounded size goes to all tasks.
Pair counts grow with the corpus and stay distributed: the pairs of each document are dealt
out by hash, and the part that a pair falls to holds both its count table and the pairs to
be scored, so counting and joining are one shuffle. What a part adds to a document's
score is dealt back by document and summed.

All other words are rare. Pairs with a rare word are dealt by that word, so the part it falls to
holds all its occurrences: it counts word and pairs there. A pair of two rare words goes to both
parts; the first one's scores it if other documents hold it, the second one's if none does.

``S(w2 | w1) = c(w1 w2) / c(w1)``, where ``c(w1 w2)`` counts other documents only;
without any, ``S = BACKOFF * c(w2) / N``. The first word scores ``c(w) / N``. A
document's score is the sum of the logarithms.

A pair can only be frequent if both of its words are. Words with a ``1 / HOT`` share of all
words or more are at most ``HOT``; pairs of two such words are counted in one dense table
of that bounded size, and scored where the text is read. So no part receives a pair
that very many documents hold.

Defined results: null and blank texts score null with 0 words; one word scores by its count
alone. Rows that repeat id and text score alike, each other's copies counting as
other documents; null ids stay null. Columns but id and text are ignored. Texts of any
length are taken whole. No rows give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.shared import block_rows, dealt, from_planes, parts, planes, sum_of_blocks, table, written
from buyerlens.llm.words import U, mix, words_of

VOCABULARY_BITS = 20
HOT = 2048
BACKOFF = 0.4
_STEPS = 8  # steps of frequency per power of two; the least frequent one that fits whole is the last that is numbered
_BLOCK = 1 << 16
_HELD = 1 << 19  # counts of words that a task holds before it hands them on
_LAST = (1 << 63) - 1  # stands for a null id
_FLUSH = 8 << 20  # bytes of text after which a task hands its pairs on

WORD_COUNTS = "word long, n long"
COUNTS = "block int, counts binary"
# Documents with how many of the entries each owns; entries: a pair of words and how often the document holds it.
# A pair is that of two numbers, or a rare word's hash in ``words`` with its neighbour.
PACKED = "part int, ids binary, texts binary, runs binary, pairs binary, own binary, words binary"
_PACKED = (8, 4, 4, 5, 4)
_PACKED_RARE = (8, 4, 4, 8, 4, 8)
# The neighbour of a rare word: a number, or 61 bits of a hash, or none at the edge of a document; and on which side it is.
_RARE, _EDGE, _BEFORE = U(1 << 63), U(1 << 62), U(1 << 61)
# Sums for documents: of logarithms, words, and rows seen.
SUMS = "part int, ids binary, texts binary, sums binary, words binary, rows binary"
SCORES = "doc_id long, n_words long, log_score double"


class _Vocabulary:
    """Numbers and counts of the most frequent words, the most frequent one being 0; ``total`` counts all words."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int):
        order = np.argsort(words)
        rank = np.empty(len(order), dtype=np.int32)
        rank[np.lexsort((words, -counts))] = np.arange(len(order), dtype=np.int32)
        self._words = np.append(words[order], U((1 << 64) - 1))
        self._numbers = np.append(rank[order], np.int32(-1))
        # Hashes are spread evenly, so their first bits tell nearly where they stand.
        starts = np.arange(1 << VOCABULARY_BITS, dtype=U) << U(64 - VOCABULARY_BITS)
        self._starts = np.searchsorted(self._words[:-1], starts).astype(np.int32)
        self.counts = np.empty(len(order), dtype=np.int64)
        self.counts[rank] = counts
        self.total = max(1, total)
        self.n_hot = int(np.count_nonzero(self.counts * HOT >= self.total))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for rare ones."""
        at = self._starts[(hashes >> U(64 - VOCABULARY_BITS)).astype(np.int64)]
        left = np.flatnonzero(self._words[at] < hashes)
        while len(left):
            at[left] += 1
            left = left[self._words[at[left]] < hashes[left]]
        return np.where(self._words[at] == hashes, self._numbers[at], -1).astype(np.int64)

    def single(self, numbers: np.ndarray) -> np.ndarray:
        return np.log(self.counts[numbers] / self.total)

    def pair(self, pairs: np.ndarray, others: np.ndarray) -> np.ndarray:
        first, second = pairs >> VOCABULARY_BITS, pairs & ((1 << VOCABULARY_BITS) - 1)
        seen = np.log(np.maximum(others, 1) / self.counts[first])
        return np.where(others > 0, seen, np.log(BACKOFF) + self.single(second))


def _count_words(batches):
    held, size = [], 0

    def merged():
        words, counts = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(words)
        first = np.flatnonzero(np.append(True, np.diff(words[order]) != 0))
        return pa.RecordBatch.from_arrays(
            [pa.array(words[order][first].view(np.int64)), pa.array(np.add.reduceat(counts[order], first))], names=["word", "n"])

    for batch in batches:
        for w in words_of(batch.column(0), lower=True):
            if len(w.hashes):
                held.append(np.unique(w.hashes, return_counts=True))
                size += len(held[-1][0])
            if size > _HELD:
                yield merged()
                held, size = [], 0
    if held:
        yield merged()


def _vocabulary(texts: DataFrame, most: int) -> _Vocabulary:
    """At most ``most`` words, the most frequent ones; of words about as frequent as the next one, none."""
    counts = written(texts.mapInArrow(_count_words, WORD_COUNTS).groupBy("word").agg(F.sum("n").alias("n")), "words")
    step = F.floor(F.log2("n") * _STEPS)
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).orderBy(F.desc("step")).collect()
    fit = [row.step for row, words in zip(steps, np.cumsum([row.words for row in steps])) if words <= most]

    def packed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c.to_numpy().tobytes()], pa.binary()) for c in batch.columns], names=["words", "counts"])

    found = counts.where(step >= fit[-1]).mapInArrow(packed, "words binary, counts binary").collect() if fit else []
    words, numbers = (np.frombuffer(b"".join(x), dtype=np.int64) for x in (list(zip(*found)) or ((), ())))
    return _Vocabulary(words.view(U), numbers, sum(row.n for row in steps))


def _pairs(w, number: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, pair of numbered words) of a slice and how often each occurs."""
    inside = np.flatnonzero((row[1:] == row[:-1]) & (number[1:] >= 0) & (number[:-1] >= 0))
    pair = (number[inside] << VOCABULARY_BITS) | number[inside + 1]
    if w.n_rows < 1 << 63 - 2 * VOCABULARY_BITS - 4:
        key, own = np.unique((row[inside] << (2 * VOCABULARY_BITS)) | pair, return_counts=True)
        return key >> (2 * VOCABULARY_BITS), key & ((1 << 2 * VOCABULARY_BITS) - 1), own
    both, own = np.unique(np.stack([row[inside], pair]), axis=1, return_counts=True)
    return both[0], both[1], own


def _rare_pairs(w, number: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (text, rare word, neighbour) of a slice and how often each occurs; each rare word has one neighbour on each side."""
    rare = np.flatnonzero(number < 0)
    found = []
    for step, side in ((1, U(0)), (-1, _BEFORE)):
        at = rare + step
        inside = (at >= 0) & (at < len(row))
        at = np.where(inside, at, rare)
        inside &= row[at] == row[rare]
        code = np.where(number[at] >= 0, number[at].astype(U), (w.hashes[at] >> U(3)) | _RARE)
        found.append(np.where(inside, code, _EDGE) | side)
    rows, words, neighbours = np.tile(row[rare], 2), np.tile(w.hashes[rare], 2), np.concatenate(found)
    order = np.lexsort((neighbours, words, rows))
    rows, words, neighbours = rows[order], words[order], neighbours[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(rows) != 0) | (words[1:] != words[:-1]) | (neighbours[1:] != neighbours[:-1])
    first = np.flatnonzero(new)
    return rows[first], words[first], neighbours[first], np.diff(np.append(first, len(order)))


def _count_hot(shared, size: int):
    """Counts of pairs of two frequent words."""
    def run(batches):
        vocabulary = shared.value
        n_hot = vocabulary.n_hot
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for w in words_of(batch.column(0), lower=True):
                number, row = vocabulary.numbers(w.hashes), w.rows()
                hot = (number >= 0) & (number < n_hot)
                hot = hot[1:] & hot[:-1] & (row[1:] == row[:-1])
                np.add.at(counts, number[:-1][hot] * n_hot + number[1:][hot], 1)
        yield from _count_batch(counts)

    return run


def _count_batch(counts: np.ndarray):
    for block, found in block_rows(counts, _BLOCK):
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([found], pa.binary())], names=["block", "counts"])


def _deal(shared, hot_pairs, n_parts: int):
    """Pairs by part; sums known at once go to parts from ``n_parts`` on, by document, and rare words to those after them."""
    def run(batches):
        vocabulary, hot = shared.value, hot_pairs.value
        n_hot = vocabulary.n_hot
        for batch in batches:
            ids, texts = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            held, rare, size = [], [], 0
            for w in words_of(batch.column(2), lower=True):
                number, rows = vocabulary.numbers(w.hashes), w.rows()
                row, pair, own = _pairs(w, number, rows)
                a, b = pair >> VOCABULARY_BITS, pair & ((1 << VOCABULARY_BITS) - 1)
                known = (a < n_hot) & (b < n_hot)
                others = hot[a[known] * n_hot + b[known]] - own[known]
                sums = np.bincount(row[known], vocabulary.pair(pair[known], others) * own[known], w.n_rows).astype(np.float64)
                full = np.flatnonzero(w.counts > 0)
                first = number[w.bounds[:-1][full]]
                sums[full[first >= 0]] += vocabulary.single(first[first >= 0])
                held.append((w.first + np.arange(w.n_rows), sums, w.counts, w.first + row[~known], pair[~known], own[~known]))
                row, *entries = _rare_pairs(w, number, rows)
                rare.append((w.first + row, *entries))
                size += len(w.data)
                if size > _FLUSH:
                    yield from _packed(ids, texts, held, rare, n_parts)
                    held, rare, size = [], [], 0
            if held:
                yield from _packed(ids, texts, held, rare, n_parts)

    return run


def _document_part(ids: np.ndarray, texts: np.ndarray, n_parts: int) -> np.ndarray:
    return (mix(ids.astype(U) ^ (texts.astype(U) << U(32))) % U(n_parts)).astype(np.int64)


def _by(part: np.ndarray):
    order = np.argsort(part, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        if len(own):
            yield int(part[own[0]]), own


def _owners(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that own entries, and how many follow each other."""
    first = np.concatenate(([0], np.flatnonzero(np.diff(row)) + 1))
    return row[first], np.diff(np.append(first, len(row)))


def _batch(schema: str, rows: list[tuple]):
    names = [x.split()[0] for x in schema.split(", ")]
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=names)


def _packed(ids, texts, held, rare, n_parts: int):
    doc, sums, words, row, pair, own = (np.concatenate(x) for x in zip(*held))
    out = []
    for part, k in _by(n_parts + _document_part(ids[doc], texts[doc], n_parts)):
        out.append((part, planes(ids[doc[k]], 8), planes(texts[doc[k]], 4), planes(words[k], 4), sums[k].tobytes(), b"", b""))
    for part, k in _by((mix(pair.astype(U)) % U(n_parts)).astype(np.int64)):
        who, runs = _owners(row[k])
        out.append((part, *map(planes, (ids[who], texts[who], runs, pair[k], own[k]), _PACKED), b""))
    row, word, neighbour, own = (np.concatenate(x) for x in zip(*rare))
    for part, k in _by(2 * n_parts + (mix(word) % U(n_parts)).astype(np.int64)):
        who, runs = _owners(row[k])
        out.append((part, *map(planes, (ids[who], texts[who], runs, neighbour[k], own[k], word[k]), _PACKED_RARE)))
    for a in range(0, len(out), 64):
        yield _batch(PACKED, out[a: a + 64])


def _parts_of(batches, handle):
    part, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != part:
                if rows:
                    yield from handle(part, rows)
                part, rows = row[0], []
            rows.append(row[1:])
    if rows:
        yield from handle(part, rows)


def _others(own: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How often other entries of each group hold what an entry holds ``own`` times; groups begin at ``first`` of ``order``."""
    out = np.empty_like(own)
    out[order] = np.repeat(np.add.reduceat(own[order], first), np.diff(np.append(first, len(order)))) - own[order]
    return out


def _rare_values(vocabulary: _Vocabulary, words: np.ndarray, neighbours: np.ndarray, own: np.ndarray) -> np.ndarray:
    """What each entry of a rare word adds to its document's score."""
    order = np.lexsort((neighbours, words))
    new = np.append(True, words[order][1:] != words[order][:-1])
    other = new.copy()
    other[1:] |= neighbours[order][1:] != neighbours[order][:-1]
    seen = _others(own, order, np.flatnonzero(other))
    after = neighbours & _BEFORE == 0
    # A word occurs as often as something, or the end of its document, comes after it.
    first = np.flatnonzero(new)
    count = np.empty(len(own), dtype=np.int64)
    count[order] = np.repeat(np.add.reduceat(np.where(after, own, 0)[order], first), np.diff(np.append(first, len(order))))
    edge, rare = neighbours & _EDGE != 0, neighbours & _RARE != 0
    beside = np.where(edge | rare, -1, (neighbours & ~_BEFORE).astype(np.int64))
    numbered = beside >= 0
    single = np.log(count / vocabulary.total)
    first_count, second = count.copy(), single.copy()
    first_count[numbered & ~after] = vocabulary.counts[beside[numbered & ~after]]
    second[numbered & after] = vocabulary.single(beside[numbered & after])
    value = np.where(seen > 0, np.log(np.maximum(seen, 1) / first_count), np.log(BACKOFF) + second)
    value[rare & (after == (seen == 0))] = 0.0  # the other word's part adds it
    value[edge] = np.where(after, 0.0, single)[edge]
    return value


def _score_pairs(shared, n_parts: int):
    """Count the pairs of each part, score its entries, and sum them by document."""
    def handle(part: int, rows: list[tuple]):
        if n_parts <= part < 2 * n_parts:
            for ids, texts, words, sums, *_ in rows:
                n = len(ids) // 8
                yield _batch(SUMS, [(part - n_parts, ids, texts, sums, words, planes(np.ones(n, dtype=np.int64), 4))])
            return
        kinds = _PACKED if part < n_parts else _PACKED_RARE
        ids, texts, runs, pairs, own, *words = (np.concatenate([from_planes(r[k], n) for r in rows]) for k, n in enumerate(kinds))
        if words:
            value = _rare_values(shared.value, words[0].view(U), pairs.view(U), own) * own
        else:
            order = np.argsort(pairs)
            first = np.concatenate(([0], np.flatnonzero(np.diff(pairs[order])) + 1))
            value = shared.value.pair(pairs, _others(own, order, first)) * own
        sums = np.add.reduceat(value, np.cumsum(runs) - runs)
        out = []
        for to, k in _by(_document_part(ids, texts, n_parts)):
            none = np.zeros(len(k), dtype=np.int64)
            out.append((to, planes(ids[k], 8), planes(texts[k], 4), sums[k].tobytes(), planes(none, 4), planes(none, 4)))
        for a in range(0, len(out), 64):
            yield _batch(SUMS, out[a: a + 64])

    return lambda batches: _parts_of(batches, handle)


def _sum_documents(batches):
    def handle(part: int, rows: list[tuple]):
        ids, texts, words, seen = (
            np.concatenate([from_planes(r[k], n) for r in rows]) for k, n in ((0, 8), (1, 4), (3, 4), (4, 4)))
        sums = np.concatenate([np.frombuffer(r[2], dtype=np.float64) for r in rows])
        order = np.lexsort((texts, ids))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(ids[order]) != 0) | (np.diff(texts[order]) != 0)
        first = np.flatnonzero(new)
        seen, words, sums = (np.add.reduceat(x[order], first) for x in (seen, words, sums))
        ids = np.repeat(ids[order][first], seen)
        words, sums = np.repeat(words // seen, seen), np.repeat(sums / seen, seen)
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, mask=ids == _LAST), pa.array(words), pa.array(sums, mask=words == 0),
        ], names=["doc_id", "n_words", "log_score"])

    return _parts_of(batches, handle)


def lm_scores(docs: DataFrame, vocabulary: int = 1 << VOCABULARY_BITS) -> DataFrame:
    """One row per document: doc_id, n_words, log_score.

    ``vocabulary`` is the most words that are numbered, at most ``2^VOCABULARY_BITS``; results do not depend on it.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id_key"),
        F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("text_key"), text.alias("text"),
    )
    found = _vocabulary(keyed.select("text"), min(vocabulary, 1 << VOCABULARY_BITS))
    shared = spark.sparkContext.broadcast(found)
    size = -(-max(1, found.n_hot ** 2) // _BLOCK) * _BLOCK
    hot = sum_of_blocks(keyed.select("text").mapInArrow(_count_hot(shared, size), COUNTS), size, _BLOCK)
    hot_pairs = spark.sparkContext.broadcast(hot)
    n_parts = parts(spark)
    pairs = dealt(keyed.mapInArrow(_deal(shared, hot_pairs, n_parts), PACKED))
    return dealt(pairs.mapInArrow(_score_pairs(shared, n_parts), SUMS)).mapInArrow(_sum_documents, SCORES)


def op7_lm_score(spark, folder: str) -> DataFrame:
    scores = lm_scores(table(spark, folder, "documents"))
    return scores.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
