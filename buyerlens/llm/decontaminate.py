"""Benchmark decontamination: BM25 with block-max WAND over an inverted index of the test items.

Every training document is cut into overlapping passages, and every passage is a query.
An item is retrieved when its BM25 score reaches the least score that a passage
holding enough of it can have; that level is derived per item from the overlap asked for, so
retrieval loses nothing that verification would accept. A passage is skipped when the
summed maxima of its terms stay below every level, a block of items when the summed block
maxima do; only the rest is scored term by term. Verification counts how many of the
five-word runs of the item's question and of its answer the passage holds; both shares must
reach ``overlap``. The last quarter of an item's words stands for its answer.

Items are queried in groups of like length, a passage being twice the longest item of its
group and passages overlapping by half, so any stretch as long as an item lies in one.
The index goes to every task, ``MAX_ITEMS`` items at most; more are handled in several
rounds over the documents, split by a hash of the item. There is no shuffle: a
document is judged where it is read.

Defined results: null and blank documents match nothing; items without words are left out;
items and documents that repeat are matched one by one; items with fewer words than a run
are compared whole. Null ids pass through. Other columns are ignored (or passed through by
``clean_documents``). Texts of any length are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.shared import table
from buyerlens.llm.words import PLAIN_WORDS, U, Words, words_of

RUN = 5
OVERLAP = 0.8
MAX_ITEMS = 20_000
BLOCK = 16
K1, B = 1.2, 0.75
_SHORTEST = 32
_LEVEL = 1 - 1e-9  # scores are shares of an item's level
_AT_ONCE = 1 << 17  # words of passages that are looked up at once
_STEP = 1 << 20  # bytes of text that are worked on at once
_SEEN_BITS = 16
_SEEN_MASK = U((1 << _SEEN_BITS) - 1)

MATCHES = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts``."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _item_runs(w: Words, a: int, b: int) -> np.ndarray:
    """Runs of the words from a to b; all of them as one run if they are fewer than a run."""
    n = min(RUN, b - a)
    return w.grams(n)[0][a: b - n + 1]


class ItemIndex:
    """Items of one length group: postings of terms by block and by item, weights in shares of each item's level."""

    def __init__(self, ids: list, w: Words, rows: np.ndarray, document_share: dict[int, float], mean: float, overlap: float):
        self.overlap = overlap
        self.reach = 1 << max(int(_SHORTEST).bit_length() - 1, int(max(w.counts[rows]) - 1).bit_length())
        rows = rows[np.argsort(w.counts[rows], kind="stable")]
        self.ids, self.short = [ids[r] for r in rows], set()
        self.question, self.answer, terms, items, weights = [], [], [], [], []
        for k, row in enumerate(rows):
            a, b = w.bounds[row], w.bounds[row + 1]
            n = b - a
            cut = b - n // 4 if n >= 4 * RUN else b
            self.question.append(_item_runs(w, a, cut))
            self.answer.append(_item_runs(w, cut, b) if cut < b else self.question[-1])
            if n < RUN:
                self.short.add(n)
            own, count = np.unique(w.hashes[a:b], return_counts=True)
            idf = np.array([document_share[h] for h in own.tolist()])
            weight = idf * count * (K1 + 1) / (count + K1 * (1 - B + B * n / mean))
            missing = sum(int((1 - overlap) * len(x) + 1e-9) for x in (
                [self.question[-1], self.answer[-1]] if cut < b else [self.question[-1]]))
            level = weight.sum() - np.sort(weight)[::-1][:missing].sum()
            terms.append(own)
            items.append(np.full(len(own), k))
            weights.append(weight / max(level, 1e-12))
        terms, items, weights = np.concatenate(terms), np.concatenate(items), np.concatenate(weights)
        order = np.lexsort((items, terms))
        terms, self.items, self.weights = terms[order], items[order], weights[order]
        first = np.concatenate(([0], np.flatnonzero(np.diff(terms)) + 1))
        self.terms = terms[first]
        self.at = np.append(first, len(terms))
        self.most = np.maximum.reduceat(self.weights, first)
        blocks = self.items // BLOCK
        edge = np.ones(len(terms), dtype=bool)
        edge[1:] = (terms[1:] != terms[:-1]) | (blocks[1:] != blocks[:-1])
        edge = np.flatnonzero(edge)
        self.block, self.block_most = blocks[edge], np.maximum.reduceat(self.weights, edge)
        self.block_at = np.searchsorted(edge, self.at)
        self.edge = np.append(edge, len(terms))
        self.n_blocks = len(rows) // BLOCK + 1

    def candidates(self, lo: np.ndarray, hi: np.ndarray, terms: np.ndarray):
        """(passage, item, score) of all that reach an item's level; ``terms[lo:hi]`` are the words of a passage that items hold.

        All passages of a slice go through the bounds at once: first the maxima of their
        distinct terms, then those of each block, and last the items of the blocks that are left.
        """
        most = np.concatenate(([0.0], np.cumsum(self.most[terms])))
        likely = np.flatnonzero(most[hi] - most[lo] >= _LEVEL)
        sizes = hi[likely] - lo[likely]
        at = 0
        while at < len(likely):  # some passages at a time, so that their postings stay few
            to = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), _AT_ONCE)) + at)
            own = np.repeat(np.arange(at, to), sizes[at:to])
            pair = np.unique(own * len(self.terms) + terms[ranges(lo[likely[at:to]], sizes[at:to])])
            own, term = np.divmod(pair, len(self.terms))
            enough = np.bincount(own, self.most[term], to) >= _LEVEL
            own, term = own[enough[own]], term[enough[own]]
            number = self.block_at[term + 1] - self.block_at[term]
            posting = ranges(self.block_at[term], number)
            key, place = np.unique(np.repeat(own, number) * self.n_blocks + self.block[posting], return_inverse=True)
            enough = np.bincount(place, self.block_most[posting], len(key)) >= _LEVEL
            own, posting = np.repeat(own, number)[enough[place]], posting[enough[place]]
            number = self.edge[posting + 1] - self.edge[posting]
            posting = ranges(self.edge[posting], number)
            key, place = np.unique(np.repeat(own, number) * len(self.ids) + self.items[posting], return_inverse=True)
            score = np.bincount(place, self.weights[posting], len(key))
            found = np.flatnonzero(score >= _LEVEL)
            yield from zip(likely[key[found] // len(self.ids)].tolist(), (key[found] % len(self.ids)).tolist(), score[found].tolist())
            at = to

    def shares(self, item: int, a: int, b: int, runs) -> list[float]:
        """The shares of the item's question and answer that the words from a to b hold."""
        out = []
        for part in (self.question[item], self.answer[item]):
            n = RUN
            if len(part) == 1 and not np.isin(part, runs(RUN)[a: max(a, b - RUN + 1)]).any():
                n = next((m for m in self.short if np.isin(part, runs(m)[a: max(a, b - m + 1)]).any()), RUN)
            out.append(float(np.isin(part, runs(n)[a: max(a, b - n + 1)]).mean()))
        return out


class Index:
    """The items of all length groups over one vocabulary."""

    def __init__(self, groups: list[ItemIndex]):
        self.groups = groups
        self.words = np.unique(np.concatenate([g.terms for g in groups]))
        self.seen = np.zeros(1 << _SEEN_BITS, dtype=bool)  # most words are told apart by some of their bits
        self.seen[(self.words & _SEEN_MASK).astype(np.int64)] = True
        self.slots = []
        for g in groups:
            slot = np.full(len(self.words), -1, dtype=np.int64)
            slot[np.searchsorted(self.words, g.terms)] = np.arange(len(g.terms))
            self.slots.append(slot)

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that items hold, and their numbers in the vocabulary."""
        places = np.flatnonzero(self.seen[(hashes & _SEEN_MASK).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.words, hashes[places]), len(self.words) - 1)
        same = self.words[number] == hashes[places]
        return places[same], number[same]

    def matches(self, w: Words):
        """(row, group, item, score, question, answer) of each passage that holds enough of an item."""
        if not len(w.hashes):
            return
        places, number = self.known(w.hashes)
        grams: dict[int, np.ndarray] = {}

        def runs(n: int) -> np.ndarray:
            if n not in grams:
                grams[n] = w.grams(n)[0]
            return grams[n]

        for g, (group, slot) in enumerate(zip(self.groups, self.slots)):
            terms = slot[number]
            own = terms >= 0
            terms, at = terms[own], places[own]
            passages = np.maximum(1, -(-w.counts // group.reach) - 1)
            row = np.repeat(np.arange(w.n_rows), passages)
            place = np.arange(len(row)) - np.repeat(np.cumsum(passages) - passages, passages)
            first = w.bounds[:-1][row] + place * group.reach
            last = np.minimum(first + 2 * group.reach, w.bounds[1:][row])
            for p, item, score in group.candidates(np.searchsorted(at, first), np.searchsorted(at, last), terms):
                share = group.shares(item, int(first[p]), int(last[p]), runs)
                if min(share) >= group.overlap - 1e-9:
                    yield int(row[p]), g, item, score, *share


def build_index(ids: list, texts: list[str], overlap: float = OVERLAP) -> Index | None:
    slices = list(words_of(pa.array([t or "" for t in texts], pa.string()).cast(pa.large_string()), True, PLAIN_WORDS))
    if not slices:
        return None
    # One Words for all items: they are few.
    bounds = np.concatenate(([0], np.cumsum(np.concatenate([w.counts for w in slices]))))
    w = Words(0, bounds, np.concatenate([x.hashes for x in slices]), slices[0].data, bounds, bounds)
    rows = np.flatnonzero(w.counts > 0)
    if not len(rows):
        return None
    held = np.unique(np.stack([w.rows().astype(U), w.hashes]), axis=1)[1]
    terms, df = np.unique(held, return_counts=True)
    idf = dict(zip(terms.tolist(), np.log1p((len(rows) - df + 0.5) / (df + 0.5)).tolist()))
    group = np.array([max(int(_SHORTEST).bit_length() - 1, int(n - 1).bit_length()) for n in w.counts[rows]])
    return Index([ItemIndex(ids, w, rows[group == g], idf, float(w.counts[rows].mean()), overlap) for g in np.unique(group)])


def item_rounds(benchmark: DataFrame, overlap: float = OVERLAP, max_items: int = MAX_ITEMS):
    """Indexes over all items, for each round of at most about ``max_items`` of them."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    rounds = -(-items.count() // max_items)
    for k in range(rounds):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == k).collect()
        found = build_index([r["item_id"] for r in own], [r["text"] for r in own], overlap)
        if found:
            yield found


def _best(index: Index, column: pa.Array):
    """(text, group, item) -> best (score, question, answer) over the passages of a text."""
    best: dict[tuple, tuple] = {}
    for w in words_of(column, True, PLAIN_WORDS, _STEP):
        for row, g, item, *values in index.matches(w):
            key = (w.first + row, g, item)
            best[key] = max(best.get(key, (0.0, 0.0, 0.0)), tuple(values))
    return best


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP, max_items: int = MAX_ITEMS) -> DataFrame:
    """One row per document and item that it holds."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], MATCHES)
    for found in item_rounds(benchmark, overlap, max_items):
        shared = spark.sparkContext.broadcast(found)

        def run(batches, shared=shared):
            names = [x.split()[0] for x in MATCHES.split(", ")]
            for batch in batches:
                index, ids = shared.value, batch.column(0)
                best = _best(index, batch.column(1))
                if best:
                    rows = [(ids[r].as_py(), index.groups[g].ids[i], *v) for (r, g, i), v in best.items()]
                    kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 3]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        out = out.unionByName(texts.mapInArrow(run, MATCHES))
    return out


def _leaks(shared):
    @F.arrow_udf("boolean")
    def leaks(column: pa.Array) -> pa.Array:
        out = np.zeros(len(column), dtype=bool)
        out[[r for r, _, _ in _best(shared.value, column)]] = True
        return pa.array(out)

    return leaks


def clean_documents(docs: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP, max_items: int = MAX_ITEMS) -> DataFrame:
    """The documents that hold no item, with their columns."""
    for found in item_rounds(benchmark, overlap, max_items):
        docs = docs.where(~_leaks(docs.sparkSession.sparkContext.broadcast(found))(F.col("text")))
    return docs


def op4_decontaminate(spark, folder: str) -> DataFrame:
    return benchmark_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
