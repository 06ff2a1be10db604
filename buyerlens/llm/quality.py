"""Quality classifier by importance resampling.

Target text (labelled good and not toxic) and raw text (every document) are described by
generative models over hashed word n-grams: in how many documents a word occurs, and how
often words and word pairs do. The weight of a document is the log ratio of target to raw, taken over
its least likely word (``toxic``) and over its least likely segment of ``SEGMENT`` words
(``poor``, a repeated word being one kind of pair), so that a long document cannot hide
one; the smaller of the two counts, each as distance from its level. The raw models count the whole corpus;
labelled toxic or poor text makes up the share ``KNOWN`` of them, as a corpus in which such
text is rare tells little about it.

Target and labelled text are fitted on a bounded sample of labelled rows
(``max_labelled``, taken by hash). The levels are those at which good and other labelled
rows part best: for ``toxic`` a good row is judged with its own words taken out of the target model, for
``poor`` one half of the sample is judged by models of the other half. Sampling is Gumbel top-k: the ``k``
largest ``log_weight + temperature * Gumbel noise`` stay. By default ``k`` is the number of documents at or
above both levels, so the sample is as large as what the levels part off, and noise decides who
is in it near them; ``keep`` gives another share. The noise is a hash of id, text and seed, so a lost task
repeats it.

Every document is counted and scored, on its whole text. The k-th score is found by histograms of
1,024 bins that narrow down, never by sorting in one task. Only count tables, at most
``max_labelled`` scores and histograms reach the driver.

Defined results: null and blank texts hold no words, weigh ``EMPTY`` and count as poor.
Rows with the same score stay or go together, so ties may exceed ``k``. Without labels
of a kind there is no level for it and nothing is lost by it; without good labels every document weighs 0. Several
labels of one document count as the worst of them; null labels and labels of no document are ignored. Other
columns pass through. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.shared import block_rows, sum_of_blocks, table, written
from buyerlens.llm.words import U, WORDS_AND_MARKS, words_of

MAX_LABELLED = 20_000
BUCKET_BITS = 18
SEGMENT = 16
TEMPERATURE = 0.1
KNOWN = 0.5
LOST = 3
EMPTY = -10.0
_BLOCK = 1 << 14
_SIZE = 1 << BUCKET_BITS
_STEP = 1 << 20  # bytes of text that are worked on at once
_REPEAT = 1  # the bucket of a word followed by itself
KINDS = ("good", "poor", "toxic", "raw")
FEATURES = ("documents", "words", "pairs")


def _buckets(column: pa.Array):
    """Per slice of texts: bounds, bucket of each word, and of each word with the next (-1 at the end of a text)."""
    for w in words_of(column, classes=WORDS_AND_MARKS, step=_STEP):
        words = (w.hashes >> U(64 - BUCKET_BITS)).astype(np.int64)
        grams, inside = w.grams(2)
        pairs = (grams >> U(64 - BUCKET_BITS)).astype(np.int64)
        pairs[:-1][w.hashes[1:] == w.hashes[:-1]] = _REPEAT
        pairs[~inside] = -1
        yield w, words, pairs


def _count(batches):
    """Counts of (text, kind, fitting): tables one after the other, by kind and feature; pairs and words of fitting rows only."""
    counts = np.zeros(len(KINDS) * len(FEATURES) * _SIZE, dtype=np.int64)
    for batch in batches:
        kinds = batch.column(1).to_numpy().astype(np.int64)
        fitting = batch.column(2).to_numpy(zero_copy_only=False)
        for w, words, pairs in _buckets(batch.column(0)):
            kind = kinds[w.first: w.first + w.n_rows]
            row = np.repeat(np.arange(w.n_rows), w.counts)
            own = kind[row] * len(FEATURES) * _SIZE
            once = np.unique(row * _SIZE + words)
            fit = fitting[w.first: w.first + w.n_rows][row]
            places = (kind[once // _SIZE] * len(FEATURES) * _SIZE + once % _SIZE, (own + _SIZE + words)[fit],
                      (own + 2 * _SIZE + pairs)[fit & (pairs >= 0)])
            for place in places:
                found, number = np.unique(place, return_counts=True)
                counts[found] += number
    for block, found in block_rows(counts, _BLOCK):
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([found], pa.binary())], names=["block", "counts"])


@dataclass
class Model:
    """Documents with each word, in target and raw text; log ratios of words and pairs; and the level of each."""

    target: np.ndarray | None = None
    raw: np.ndarray | None = None
    poor: tuple[np.ndarray, np.ndarray] | None = None
    levels: dict[str, float] = field(default_factory=lambda: {"toxic": 0.0, "poor": 0.0})

    def ratios(self, column: pa.Array, in_target: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The least ratio of any word under ``toxic`` and of any segment under ``poor``; NaN where there is no word.

        ``in_target`` says which texts the target model has counted; they are judged as if it had not.
        """
        toxic, poor = np.full(len(column), np.nan), np.full(len(column), np.nan)
        for w, words, pairs in _buckets(column):
            full = np.flatnonzero(w.counts > 0)
            if not len(full):
                continue
            at, rows = w.bounds[full], w.first + full
            toxic[rows] = poor[rows] = 0.0
            if self.target is not None:
                known = 0 if in_target is None else in_target[w.first + w.rows()]
                ratio = np.log((np.maximum(self.target[words] - known, 0) + 1) / (self.raw[words] + 1))
                toxic[rows] = np.minimum.reduceat(ratio, at)
            if self.poor is None:
                continue
            own = self.poor[0][words] + np.where(pairs >= 0, self.poor[1][pairs], 0.0)
            sums = np.concatenate(([0.0], np.cumsum(own, dtype=np.float64)))
            ends = np.repeat(w.bounds[1:], w.counts)
            starts = np.repeat(w.bounds[:-1], w.counts)
            first = np.arange(len(own))
            segment = sums[np.minimum(first + SEGMENT, ends)] - sums[first]
            # Only whole segments count, or the whole text where it is shorter.
            segment[(first + SEGMENT > ends) & (first > starts)] = np.inf
            poor[rows] = np.minimum.reduceat(segment, at)
        return toxic, poor

    def log_weights(self, column: pa.Array) -> np.ndarray:
        toxic, poor = self.ratios(column)
        least = np.minimum(toxic - self.levels["toxic"], poor - self.levels["poor"])
        return np.where(np.isnan(least), EMPTY, least)


def _best_level(good: np.ndarray, bad: np.ndarray) -> float:
    """The level that parts good from bad with the smallest sum of error shares, lost good rows counting ``LOST`` times."""
    values = np.unique(np.concatenate((good, bad)))
    if not len(good) or not len(bad):
        return -np.inf
    levels = (values[1:] + values[:-1]) / 2
    levels = np.concatenate(([values[0]], levels, [values[-1] + 1]))
    lost = np.searchsorted(np.sort(good), levels) / len(good)
    missed = 1 - np.searchsorted(np.sort(bad), levels) / len(bad)
    return float(levels[np.argmin(LOST * lost + missed)])


def _mixed(raw: np.ndarray, known: np.ndarray, scale: float, raw_scale: float, known_scale: float) -> np.ndarray:
    """Raw counts as if there were ``scale`` units of text, the share ``KNOWN`` of them from what is known."""
    whole = raw * (scale / max(1.0, raw_scale))
    return (1 - KNOWN) * whole + KNOWN * known * (scale / known_scale) if known_scale else whole


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Target and known text from at most ``max_labelled`` labelled documents, raw text from all of ``docs``."""
    worst = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    kind = F.expr("CASE WHEN toxic = 1 THEN 2 WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 0 END")
    sample = worst.select(F.col("doc_id").cast("long").alias("doc_id"), kind.alias("kind")).where("kind IS NOT NULL")
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    rows = written(rows.select("text", "kind", (F.xxhash64("doc_id", F.lit("half")) % 2 == 0).alias("fitting")), "labelled")
    n_docs = {r["kind"]: r["count"] for r in rows.groupBy("kind").count().collect()}
    model = Model()
    if not n_docs.get(0):
        return model
    counted = rows.repartition(8).unionByName(docs.select("text", F.lit(3).alias("kind"), F.lit(True).alias("fitting")))
    size = len(KINDS) * len(FEATURES) * _SIZE
    counts = sum_of_blocks(counted.select("text", "kind", "fitting").mapInArrow(_count, "block int, counts binary"), size, _BLOCK)
    good, poor, toxic, raw = counts.reshape(len(KINDS), len(FEATURES), _SIZE).astype(np.float64)
    model.target = good[0].astype(np.float32)
    model.raw = _mixed(raw[0], toxic[0], n_docs[0], docs.count(), n_docs.get(2, 0)).astype(np.float32)
    model.poor = tuple(
        _log_ratio(good[k], _mixed(raw[k], poor[k], good[k].sum(), raw[k].sum(), poor[k].sum())) for k in (1, 2))

    def ratios(batches):
        for batch in batches:
            found = model.ratios(batch.column(0), batch.column(1).to_numpy() == 0)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *map(pa.array, found)], names=["kind", "fitting", "toxic", "poor"])

    judged = rows.select("text", "kind", "fitting").mapInArrow(ratios, "kind int, fitting boolean, toxic double, poor double")
    judged = judged.where("NOT isnan(toxic)").collect()
    for name, code in (("toxic", 2), ("poor", 1)):
        used = [r for r in judged if name == "toxic" or not r["fitting"]]
        model.levels[name] = _best_level(*(np.array([r[name] for r in used if r["kind"] == k]) for k in (0, code)))
    return model


def _log_ratio(good: np.ndarray, poor: np.ndarray, pseudo: float = 0.1) -> np.ndarray:
    """Shares in good over shares in poor text, both drawn to their pooled share."""
    pooled = (good + poor) / max(1.0, good.sum() + poor.sum())
    weight = pseudo * len(good)
    a = (good + weight * pooled) / (good.sum() + weight)
    b = (poor + weight * pooled) / (poor.sum() + weight)
    return np.where(pooled > 0, np.log((a + 1e-15) / (b + 1e-15)), 0.0).astype(np.float32)


def weigh(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``log_weight``."""
    @F.arrow_udf("double")
    def log_weight(column: pa.Array) -> pa.Array:
        return pa.array(model.log_weights(column))

    return docs.withColumn("log_weight", log_weight(F.col(text)))


def _perturbed(seed: int, temperature: float):
    """Weight plus Gumbel noise from a hash of id and text."""
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return F.col("log_weight") - temperature * F.log(-F.log(uniform))


def kth_largest(scores: DataFrame, k: int, bins: int = 1024) -> float | None:
    """The ``k``-th largest value of the column ``score``; None if there are fewer rows."""
    low, high, n = scores.agg(F.min("score"), F.max("score"), F.count("score")).first()
    if k <= 0:
        return float("inf")
    if n < k:
        return None
    above = 0  # rows over the bin that is looked into
    while low < high:
        width = (high - low) / bins
        bin_ = F.least(F.floor((F.col("score") - low) / width), F.lit(bins - 1))
        rows = scores.where((F.col("score") >= low) & (F.col("score") <= high)).groupBy(bin_.alias("bin")).agg(
            F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).collect()
        for row in sorted(rows, key=lambda r: -r["bin"]):
            if above + row["n"] >= k:
                break
            above += row["n"]
        if (row["low"], row["high"]) == (low, high):  # as close as numbers get
            break
        low, high = row["low"], row["high"]
    return low


def cutoff(docs: DataFrame, model: Model, keep: float | None = None, seed: int = 0, temperature: float = TEMPERATURE) -> float:
    """The perturbed weight from which documents stay."""
    scores = weigh(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    scores = written(scores.select("log_weight", _perturbed(seed, temperature).alias("score")), "weights")
    n, likely = scores.agg(F.count("*"), F.count(F.when(F.col("log_weight") >= 0, 1))).first()
    found = kth_largest(scores, likely if keep is None else round(n * keep))
    return float("-inf") if found is None else found


def sampled(docs: DataFrame, labels: DataFrame, keep: float | None = None, seed: int = 0,
            temperature: float = TEMPERATURE, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Every document: its columns in ``doc``, ``log_weight``, ``score`` and whether the sampling has ``kept`` it."""
    model = fit(docs, labels, max_labelled)
    least = cutoff(docs, model, keep, seed, temperature)
    packed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    )
    scored = weigh(packed, model).withColumn("score", _perturbed(seed, temperature))
    return scored.withColumn("kept", F.col("score") >= least)


def resample(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the sampling keeps, as rows of ``sampled``."""
    return sampled(docs, labels, **options).where("kept")


def op6_quality_classifier(spark, folder: str) -> DataFrame:
    found = sampled(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))
    return found.select("doc_id", "log_weight", "kept")
