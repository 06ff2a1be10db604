"""What encoding, hashing and the n-gram join hold at once in a Python worker."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from buyerlens.llm import ngram_join, packing, tokens, words
from buyerlens.llm.shared import dealt, shuffle_partitions
from buyerlens.llm.tokens import tokenizer


def test_tokens_are_found_in_little_memory():
    encoder = tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    dice = random.Random(1)
    column = pa.array([" ".join(f"w{dice.randrange(500)}" for _ in range(500)) for _ in range(1500)])
    alone = [ids.tolist() for k in (0, 700, 1499) for _, _, ids in encoder.encode(column.slice(k, 1))]
    tracemalloc.start()
    found = [(first + k, ids[bounds[k]: bounds[k + 1]]) for first, bounds, ids in encoder.encode(column) for k in range(len(bounds) - 1)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [k for k, _ in found] == list(range(1500))
    assert [found[k][1].tolist() for k in (0, 700, 1499)] == alone
    assert peak < 50e6 + sum(ids.nbytes for _, ids in found)  # 3.6 MB of text


def test_powers_are_no_more_than_needed():
    powers = words._Powers(0xD6E8FEB86659FD93)
    few = [x.copy() for x in powers(10)]
    assert len(powers._up) <= 1 << 18
    for a, b in zip(few, powers(600_000)):
        assert np.array_equal(a, b[:10]) and len(b) == 600_000


def _peak(batches) -> tuple[list, float]:
    tracemalloc.start()
    found = list(batches)
    peak = tracemalloc.get_traced_memory()[1] - tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    return found, peak


def test_shingles_are_dealt_and_compared_in_little_memory():
    dice = random.Random(2)
    texts = [[f"w{dice.randrange(25)}" for _ in range(500)] for _ in range(2400)]
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(t) for t in texts])], names=["text"])
    none = np.zeros(1 << ngram_join.SKETCH_BITS, dtype=np.int64)
    packed, dealing = _peak(ngram_join._deal(4, True, 1, none)([batch]))
    found, comparing = _peak(ngram_join._shared_tokens(1)(packed))
    sets = Counter(g for t in texts for g in {tuple(t[k: k + 4]) for k in range(497)})
    got = [x for b in found for x in zip(b.column("token").to_pylist(), b.column("df").to_pylist())]
    assert sorted(Counter(got).items(), key=lambda x: x[0]) == sorted(((x, x[1]) for x in set(got)), key=lambda x: x[0])
    assert Counter(df for _, df in set(got)) == Counter(df for df in sets.values() if df > 1)
    assert dealing < 45e6  # 1.2 million shingles
    assert comparing < 60e6


def test_tasks_get_as_many_parts_each(spark):
    n = shuffle_partitions(spark)
    packed = spark.range(20 * n).select((F.col("id") % (2 * n)).cast("int").alias("part"))
    tasks = dealt(packed).withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count_distinct("part").alias("parts"))
    assert [r.parts for r in tasks.collect()] == [2] * n


def test_a_worker_gives_up_its_tokens_after_packing(spark):
    path = public_tokenizers.path("word_bpe_49k.json")

    def left(batches):
        rows = sum(b.num_rows for b in packing._pack_texts(path, 1, 64, True)(batches))
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([len(tokens._loaded)])], names=["rows", "tables"])

    docs = spark.createDataFrame([(1, "some words to pack"), (2, None)], "doc_id long, text string").coalesce(1)
    assert docs.mapInArrow(left, "rows long, tables long").collect() == [(2, 0)]
