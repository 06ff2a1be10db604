"""Bounded-space online packing of token ids into sequences.

Each task keeps at most ``OPEN`` open windows. A document's ids fill windows of their
own while they can; the rest goes to the open window it fits best. Where none fits,
the fullest is topped up with the first part of the rest and emitted full. What is left
open at the end of a task is merged: the windows of ``FAN_IN`` tasks are packed again the same
way, level by level, until one task is left, which cuts its last ids into sequences whose
lengths are powers of two. So no sequence needs padding, whatever the input.

The merge handles ``OPEN`` windows per task, not documents: its last level holds at
most ``FAN_IN * OPEN`` windows. Each level is written to the shared folder before it is
read, so a lost executor cannot change ids that were already used.

Defined results: null and blank texts are the end id alone; rows are packed one by one,
so repeated rows, repeated ids and null ids are documents of their own; other columns
are ignored. Texts of any length are taken whole. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.shared import shuffle_partitions, table, written
from buyerlens.llm.tokens import forget, tokenizer
from buyerlens.llm.words import release_memory

OPEN = 16
FAN_IN = 64
TOKENIZER = "word_bpe_49k.json"

PIECES = (
    "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " task long, open int"
)
_NAMES = [x.split()[0] for x in PIECES.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.int32()]


class _Window:
    __slots__ = ("pieces", "used")

    def __init__(self):
        self.pieces, self.used = [], 0


class Packer:
    """Packs pieces (doc_id, start, ids, doc_tokens) of one task."""

    def __init__(self, size: int, level: int, task: int, with_ids: bool, open_windows: int = OPEN):
        self._size, self._most, self._with_ids = size, open_windows, with_ids
        self._task, self._next = task, (level << 56) | (task << 32)
        self._open: list[_Window] = []
        self.rows: list[tuple] = []

    def add(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        size = self._size
        at = 0
        while len(ids) - at >= size:
            self._emit([(doc_id, start + at, ids[at: at + size], doc_tokens)])
            at += size
        while at < len(ids):
            rest = len(ids) - at
            best = min((w for w in self._open if size - w.used >= rest), key=lambda w: size - w.used, default=None)
            if best is None and len(self._open) < self._most:
                best = _Window()
                self._open.append(best)
            if best is None:
                best = max(self._open, key=lambda w: w.used)
            take = min(rest, size - best.used)
            best.pieces.append((doc_id, start + at, ids[at: at + take], doc_tokens))
            best.used += take
            at += take
            if best.used == size:
                self._open.remove(best)
                self._emit(best.pieces)

    def _emit(self, pieces, left: int = 0) -> None:
        """Write a sequence; ``left`` marks one that is still open, from 1."""
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            raw = ids.astype("<u4").tobytes()
            self.rows.append((
                doc_id, start, len(ids), raw if self._with_ids or left else None, zlib.crc32(raw), doc_tokens, self._next, offset,
                self._task, left,
            ))
            offset += len(ids)
        self._next += 1

    def leave_open(self) -> None:
        for k, window in enumerate(self._open):
            self._emit(window.pieces, k + 1)
        self._open = []

    def finish(self) -> None:
        """Cut what is open into sequences of powers of two."""
        rest = [p for w in self._open for p in w.pieces]
        total = sum(len(p[2]) for p in rest)
        self._open = []
        power = 1 << (self._size.bit_length() - 1)
        while total:
            while power > total:
                power //= 2
            got, space = [], power
            while space:
                doc_id, start, ids, doc_tokens = rest.pop(0)
                got.append((doc_id, start, ids[:space], doc_tokens))
                if len(ids) > space:
                    rest.insert(0, (doc_id, start + space, ids[space:], doc_tokens))
                space -= len(got[-1][2])
            self._emit(got)
            total -= power

    def batches(self, least: int):
        if len(self.rows) >= least and self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*self.rows), _KINDS)], names=_NAMES)
            self.rows = []


def _pack_texts(path: str, end_id: int, size: int, with_ids: bool):
    def run(batches):
        release_memory()
        packer = Packer(size, 0, TaskContext.get().partitionId(), with_ids)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, bounds, found in tokenizer(path).encode(batch.column(1)):
                for row in range(len(bounds) - 1):
                    own = np.append(found[bounds[row]: bounds[row + 1]], np.uint32(end_id))
                    packer.add(ids[first + row], 0, own, len(own))
                yield from packer.batches(2000)
        packer.leave_open()
        yield from packer.batches(1)
        forget()
        release_memory()

    return run


def _merge(level: int, size: int, with_ids: bool, last: bool):
    def run(batches):
        packer, task = None, None
        for batch in batches:
            for group, doc_id, start, ids, doc_tokens in zip(*(batch.column(c).to_pylist() for c in (
                    "group", "doc_id", "start", "ids", "doc_tokens"))):
                if group != task:
                    if packer is not None:
                        packer.leave_open()
                        yield from packer.batches(1)
                    packer, task = Packer(size, level, group, with_ids), group
                packer.add(doc_id, start, np.frombuffer(ids, dtype="<u4"), doc_tokens)
                yield from packer.batches(2000)
        if packer is not None:
            if last:
                packer.finish()
            else:
                packer.leave_open()
            yield from packer.batches(1)

    return run


def pack(docs: DataFrame, size: int = 2048, end_id: int = 1, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset.

    ``ids`` holds little-endian unsigned 32-bit ids; without ``with_ids`` it is null
    where the sequence was full at once, which spares writing them.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = written(texts.mapInArrow(_pack_texts(path, end_id, size, with_ids), PIECES), "pieces")
    done, left, level = [pieces.where("open = 0")], pieces.where("open > 0"), 0
    while True:
        level += 1
        tasks = left.agg(F.max("task")).first()[0]
        if tasks is None:
            break
        last = tasks < FAN_IN
        groups = min(tasks // FAN_IN + 1, shuffle_partitions(docs.sparkSession))
        left = left.withColumn("group", F.floor(F.col("task") / FAN_IN).cast("long"))
        left = left.repartition(groups, "group").sortWithinPartitions("group", "task", "open", "offset")
        merged = written(left.mapInArrow(_merge(level, size, with_ids, last), PIECES), "merged")
        done.append(merged.where("open = 0"))
        if last:
            break
        left = merged.where("open > 0")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("task", "open")


def op3_packing(spark, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), with_ids=False).drop("ids")
