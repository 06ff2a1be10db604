"""A materialized table kept as parquet versions made of segments.

A version is a list of segments, each a folder with the rows of one range of keys, sorted. A
full publication writes all of them; ``replace`` writes only those that hold changed keys
and takes the others over from the version before. Each publication ends with one row in a
manifest. A reader follows the manifest row with the highest sequence number, so it sees the
old version or the new one, whole, while a refresh runs. Nothing is overwritten.

Old versions go when ``expire`` is called. A reader that must not lose its version
meanwhile holds a lease on it.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buyerlens.session import delete_path, file_system

_SEGMENT = "__segment"
_SEGMENTS = T.ArrayType(T.StructType([
    T.StructField("folder", T.StringType()),
    T.StructField("low", T.StringType()),  # as JSON, as is high
    T.StructField("high", T.StringType()),
    T.StructField("row_count", T.LongType()),
]))
_MANIFEST = T.StructType([
    T.StructField("sequence", T.LongType()),
    T.StructField("published_at", T.TimestampNTZType()),
    T.StructField("schema", T.StringType()),
    T.StructField("segments", _SEGMENTS),
    T.StructField("notes", T.StringType()),
])
_REPEATED = "repeated key: "


class Conflict(RuntimeError):
    """Another version was published while this one was prepared from the one before."""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class VersionedTable:
    """A parquet table under ``root``, sorted by ``key`` for lookups."""

    spark: SparkSession
    root: str
    key: str

    @property
    def _manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def _leases(self) -> str:
        return f"{self.root}/leases"

    def publish(self, df: DataFrame, notes: object = None, segments: int | None = None) -> int:
        """Write a new version, make it the current one and return its sequence number.

        Rows are range-partitioned and sorted by key: the manifest's bounds, min/max statistics and a
        Bloom filter on the key let a lookup skip nearly all row groups. A version in which a key
        repeats is refused and removed. ``notes`` are kept with the version, as JSON. The number
        of segments is left to adaptive execution unless given.
        """
        ranged = df.repartitionByRange(segments, self.key) if segments else df.repartitionByRange(self.key)
        return self._commit(df.schema, self._write(ranged.withColumn(_SEGMENT, F.spark_partition_id())), notes)

    def replace(self, keys: DataFrame, rows: DataFrame, notes: object = None) -> int:
        """A new version in which ``rows`` take the place of all rows of ``keys``.

        ``keys`` has the key column; every key of ``rows`` has to be in it. Only segments that these
        keys fall in are written. Raises ``Conflict`` if another version became
        current meanwhile.
        """
        current = self._current()
        schema = T.StructType.fromJson(json.loads(current.schema))
        segments = sorted((s for s in current.segments), key=lambda s: json.loads(s.low)) if current.segments else []
        keys = keys.select(self.key).distinct()
        place = self._place([json.loads(s.low) for s in segments], schema[self.key].dataType)
        touched = sorted(r[0] for r in keys.select(place.alias("place")).distinct().collect())
        old = [segments[k] for k in touched if k < len(segments)]
        merged = self._read(old, schema).join(keys, self.key, "left_anti").unionByName(rows.select(*schema.names))
        ranged = merged.repartitionByRange(max(1, len(touched)), self.key).withColumn(_SEGMENT, place)
        written = self._write(ranged)
        if self._current().sequence != current.sequence:
            for folder in {s.folder.rsplit("/", 1)[0] for s in written}:
                delete_path(self.spark, folder)
            raise Conflict(f"version {current.sequence} of {self.root} is no longer the current one")
        kept = [s for k, s in enumerate(segments) if k not in touched]
        return self._commit(schema, kept + written, notes if notes is not None else json.loads(current.notes))

    def _place(self, lows: list, kind: T.DataType) -> Column:
        """The segment that a key falls in, given the least key of each."""
        if not lows:
            return F.lit(0)
        starts = F.array(*(F.lit(low).cast(kind) for low in lows))
        return F.greatest(F.lit(0), F.size(F.filter(starts, lambda low: low <= F.col(self.key))) - 1)

    def _write(self, ranged: DataFrame) -> list[Row]:
        """Write rows that are range-partitioned by key, and list their segments.

        Ranges share no keys, so a repeated key shows among the rows of one task, without another shuffle.
        """
        folder = f"{self.root}/version-{_now():%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        number = F.row_number().over(Window.partitionBy(self.key).orderBy(self.key))
        stop = F.raise_error(F.concat(F.lit(_REPEATED), F.coalesce(F.col(self.key).cast("string"), F.lit("NULL"))))
        kind = ranged.schema[self.key].dataType
        checked = ranged.withColumn(self.key, F.when(number == 1, F.col(self.key)).otherwise(stop.cast(kind)))
        try:
            (
                checked.sortWithinPartitions(_SEGMENT, self.key)
                .write.partitionBy(_SEGMENT)
                .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
                .parquet(folder)
            )
        except Exception as failed:
            delete_path(self.spark, folder)
            if _REPEATED in str(failed):
                value = str(failed).split(_REPEATED, 1)[1].splitlines()[0].split(" SQLSTATE")[0].rstrip(". ")
                raise ValueError(f"{self.key} {value!r} has several rows") from failed
            raise
        schema = T.StructType([f for f in ranged.schema if f.name != _SEGMENT])
        back = self.spark.read.schema(schema.add(_SEGMENT, T.IntegerType())).parquet(folder)
        bounds = back.groupBy(_SEGMENT).agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count("*").alias("n"))
        return [
            Row(folder=f"{folder}/{_SEGMENT}={r[_SEGMENT]}", low=json.dumps(r["low"]), high=json.dumps(r["high"]), row_count=r["n"])
            for r in bounds.orderBy(_SEGMENT).collect()
        ]

    def _commit(self, schema: T.StructType, segments: list[Row], notes: object) -> int:
        versions = self._versions()
        sequence = versions[0].sequence + 1 if versions else 1
        plain = [(s.folder, s.low, s.high, s.row_count) for s in segments]
        entry = self.spark.createDataFrame([(sequence, _now(), schema.json(), plain, json.dumps(notes))], _MANIFEST)
        entry.coalesce(1).write.mode("append").parquet(self._manifest)
        return sequence

    def _versions(self) -> list[Row]:
        """All versions, the current one first; of two with one number, the one that ended last."""
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(self._manifest).select("*", "_metadata.file_path").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(rows, key=lambda r: (r.sequence, r.published_at, r.file_path), reverse=True)

    def _current(self) -> Row:
        versions = self._versions()
        if not versions:  # or a first publication that did not end
            raise LookupError(f"nothing published under {self.root}")
        return versions[0]

    def _read(self, segments: list[Row], schema: T.StructType) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(s.folder for s in segments))

    def segments(self) -> list[Row]:
        """Folder, bounds and number of rows of each segment of the current version."""
        return list(self._current().segments)

    def notes(self) -> object:
        return json.loads(self._current().notes)

    def read(self) -> DataFrame:
        """The current version. The manifest keeps its schema, so no file is opened to find it."""
        current = self._current()
        return self._read(current.segments, T.StructType.fromJson(json.loads(current.schema)))

    def lookup(self, value: object) -> DataFrame:
        """The row of one key, looked for in the segment that can hold it."""
        current = self._current()
        own = [s for s in current.segments if _within(json.loads(s.low), value, json.loads(s.high))]
        rows = self._read(own, T.StructType.fromJson(json.loads(current.schema)))
        return rows.where(F.col(self.key) == F.lit(value))

    @contextmanager
    def lease(self, seconds: int = 3600) -> Iterator[DataFrame]:
        """Read a version that ``expire`` leaves alone until the block ends or the time is over."""
        current = self._current()
        name = f"{self._leases}/{current.sequence}_{int(time.time()) + seconds}_{uuid.uuid4().hex}"
        files, path = file_system(self.spark, name)
        files.mkdirs(path)
        try:
            yield self._read(current.segments, T.StructType.fromJson(json.loads(current.schema)))
        finally:
            files.delete(path, True)

    def _leased(self) -> set[int]:
        files, path = file_system(self.spark, self._leases)
        if not files.exists(path):
            return set()
        names = [s.getPath().getName().split("_") for s in files.listStatus(path)]
        return {int(sequence) for sequence, until, _ in names if int(until) > time.time()}

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all versions but the newest ``keep`` and those under a lease; returns their numbers.

        Manifest rows go first, so no reader finds a version that is being removed. Segments
        that a kept version shares stay.
        """
        versions, leased = self._versions(), self._leased()
        kept = [v for k, v in enumerate(versions) if k < max(1, keep) or v.sequence in leased]
        gone = [v for v in versions if v not in kept]
        needed = {s.folder for v in kept for s in v.segments}
        for v in gone:
            delete_path(self.spark, v.file_path)
        for folder in {s.folder for v in gone for s in v.segments} - needed:
            delete_path(self.spark, folder)
        return sorted(v.sequence for v in gone)


def _within(low: object, value: object, high: object) -> bool:
    """Whether a key can lie between two bounds; of another type it can."""
    try:
        return low is None or low <= value <= high
    except TypeError:
        return True
