"""What the operators share: written intermediates, partition counts, bounded collects, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.session import scratch_path

BROADCAST_ROWS = 200_000  # of a few numbers each; a longer side is joined by shuffling
PARTS_PER_TASK = 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as parquet in the shared folder: lineage ends here, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts(spark: SparkSession) -> int:
    """Pieces into which packed rows are dealt. More pieces need less memory each and name each document more often."""
    return PARTS_PER_TASK * shuffle_partitions(spark)


def dealt(packed: DataFrame) -> DataFrame:
    """Packed rows brought together by ``part``, each part in one run of rows of one task.

    Parts go to tasks by number, so that no task gets several parts by chance.
    """
    return packed.repartitionById(shuffle_partitions(packed.sparkSession), "part").sortWithinPartitions("part")


def short_side(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``BROADCAST_ROWS`` rows; the join shuffles otherwise."""
    if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def sum_of_blocks(blocks: DataFrame, size: int, block_size: int) -> np.ndarray:
    """Sum the count arrays that tasks have made of a table of fixed ``size``.

    ``blocks`` has (block int, counts binary as of ``planes``). Each block is summed in a
    stream, so memory and what reaches the driver are bounded by ``size``.
    """
    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = from_planes(counts.as_py(), 8)
                sums[block] = sums[block] + found if block in sums else found
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([planes(x, 8) for x in sums.values()], pa.binary())],
            names=["block", "counts"],
        )

    total = np.zeros(size, dtype=np.int64)
    spread = min(size // block_size, shuffle_partitions(blocks.sparkSession))
    for row in blocks.repartition(spread, "block").mapInArrow(add, "block int, counts binary").collect():
        total[row.block * block_size: (row.block + 1) * block_size] += from_planes(row.counts, 8)
    return total


def block_rows(counts: np.ndarray, block_size: int):
    """A task's counts as (block, bytes); blocks without counts are left out."""
    for block in range(len(counts) // block_size):
        own = counts[block * block_size: (block + 1) * block_size]
        if own.any():
            yield block, planes(own, 8)


def planes(values: np.ndarray, n_bytes: int) -> bytes:
    """The low ``n_bytes`` of whole numbers, all first bytes before all second ones: even bytes compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n_bytes].T).tobytes()


def from_planes(raw: bytes, n_bytes: int) -> np.ndarray:
    """The numbers that ``planes`` has packed, as int64; those of fewer than eight bytes are not negative."""
    found = np.frombuffer(raw, dtype=np.uint8).reshape(n_bytes, -1)
    out = np.zeros((found.shape[1], 8), dtype=np.uint8)
    out[:, :n_bytes] = found.T
    return out.view("<i8").reshape(-1)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (a long, b long): one row (node, component) per node, component its smallest.

    Alternates two steps until nothing changes: every node's larger neighbours
    are tied to its smallest neighbour, then its smaller ones. Both are minima
    that combine before the shuffle, so a hub with very many links is no burden;
    the number of rounds grows with the logarithm of the longest path. Each
    round is written to the shared folder. Nothing is collected but two numbers
    per round.
    """
    def minima(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    def both(edges: DataFrame) -> DataFrame:
        return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))

    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    seen = None
    for _ in range(rounds):
        around = both(edges)
        large = around.join(minima(around), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = large.join(minima(large), "u")
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = written(small.where("u <> v").distinct(), "links")
        now = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if seen == now:
            return edges.groupBy("u").agg(F.min("v").alias("v")).select(
                F.col("u").alias("node"), F.col("v").alias("component")
            ).union(edges.select("v", "v").distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
