"""Centroid clustering in whole numbers, with an n-simplex projection as filter.

A few pivots, taken from a bounded sample of the vectors, form a simplex. The distances of a
vector to all pivots are computed once; they fix the vector as the apex of a simplex over
that base, and its apex coordinates are kept in a written table beside the vector. In each round
the centroids get apex coordinates too. For two points the Euclidean distance of their apexes is
never more than their true distance, and with the sign of the last coordinate turned never
less. So a centroid whose lower bound exceeds the least upper bound of a vector cannot be
its nearest; the few that remain are compared by exact whole-number squared distances.
The bounds get a slack for rounding, so pivots decide about speed only, never about results.

A round is one scan of the table: tasks sum their vectors by cluster in numpy, Spark adds the
sums as decimals, and only ``k`` centroids reach the driver. Vectors are never shuffled, so
neither a crowded cluster nor a vector that is repeated very often is a burden.

Defined results: a vector is used if it has exactly ``size`` components, all of them
present and finite, and none reaches 2^27 once multiplied by ``scale`` (beyond, a squared
distance no longer fits a long). Others, null ones included, are left out. Rows that repeat
are vectors of their own. Rows without an id are clustered but never become a first
centroid; of equal ids the vector that comes first component by component is taken. With fewer
vectors than ``k`` there are as many centroids as vectors with an id; without any, or with an empty
table, there are no rows. Ties go to the smaller number. Sums beyond a long are null. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.llm.shared import table, written

CLUSTERS, ROUNDS, SIZE, SCALE = 16, 3, 64, 64
PIVOTS = 12
PIVOT_SAMPLE = 256
MOST = 1 << 27
_SLACK = 1e-6
_BIAS = 1 << 31
_CHUNK = 1 << 14  # vectors worked on at once

POINTS = "vec_id long, point binary, apex binary"
SUMS = "cluster int, place int, n long, total long"
ASSIGNED = "vec_id long, cluster int, distance long"


def whole_numbers(column: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be used, and floor(scale * x) of their components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    rows = np.flatnonzero(lengths == size)
    flat = column.take(pa.array(rows)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * scale)
        good = (np.abs(scaled) < MOST).all(axis=1) & np.isfinite(values).all(axis=1)
    return rows[good], scaled[good].astype(np.int32)


class Simplex:
    """Apex coordinates of points over a base of pivots."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots.astype(np.float64)
        base = self.pivots[1:] - self.pivots[0]
        # The base in its own coordinates: lower triangular, the first pivot being the origin.
        self.base = np.linalg.cholesky(base @ base.T) if len(base) else np.zeros((0, 0))

    @property
    def n(self) -> int:
        return len(self.pivots)

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distances of points to the pivots."""
        out = np.empty((len(points), self.n))
        for k, pivot in enumerate(self.pivots):
            out[:, k] = ((points - pivot) ** 2).sum(axis=1)
        return out

    def apex(self, squared: np.ndarray) -> np.ndarray:
        """Apex coordinates from squared distances to the pivots: n - 1 within the base, then the height."""
        out = np.zeros((len(squared), self.n))
        if self.n > 1:
            reach = (self.base ** 2).sum(axis=1)
            out[:, :-1] = np.linalg.solve(self.base, ((squared[:, :1] - squared[:, 1:] + reach) / 2).T).T
        out[:, -1] = np.sqrt(np.maximum(squared[:, 0] - (out[:, :-1] ** 2).sum(axis=1), 0))
        return out


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` points of the sample, each the farthest from the span of those before it."""
    if not len(sample):
        return sample
    points = sample.astype(np.float64)
    chosen = [0]
    rest = points - points[0]
    widest = float((rest ** 2).sum(axis=1).max())
    for _ in range(min(n, len(points)) - 1):
        height = (rest ** 2).sum(axis=1)
        k = int(height.argmax())
        if height[k] <= 1e-3 * widest:  # nearly within the span: it would tell nothing and cost precision
            break
        chosen.append(k)
        axis = rest[k] / np.sqrt(height[k])
        rest = rest - np.outer(rest @ axis, axis)
    return sample[chosen]


def candidates(apex: np.ndarray, centroid_apex: np.ndarray) -> np.ndarray:
    """Which centroids can be the nearest one of each vector."""
    within = ((apex[:, None, :-1] - centroid_apex[None, :, :-1]) ** 2).sum(axis=2)
    low = within + (apex[:, None, -1] - centroid_apex[None, :, -1]) ** 2
    high = within + (apex[:, None, -1] + centroid_apex[None, :, -1]) ** 2
    least = high.min(axis=1, keepdims=True)
    return low <= least + _SLACK * (1 + least + (apex ** 2).sum(axis=1, keepdims=True))


def nearest(points: np.ndarray, apex: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector and the exact squared distance."""
    cluster = np.full(len(points), -1, dtype=np.int32)
    distance = np.full(len(points), np.iinfo(np.int64).max, dtype=np.int64)
    maybe = candidates(apex, simplex.apex(simplex.distances(centroids)))
    for k, centroid in enumerate(centroids):  # in order, so that ties stay with the smaller number
        rows = np.flatnonzero(maybe[:, k])
        found = ((points[rows].astype(np.int64) - centroid) ** 2).sum(axis=1)
        closer = found < distance[rows]
        distance[rows[closer]] = found[closer]
        cluster[rows[closer]] = k
    return cluster, distance


def pack_points(points: np.ndarray) -> list[bytes]:
    """Points as bytes that sort as their components do."""
    raw = (points.astype(np.int64) + _BIAS).astype(">u4").tobytes()
    width = 4 * points.shape[1]
    return [raw[k: k + width] for k in range(0, len(raw), width)]


def unpack_points(packed: list[bytes], size: int) -> np.ndarray:
    return (np.frombuffer(b"".join(packed), dtype=">u4").astype(np.int64) - _BIAS).reshape(-1, size)


def _chunks(batch: pa.RecordBatch, size: int, n: int):
    """(ids, points, apexes) of a batch of the written table."""
    for at in range(0, batch.num_rows, _CHUNK):
        own = batch.slice(at, _CHUNK)
        apex = np.frombuffer(b"".join(own.column(2).to_pylist()), dtype=np.float64).reshape(-1, n)
        yield own.column(0), unpack_points(own.column(1).to_pylist(), size), apex


def _kept(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """(vec_id, point) of the vectors that can be used."""
    def run(batches):
        for batch in batches:
            rows, points = whole_numbers(batch.column(1), size, scale)
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(pack_points(points), pa.binary())],
                    names=["vec_id", "point"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        run, "vec_id long, point binary")


def _first(kept: DataFrame, salt: str, n: int, size: int) -> np.ndarray:
    """The ``n`` vectors with the smallest hash of salt and id."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = kept.where("vec_id IS NOT NULL").select(key.alias("key"), "point").orderBy("key", "point").limit(n).collect()
    return unpack_points([bytes(r["point"]) for r in rows], size)


def projected(kept: DataFrame, simplex: Simplex, size: int) -> DataFrame:
    """The table of vectors with their apex coordinates, written once for all rounds."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                own = batch.slice(at, _CHUNK)
                points = unpack_points(own.column(1).to_pylist(), size)
                apex = simplex.apex(simplex.distances(points))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array([a.tobytes() for a in apex], pa.binary())],
                    names=["vec_id", "point", "apex"])

    return written(kept.mapInArrow(run, POINTS), "points")


def moved_centroids(points: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """Each centroid put to the floored mean of its vectors; those without any stay."""
    size = centroids.shape[1]

    def run(batches):
        totals = np.zeros(centroids.shape, dtype=np.int64)
        counts = np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            for _, own, apex in _chunks(batch, size, simplex.n):
                cluster, _ = nearest(own, apex, centroids, simplex)
                for k in np.unique(cluster):
                    rows = cluster == k
                    totals[k] += own[rows].sum(axis=0)
                    counts[k] += int(rows.sum())
        full = np.flatnonzero(counts)
        if len(full):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(full, size).astype(np.int32)), pa.array(np.tile(np.arange(size, dtype=np.int32), len(full))),
                pa.array(np.repeat(counts[full], size)), pa.array(totals[full].ravel()),
            ], names=["cluster", "place", "n", "total"])

    exact = F.sum(F.col("total").cast("decimal(38,0)"))
    out = centroids.copy()
    for r in points.mapInArrow(run, SUMS).groupBy("cluster", "place").agg(F.sum("n").alias("n"), exact.alias("total")).collect():
        out[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return out


def assignments(points: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    size = centroids.shape[1]

    def run(batches):
        for batch in batches:
            for ids, own, apex in _chunks(batch, size, simplex.n):
                cluster, distance = nearest(own, apex, centroids, simplex)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return points.mapInArrow(run, ASSIGNED)


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE,
            n_pivots: int = PIVOTS, pivot_sample: int = PIVOT_SAMPLE) -> tuple[DataFrame, np.ndarray]:
    """Assignments (vec_id, cluster, distance), and the final centroids."""
    spark = vectors.sparkSession
    kept = _kept(vectors, size, scale)
    centroids = _first(kept, "1:", k, size)
    if not len(centroids):
        return spark.createDataFrame([], ASSIGNED), centroids
    simplex = Simplex(choose_pivots(_first(kept, "pivot:", pivot_sample, size), n_pivots))
    points = projected(kept, simplex, size)
    for _ in range(rounds):
        centroids = moved_centroids(points, centroids, simplex)
    return written(assignments(points, centroids, simplex), "assigned"), centroids


def with_totals(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the inertia of the cluster and of all, and a digest of the cluster's centroid."""
    spark: SparkSession = assigned.sparkSession
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(exact.alias("s")).collect()}
    whole = sum(sums.values())
    long = lambda x: x if x < 1 << 63 else None
    facts = [(n, long(s), long(whole), digests[n]) for n, s in sorted(sums.items())]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return with_totals(*cluster(table(spark, folder, "embeddings")))


def _sql() -> str:
    """The rounds as nested tables: ``c0`` the first centroids, ``cN`` those after N rounds."""
    steps = [f"""v AS (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id,
               list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS p
        FROM embeddings
        WHERE len(embedding) = {SIZE} AND list_count(embedding) = {SIZE}
          AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
    )""", f"""c0 AS (
        SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), p) - 1 AS cluster, p FROM v WHERE vec_id IS NOT NULL
        ORDER BY sha256('1:' || vec_id), p LIMIT {CLUSTERS}
    )"""]
    squared = "list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for n in range(ROUNDS + 1):
        steps.append(f"""a{n} AS (
        SELECT row, vec_id, p, CAST(d AS BIGINT) AS distance, cluster FROM (
            SELECT v.row, v.vec_id, v.p, c.cluster, {squared} AS d FROM v, c{n} AS c
        ) QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, cluster) = 1
    )""")
        if n < ROUNDS:
            steps.append(f"""c{n + 1} AS (
        SELECT c.cluster, coalesce(m.p, c.p) AS p FROM c{n} AS c LEFT JOIN (
            SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS p FROM (
                SELECT cluster, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
                    SELECT cluster, unnest(p) AS x, unnest(range({SIZE})) AS place FROM a{n}
                ) GROUP BY cluster, place
            ) GROUP BY cluster
        ) AS m USING (cluster)
    )""")
    return "WITH " + ", ".join(steps) + f"""
    SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, distance,
           CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c.p, ',')) AS centroid_sha256
    FROM a{ROUNDS} AS a JOIN c{ROUNDS} AS c USING (cluster)"""


OP11_SQL = _sql()
