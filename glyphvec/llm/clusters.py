"""Centroid clustering with a LAESA pivot table.

Vectors are whole numbers. Their distances to a few fixed pivots are stored beside them once, in the
written table that every round reads. A round knows how far each centroid is from each pivot; by the
triangle inequality the largest difference of the two distances to a pivot bounds the distance to the
centroid from below. A vector first meets the centroid of least bound; only centroids whose bound does
not exceed that distance get their exact whole-number distance.

A round is one scan without a shuffle of vectors: tasks add up their own vectors by cluster, one small
shuffle adds the tasks' sums, and the driver gets one row per centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm.common import table
from glyphvec.session import materialise

SCALE, DIM = 64, 64
CLUSTERS, ROUNDS = 16, 3
#: Pivots are picked far apart from each other among the vectors of smallest hash.
PIVOTS, PIVOT_SAMPLE = 16, 512
#: Whole-number components are held to this size either way: a squared distance of 64 of them fits 64 bits.
LARGEST = 1 << 27
#: Largest component times the root of the length; below it, squared distances are exact in doubles.
EXACT = 1 << 24
ROWS = 4096
LARGEST_LONG = (1 << 63) - 1


def whole_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dim: int = DIM, scale: int = SCALE
) -> DataFrame:
    """(vec_id, parts): vectors with exactly ``dim`` finite components x, each as floor(scale * x).

    Vectors that are null, of another length, or hold null or non-finite components are left out. Rows
    with a null id and rows that repeat an id stay, each by itself. Components beyond 2^27 either way
    are held there. Other columns are dropped.
    """
    value = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))

    def whole(x):
        return F.floor(F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")

    kept = vectors.filter((F.size(value) == dim) & finite)
    return kept.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.transform(value, whole).alias("parts"))


def _first_by_hash(points: DataFrame, salt: str, n: int) -> np.ndarray:
    """The ``n`` vectors with the smallest hash of ``salt:id``; of equal ids the smaller vector comes first."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = points.orderBy(key.asc_nulls_last(), "parts").select("parts").limit(n).collect()
    return np.array([r["parts"] for r in rows], np.int64).reshape(len(rows), len(rows[0]["parts"]) if rows else 0)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of ``a`` to each row of ``b``."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) * a.shape[1] ** 0.5 < EXACT:
        x, y = a.astype(float), b.astype(float)
        return ((x**2).sum(1)[:, None] + (y**2).sum(1)[None, :] - 2 * (x @ y.T)).astype(np.int64)
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


def far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows, each the farthest from those before it."""
    chosen, nearest = [0], squared(points, points[:1])[:, 0]
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


@dataclass
class Centroids:
    """Centroids with their distances to the pivots."""

    rows: np.ndarray
    to_pivots: np.ndarray

    @classmethod
    def at(cls, rows: np.ndarray, pivots: np.ndarray) -> Centroids:
        return cls(rows, np.sqrt(squared(rows, pivots)))

    def nearest(self, points: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid (ties: the smaller), squared distance, and distances computed."""
        bound = np.zeros((len(points), len(self.rows)))
        for p in range(to_pivots.shape[1]):
            mine, theirs = to_pivots[:, p, None], self.to_pivots[None, :, p]
            # Distances are rounded; the margin is far above what rounding can add.
            np.maximum(bound, np.abs(mine - theirs) - 1e-9 * (mine + theirs), out=bound)
        bound *= bound
        cluster = bound.argmin(axis=1)
        best = np.empty(len(points), np.int64)
        for c in np.unique(cluster):
            own = np.flatnonzero(cluster == c)
            best[own] = squared(points[own], self.rows[c : c + 1])[:, 0]
        first, computed = cluster.copy(), len(points)
        for c in range(len(self.rows)):
            rows = np.flatnonzero((bound[:, c] <= best) & (first != c))
            if not len(rows):
                continue
            computed += len(rows)
            found = squared(points[rows], self.rows[c : c + 1])[:, 0]
            closer = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
            best[rows[closer]], cluster[rows[closer]] = found[closer], c
        return cluster, best, computed


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some thousand rows at a time, with their vectors and pivot distances."""
    for start in range(0, batch.num_rows, ROWS):
        some = batch.slice(start, ROWS)
        yield some, _matrix(some.column("parts"), np.int64), _matrix(some.column("to_pivots"), float)


def pivot_table(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``points`` with ``to_pivots``, the distance to each pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                some = batch.slice(start, ROWS)
                found = np.sqrt(squared(_matrix(some.column("parts"), np.int64), pivots))
                offsets = np.arange(len(found) + 1, dtype=np.int32) * len(pivots)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*some.columns, lists], names=[*some.schema.names, "to_pivots"])

    return points.mapInArrow(run, "vec_id bigint, parts array<int>, to_pivots array<double>")


def assign(stored: DataFrame, centroids: Centroids) -> DataFrame:
    """(vec_id, cluster, distance, computed): nearest centroid, squared distance; ``computed`` is how many
    exact distances the row's portion took, told in its first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, points, to_pivots in _parts(batch):
                cluster, distance, computed = centroids.nearest(points, to_pivots)
                told = np.zeros(len(cluster), np.int64)
                told[:1] = computed
                columns = [some.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(told)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance", "computed"])

    return stored.mapInArrow(run, "vec_id bigint, cluster int, distance bigint, computed bigint")


def _moved(stored: DataFrame, centroids: Centroids) -> np.ndarray:
    """Centroids at the floored means of their vectors; empty ones stay."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(centroids.rows.shape, np.int64)
        count = np.zeros(len(total), np.int64)
        for batch in batches:
            for _, points, to_pivots in _parts(batch):
                cluster, _, _ = centroids.nearest(points, to_pivots)
                for c in np.unique(cluster):
                    total[c] += points[cluster == c].sum(axis=0)
                count += np.bincount(cluster, minlength=len(count))
        own = np.flatnonzero(count)
        dim = total.shape[1]
        names = ["cluster", "pos", "total", "n"]
        columns = [np.repeat(own, dim), np.tile(np.arange(dim), len(own)), total[own].ravel(), np.repeat(count[own], dim)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)

    parts = stored.mapInArrow(sums, "cluster bigint, pos bigint, total bigint, n bigint")
    exact = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("total", "n")]
    rows = centroids.rows.copy()
    # One row per centroid and component.
    for r in parts.groupBy("cluster", "pos").agg(*exact).collect():
        rows[r["cluster"], r["pos"]] = int(r["total"]) // int(r["n"])
    return rows


def cluster(points: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``assign`` after ``rounds`` rounds from the vectors of smallest hash, and the final centroids.

    ``points`` as ``whole_vectors`` returns them. With fewer vectors than clusters each vector starts
    one; equal vectors may start several, of which the smallest number then gets the rows. No vectors
    give no rows and no centroids. The result is the same for any pivots and any partitioning.
    """
    spark = points.sparkSession
    points = materialise(points, "points")
    starts = _first_by_hash(points, "1", clusters)
    if not len(starts):
        empty = "vec_id bigint, cluster int, distance bigint, computed bigint"
        return spark.createDataFrame([], empty), starts
    pivots = far_apart(_first_by_hash(points, "2", PIVOT_SAMPLE), PIVOTS)
    stored = materialise(pivot_table(points, pivots), "pivot-table")
    centroids = Centroids.at(starts, pivots)
    for _ in range(rounds):
        centroids = Centroids.at(_moved(stored, centroids), pivots)
    return assign(stored, centroids), centroids.rows


def described(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Rows of ``cluster`` with ``cluster_inertia``, ``inertia`` and the checksum of their centroid.

    Sums beyond 64 bits are held to 64 bits.
    """
    spark = found.sparkSession
    found = materialise(found.drop("computed"), "assigned")

    def fitting(total):
        return F.least(total, F.lit(LARGEST_LONG).cast("decimal(38,0)")).cast("bigint")

    # One row per centroid.
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("total")).collect()
    names = [hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest() for row in centroids]
    total = sum(r["total"] for r in sums)
    per_cluster = spark.createDataFrame(
        [(r["cluster"], r["total"], total, names[r["cluster"]]) for r in sums],
        "cluster int, own decimal(38,0), total decimal(38,0), centroid_sha256 string",
    )
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", fitting(F.col("own")).alias("cluster_inertia"),
        fitting(F.col("total")).alias("inertia"), "centroid_sha256",
    )


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every vector."""
    return described(*cluster(whole_vectors(table(spark, sf_dir, "embeddings"))))


def _sql() -> str:
    square = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), e) - 1 AS INTEGER) AS c, e FROM v
  QUALIFY c < {CLUSTERS}
)""",
    ]
    for k in range(ROUNDS + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (
  SELECT r, vec_id, v.e, c.c, CAST({square} AS BIGINT) AS d FROM v, c{k} c
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c.c) = 1
)"""
        )
        if k < ROUNDS:
            steps.append(
                f"""c{k + 1} AS MATERIALIZED (
  SELECT old.c, coalesce(new.e, old.e) AS e FROM c{k} old LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS e FROM (
      SELECT c, i, CAST(sum(e[i]) AS BIGINT) AS s, count(*) AS n FROM a{k}, range(1, {DIM} + 1) t(i) GROUP BY c, i
    ) GROUP BY c
  ) new USING (c)
)"""
            )
    final = f"a{ROUNDS}"
    return f"""WITH {", ".join(steps)}
SELECT vec_id, c AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(f.e, ',')) AS centroid_sha256
FROM {final} JOIN c{ROUNDS} f USING (c)"""


QUERIES = {"op11_centroid_clusters": op11_centroid_clusters}
SQL = {"op11_centroid_clusters": _sql()}
