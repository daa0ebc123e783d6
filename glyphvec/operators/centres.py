"""Two levels of cluster centres, for more clusters than one broadcast can hold.

The upper centres are broadcast. Below each of them stand leaves, a table by upper centre that is never
broadcast whole: rows go to their upper centre without a shuffle, then meet its leaves in a cogroup, in
parts of bounded size. The clusters of the index are the leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphvec.operators.topk import row_blocks, to_matrix, unit_rows
from glyphvec.session import materialise

#: Sampled rows for each leaf, rounds that move the leaves, and rows that meet the leaves of a centre at once.
LEAF_SAMPLE, LEAF_ROUNDS = 32, 8
ROUTE_ROWS = 100_000
#: Upper centres whose leaves a query looks at, at least.
UPPER_PROBES = 4


def distances(rows: np.ndarray, centres: np.ndarray, metric: str) -> np.ndarray:
    """Squared distance without the row's own square, for each row and centre."""
    wide = unit_rows(rows) if metric == "cosine" else rows.astype(np.float64)
    return (centres**2).sum(axis=1) - 2.0 * (wide @ centres.T)


def nearness(rows: np.ndarray, centres: np.ndarray, metric: str) -> np.ndarray:
    """Smaller is nearer, for each query and centre."""
    return -(rows @ centres.T) if metric == "ip" else distances(rows, centres, metric)


def nearest(rows: np.ndarray, centres: np.ndarray, metric: str) -> np.ndarray:
    """Number of the nearest centre of each row."""
    found = np.empty(len(rows), np.int32)
    starts = row_blocks(len(rows), len(centres))
    for lo in starts:
        some = slice(lo, lo + starts.step)
        found[some] = distances(rows[some], centres, metric).argmin(axis=1)
    return found


def to_wide(column: pa.Array, dim: int) -> np.ndarray:
    """A list column of doubles as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def grow_leaves(placed: DataFrame, upper: np.ndarray, sizes: dict[int, int], nlist: int, metric: str, seed: int) -> DataFrame:
    """(top, cluster_id, centroid): about ``nlist`` leaves, as many below a centre as its share of the rows.

    ``placed`` has (index_id, embedding, top). Leaves are the centres of a hash sample of some thirty
    rows for each of them; below one centre there are no more than the upper centres that fit a
    broadcast, so a task is bounded. A centre without a sampled row is its own leaf.
    """
    dim, rows = upper.shape[1], sum(sizes.values())
    most = max(len(upper), math.ceil(math.sqrt(nlist)))
    spark = placed.sparkSession
    plan = [(t, max(1, min(most, round(nlist * n / rows))), n) for t, n in sizes.items()]
    shares = [(t, leaves, min(1.0, leaves * LEAF_SAMPLE / n)) for t, leaves, n in plan]
    # One row for each upper centre.
    wanted = F.broadcast(spark.createDataFrame(shares, "top INT, leaves INT, share DOUBLE"))
    drawn = placed.join(wanted, "top").filter(
        F.pmod(F.xxhash64("index_id", F.lit(seed + 1)), F.lit(1 << 32)) < F.col("share") * float(1 << 32)
    )
    stride = most

    def train(group: pa.Table) -> pa.Table:
        top, leaves = group["top"][0].as_py(), group["leaves"][0].as_py()
        sample = group.sort_by("index_id")
        raw = to_matrix(sample["embedding"], dim)
        points = unit_rows(raw) if metric == "cosine" else raw.astype(np.float64)
        order = np.random.default_rng(seed + top).permutation(len(points))
        centres = points[order[:leaves]]
        for _ in range(LEAF_ROUNDS):
            home = nearest(points, centres, "l2")
            total = np.zeros_like(centres)
            np.add.at(total, home, points)
            count = np.bincount(home, minlength=len(centres))[:, None]
            centres = np.where(count > 0, total / np.maximum(count, 1), centres)
        names = np.arange(len(centres), dtype=np.int32) + np.int32(top * stride)
        offsets = np.arange(len(centres) + 1, dtype=np.int32) * dim
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(centres.ravel()))
        return pa.table({"top": pa.array(np.full(len(centres), top, np.int32)), "cluster_id": pa.array(names), "centroid": lists})

    schema = "top INT, cluster_id INT, centroid ARRAY<DOUBLE>"
    grown = drawn.select("top", "leaves", "index_id", "embedding").groupBy("top").applyInArrow(train, schema)
    grown = materialise(grown, "leaves")
    own = [(t, t * stride, upper[t].tolist()) for t in sizes]
    bare = spark.createDataFrame(own, schema).join(grown, "top", "left_anti")
    return grown.unionByName(bare)


def _in_parts(rows: DataFrame, leaves: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``salt``: rows of a centre in parts of bounded size, its leaves once for each."""
    parts = rows.groupBy("top").agg(F.ceil(F.count("*") / ROUTE_ROWS).alias("parts"))
    # One row for each upper centre.
    parts = F.broadcast(parts)
    salted = rows.join(parts, "top").withColumn("salt", F.pmod(F.xxhash64(key), F.col("parts"))).drop("parts")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    # Names of their own: both sides may stem from one table.
    below = [F.col("top").alias("of_top"), *[F.col(c).alias(c) for c in leaves.columns if c != "top"]]
    return salted, leaves.join(parts, "top").select(*below, every.alias("of_salt"))


def to_leaves(placed: DataFrame, leaves: DataFrame, dim: int, metric: str) -> DataFrame:
    """(index_id, embedding, top, cluster_id) of ``placed(index_id, embedding, top)``."""

    def run(rows: pa.Table, below: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return out.empty_table()
        home = nearest(to_matrix(rows["embedding"], dim), to_wide(below["centroid"], dim), metric)
        columns = [rows["index_id"], rows["embedding"], rows["top"], below["cluster_id"].take(pa.array(home))]
        return pa.Table.from_arrays(columns, names=out.names)

    out = pa.schema(
        [("index_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("top", pa.int32()), ("cluster_id", pa.int32())]
    )
    left, right = _in_parts(placed.select("index_id", "embedding", "top"), leaves, "index_id")
    schema = "index_id BIGINT, embedding ARRAY<FLOAT>, top INT, cluster_id INT"
    return left.groupBy("top", "salt").cogroup(right.groupBy("of_top", "of_salt")).applyInArrow(run, schema)


def probe_leaves(
    asked: DataFrame, upper: np.ndarray, sizes: np.ndarray, leaves: DataFrame, metric: str, nprobe: int, want: int
) -> DataFrame:
    """``asked`` with ``clusters``, the leaves to read for each query: the ``nprobe`` nearest below its
    nearest upper centres, and further ones while those hold fewer than ``want`` rows.

    A query looks below as many upper centres as it reads leaves, at least four, and below more where
    those hold too few rows. ``leaves`` has (top, cluster_id, centroid, n_rows).
    """
    dim = upper.shape[1]
    shared = asked.sparkSession.sparkContext.broadcast((upper, sizes))
    first = max(UPPER_PROBES, nprobe)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, counts = shared.value
        for batch in batches:
            rows = to_matrix(batch.column("embedding"), dim)
            tops = [np.empty(0, np.int32)]
            starts = row_blocks(len(rows), len(centres))
            for lo in starts:
                order = nearness(rows[lo : lo + starts.step], centres, metric).argsort(axis=1, kind="stable")
                enough = (counts[order].cumsum(axis=1) < want).sum(axis=1) + 1
                tops += [o[: max(first, e)].astype(np.int32) for o, e in zip(order, enough)]
            offsets = np.cumsum([len(t) for t in tops], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(tops)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "tops"])

    kept = asked.withColumn("_row", F.monotonically_increasing_id())
    schema = T.StructType([*kept.schema.fields, T.StructField("tops", T.ArrayType(T.IntegerType()))])
    looked = materialise(kept.mapInArrow(look, schema), "upper-probes")

    def best(rows: pa.Table, below: pa.Table) -> pa.Table:
        if not rows.num_rows or not below.num_rows:
            return out.empty_table()
        below = below.sort_by("cluster_id")
        centres, held = to_wide(below["centroid"], dim), below["n_rows"].to_numpy()
        vectors, picked, far, owner = to_matrix(rows["embedding"], dim), [], [], []
        starts = row_blocks(len(vectors), len(centres))
        for lo in starts:
            near = nearness(vectors[lo : lo + starts.step], centres, metric)
            order = near.argsort(axis=1, kind="stable")
            enough = (held[order].cumsum(axis=1) < want).sum(axis=1) + 1
            for i, (o, e) in enumerate(zip(order, enough)):
                some = o[: max(nprobe, e)]
                picked.append(some)
                far.append(near[i, some])
                owner.append(np.full(len(some), lo + i))
        chosen = pa.array(np.concatenate(picked))
        columns = [
            rows["_row"].take(pa.array(np.concatenate(owner))),
            below["cluster_id"].take(chosen),
            pa.array(np.concatenate(far)),
            below["n_rows"].take(chosen),
        ]
        return pa.Table.from_arrays(columns, names=out.names)

    out = pa.schema([("_row", pa.int64()), ("cluster_id", pa.int32()), ("far", pa.float64()), ("n_rows", pa.int64())])
    left = looked.select("_row", "embedding", F.explode("tops").alias("top"))
    left, right = _in_parts(left, leaves, "_row")
    found = left.groupBy("top", "salt").cogroup(right.groupBy("of_top", "of_salt")).applyInArrow(
        best, "_row BIGINT, cluster_id INT, far DOUBLE, n_rows BIGINT"
    )
    order = Window.partitionBy("_row").orderBy("far", "cluster_id")
    before = F.sum("n_rows").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranked = found.select("*", F.row_number().over(order).alias("n"), F.coalesce(before, F.lit(0)).alias("before"))
    clusters = (
        ranked.filter((F.col("n") <= nprobe) | (F.col("before") < want))
        .groupBy("_row")
        .agg(F.collect_list("cluster_id").alias("clusters"))
    )
    return looked.join(clusters, "_row").select(*asked.columns, "clusters")
