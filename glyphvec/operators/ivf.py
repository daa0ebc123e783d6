"""Clustered vector index: build and query.

The index is a set of Parquet tables below one folder: ``vectors`` partitioned by ``cluster_id``,
``centroids`` with the size of each cluster, ``metadata`` by ordinal, and a one-row manifest. A query
reads only the clusters nearest to it; probing all clusters gives the exact answer.

Up to the bound of a broadcast the centres are one table. More clusters stand in two levels (``centres``),
and ``vectors`` is then partitioned by the upper centre and sorted by cluster within its files.
"""

from __future__ import annotations

import math
import time
import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphvec.functions.vectors import check_metric, l2_normalize
from glyphvec.operators.centres import grow_leaves, nearest, nearness, probe_leaves, to_leaves, to_wide
from glyphvec.operators.knn import (
    BROADCAST_BYTES,
    QuerySet,
    best_per_query,
    collect_queries,
    knn_join,
    query_bytes,
    result_schema,
    scan_join,
    standard_queries,
)
from glyphvec.operators.tiles import meet_in_tiles
from glyphvec.operators.topk import row_blocks, to_matrix
from glyphvec.session import materialise, passing_tables
from glyphvec.sinks.tables import OUTPUT_ROOT, index_path, write_manifest
from glyphvec.sources.vectors import read_manifest, read_vectors, vector_dim

MAX_CLUSTERS = 16_384
CENTROID_BYTES = 64 * 1024 * 1024
RECALL_TARGET = 0.95
#: Tiles for each core at least, and slices of clusters in a part.
TILES_PER_CORE, SLICES_PER_PART = 2, 4
CALIBRATION_QUERIES, CALIBRATION_K = 200, 10


def default_nlist(rows: int, dim: int) -> int:
    """About the square root of the row count; the centroid table always stays broadcastable."""
    return max(1, min(round(math.sqrt(rows)), max_nlist(dim)))


def max_nlist(dim: int) -> int:
    return max(1, min(MAX_CLUSTERS, CENTROID_BYTES // (dim * 8)))


def _train(
    vectors: DataFrame, rows: int, nlist: int, metric: str, seed: int, train_rows: int | None
) -> np.ndarray:
    """Cluster centres of all rows, or of a hash sample of about ``train_rows`` (every row is still
    assigned and indexed)."""
    if train_rows and rows > train_rows:
        share = int(train_rows / rows * 2**32)
        vectors = vectors.filter(F.expr(f"pmod(xxhash64(index_id, {seed}), {2**32})") < share)
    if nlist == 1:
        return np.zeros((1, vector_dim(vectors)))
    vector = F.col("embedding").cast("array<double>")
    if metric == "cosine":
        vector = l2_normalize(vector)
    points = vectors.select(array_to_vector(vector).alias("features"))
    # Random seeding: the parallel k-means++ seeding ends in a driver-side step that grows with nlist.
    model = KMeans(k=nlist, seed=seed, maxIter=10, initMode="random").fit(points)
    return np.array(model.clusterCenters())


def assign_clusters(vectors: DataFrame, centroids: np.ndarray, metric: str, name: str = "cluster_id") -> DataFrame:
    """The nearest centre for each (index_id, embedding), in column ``name``; no shuffle."""
    dim = centroids.shape[1]
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        for batch in batches:
            cluster = nearest(to_matrix(batch.column("embedding"), dim), shared.value, metric)
            yield pa.RecordBatch.from_arrays(
                [batch.column("index_id"), batch.column("embedding"), pa.array(cluster)],
                names=["index_id", "embedding", name],
            )

    return vectors.mapInArrow(run, f"index_id BIGINT, embedding ARRAY<FLOAT>, {name} INT")


def _write_flat(vectors: DataFrame, centroids: np.ndarray, metric: str, index_dir: str, mode: str) -> None:
    """One level: vectors by cluster, and the centre table with the size of each cluster."""
    spark = vectors.sparkSession
    assigned = assign_clusters(vectors, centroids, metric)
    (
        assigned.hint("rebalance", "cluster_id")
        .write.mode(mode)
        .partitionBy("cluster_id")
        .parquet(f"{index_dir}/vectors")
    )
    # One row per centre, of which there are at most max_nlist(dim).
    sizes = dict(spark.read.parquet(f"{index_dir}/vectors").groupBy("cluster_id").count().collect())
    centres = spark.createDataFrame(
        [(i, c.tolist(), sizes.get(i, 0)) for i, c in enumerate(centroids)],
        "cluster_id INT, centroid ARRAY<DOUBLE>, n_rows BIGINT",
    )
    centres.coalesce(1).write.mode(mode).parquet(f"{index_dir}/centroids")


def _write_tree(
    vectors: DataFrame, upper: np.ndarray, nlist: int, metric: str, seed: int, index_dir: str, mode: str
) -> None:
    """Two levels: vectors by upper centre, sorted by leaf, and a table for each level."""
    spark, dim = vectors.sparkSession, upper.shape[1]
    placed = materialise(assign_clusters(vectors, upper, metric, "top"), "placed")
    # One row per upper centre.
    sizes = dict(placed.groupBy("top").count().collect())
    leaves = materialise(grow_leaves(placed, upper, sizes, nlist, metric, seed), "leaves")
    (
        to_leaves(placed, leaves, dim, metric)
        .hint("rebalance", "top")
        .sortWithinPartitions("top", "cluster_id")
        .write.mode(mode)
        .partitionBy("top")
        .parquet(f"{index_dir}/vectors")
    )
    held = spark.read.parquet(f"{index_dir}/vectors").groupBy("cluster_id").agg(F.count("*").alias("n_rows"))
    counted = leaves.join(held, "cluster_id", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    counted.select("top", "cluster_id", "centroid", "n_rows").write.mode(mode).parquet(f"{index_dir}/centroids")
    tops = [(i, c.tolist(), sizes.get(i, 0)) for i, c in enumerate(upper)]
    tops = spark.createDataFrame(tops, "top INT, centroid ARRAY<DOUBLE>, n_rows BIGINT")
    tops.coalesce(1).write.mode(mode).parquet(f"{index_dir}/upper")


@passing_tables()
def build_index(
    spark: SparkSession,
    source: str | DataFrame,
    index_dir: str = "",
    *,
    embedding_col: str = "embedding",
    metric: str = "cosine",
    nlist: int | None = None,
    nprobe: int | None = None,
    recall: float = RECALL_TARGET,
    train_rows: int | None = None,
    max_centres: int | None = None,
    seed: int = 0,
    model: str = "",
    output_root: str = OUTPUT_ROOT,
    mode: str = "errorifexists",
) -> dict:
    """Write the index of a vector table and return its manifest.

    Unless given, ``nprobe`` is the smallest number of clusters (in two levels: the smallest power of two)
    that finds the share ``recall`` of the true neighbours of some two hundred rows, themselves left out;
    the manifest's ``recall`` is measured on as many other rows. ``train_rows`` bounds the rows that place
    the centres; by default all do. An ``nlist`` beyond ``max_centres`` (by default what a broadcast
    holds) makes a tree of centres in two levels, with about that many clusters.

    ``source`` is a Parquet path or a frame with ``index_id``. An empty ``index_dir`` stands for the
    default path below ``output_root`` for that Parquet path. Vectors are grouped for the write by a
    rebalance on the cluster, which also splits a cluster that holds much of the data.
    """
    check_metric(metric)
    if isinstance(source, str):
        df = read_vectors(spark, source, embedding_col=embedding_col)
        index_dir = index_dir or index_path(spark, output_root, source, model=model)
    else:
        # Training, assigning and describing read the rows several times; an encoder runs once.
        df = materialise(source, "vectors")
    if not index_dir:
        raise ValueError("an index of a frame needs an index_dir")
    for column in ("index_id", embedding_col):
        if column not in df.columns:
            raise ValueError(f"missing column {column!r}")
    dim = vector_dim(df, embedding_col)
    vectors = df.select("index_id", F.col(embedding_col).alias("embedding"))
    rows = vectors.count()
    nlist = min(rows, nlist or default_nlist(rows, dim))
    most = max_centres or max_nlist(dim)
    if nlist > most**2:
        raise ValueError(f"nlist must not exceed {most**2} for dimension {dim}")
    tree = nlist > most
    centroids = _train(vectors, rows, math.ceil(math.sqrt(nlist)) if tree else nlist, metric, seed, train_rows)
    if tree:
        _write_tree(vectors, centroids, nlist, metric, seed, index_dir, mode)
    else:
        _write_flat(vectors, centroids, metric, index_dir, mode)
    # The number of rows in the centre table: clusters, and the rows they hold.
    held = spark.read.parquet(f"{index_dir}/centroids").agg(F.count("*").alias("n"), F.sum("n_rows").alias("rows")).head()

    enough, measured = _calibrate(spark, index_dir, vectors, None if tree else centroids, metric, recall, nprobe, held["n"], seed)
    described = Observation()
    metadata = df.drop(embedding_col).observe(described, F.count(F.lit(1)).alias("rows"))
    metadata.write.mode(mode).parquet(f"{index_dir}/metadata")
    indexed, written = held["rows"], described.get["rows"]
    if not rows == written == indexed:
        raise RuntimeError(f"row count mismatch: {rows} read, {indexed} indexed, {written} described")
    manifest = {
        "input": source if isinstance(source, str) else "",
        "output_dir": index_dir,
        "embedding_col": embedding_col,
        "space": metric,
        "dimensions": dim,
        "count": rows,
        "nlist": held["n"],
        "nprobe": enough,
        "recall_target": recall,
        "recall": measured,
        "seed": seed,
        "created_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()),
        "index_file": "vectors",
        "metadata_file": "metadata",
    }
    write_manifest(spark, manifest, index_dir, mode=mode)
    return manifest


def _calibrate(
    spark: SparkSession,
    index_dir: str,
    vectors: DataFrame,
    centroids: np.ndarray | None,
    metric: str,
    target: float,
    nprobe: int | None,
    nlist: int,
    seed: int,
) -> tuple[int, float]:
    """Clusters to probe, and the share of true neighbours found with them by rows that had no say in it.

    Rows chosen by hash are searched exactly; every other one of them helps to choose the number of
    clusters, the rest measure what it finds. In one level, how far down a row's list of clusters its
    neighbours lie tells the share for any number; a tree is searched with ever more probes.
    """
    drawn = vectors.orderBy(F.xxhash64("index_id", F.lit(seed)), "index_id").limit(2 * CALIBRATION_QUERIES)
    measures = F.pmod(F.xxhash64("index_id", F.lit(seed + 1)), F.lit(2)) == 0
    columns = [F.col("index_id").alias("query_id"), "embedding", F.col("index_id").alias("own"), measures.alias("measures")]
    asked = materialise(drawn.select(*columns), "calibration")
    exact = knn_join(asked, vectors, CALIBRATION_K, metric, self_col="own").select("query_id", "index_id")
    if centroids is None:
        return _calibrate_tree(spark, index_dir, asked, materialise(exact, "exact"), metric, target, nprobe, nlist)
    stored = spark.read.parquet(f"{index_dir}/vectors").select("index_id", "cluster_id")
    # Bounded: a few hundred queries with ten neighbours each.
    homes = stored.join(F.broadcast(exact), "index_id").select("query_id", "cluster_id").toArrow()
    rows = asked.toArrow()
    if not homes.num_rows:
        return min(nprobe or 1, nlist), 1.0
    near = nearness(to_matrix(rows["embedding"], centroids.shape[1]), centroids, metric)
    place = near.argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
    at = {q: i for i, q in enumerate(rows["query_id"].to_pylist())}
    owner = np.array([at[q] for q in homes["query_id"].to_pylist()])
    depth = place[owner, homes["cluster_id"].to_numpy()]
    measuring = rows["measures"].to_numpy()[owner]
    choosing = np.sort(depth[~measuring] if not measuring.all() else depth)
    needed = int(choosing[math.ceil(target * len(choosing)) - 1]) + 1
    probes = min(nprobe or needed, nlist)
    measured = depth[measuring] if measuring.any() else depth
    return probes, round(float((measured < probes).mean()), 4)


def _calibrate_tree(
    spark: SparkSession,
    index_dir: str,
    asked: DataFrame,
    exact: DataFrame,
    metric: str,
    target: float,
    nprobe: int | None,
    nlist: int,
) -> tuple[int, float]:
    true = exact.join(F.broadcast(asked.select("query_id", "measures")), "query_id")
    dim = vector_dim(asked)

    def share(probes: int, measures: bool) -> float:
        some = asked.filter(F.col("measures") == measures)
        found = _query(spark, index_dir, some, CALIBRATION_K, metric, dim, probes, "own", BROADCAST_BYTES)
        found = found.select("query_id", "index_id", F.lit(1).alias("hit"))
        wanted = true.filter(F.col("measures") == measures).join(found, ["query_id", "index_id"], "left")
        hits = wanted.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
        return 1.0 if hits is None else hits

    probes = min(nprobe or 1, nlist)
    while not nprobe and probes < nlist and share(probes, False) < target:
        probes = min(2 * probes, nlist)
    return probes, round(share(probes, True), 4)


def _probe(
    queries: DataFrame, centroids: np.ndarray, sizes: np.ndarray, metric: str, nprobe: int, want: int
) -> DataFrame:
    """``clusters`` to read for each query: the ``nprobe`` nearest, and further ones while those hold
    fewer than ``want`` rows, so that no query comes back short."""
    dim = centroids.shape[1]
    shared = queries.sparkSession.sparkContext.broadcast((centroids, sizes))

    def run(batches):
        centres, counts = shared.value
        for batch in batches:
            asked = to_matrix(batch.column("embedding"), dim)
            picked = [np.empty(0, np.int32)]
            starts = row_blocks(len(asked), len(centres))
            for lo in starts:
                near = nearness(asked[lo : lo + starts.step], centres, metric)
                order = near.argsort(axis=1, kind="stable").astype(np.int32)
                enough = (counts[order].cumsum(axis=1) < want).sum(axis=1) + 1
                take = np.clip(np.maximum(nprobe, enough), 1, len(centres))
                picked += [o[:t] for o, t in zip(order, take)]
            lengths = [len(p) for p in picked]
            clusters = pa.ListArray.from_arrays(
                pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(np.concatenate(picked))
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, clusters], names=[*batch.schema.names, "clusters"])

    clusters = T.StructField("clusters", T.ArrayType(T.IntegerType()))
    return queries.mapInArrow(run, T.StructType([*queries.schema.fields, clusters]))


def query_index(
    spark: SparkSession,
    index_dir: str,
    queries: DataFrame,
    k: int = 5,
    *,
    nprobe: int | None = None,
    query_id: str = "query_id",
    embedding_col: str = "embedding",
    self_col: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Nearest rows among the probed clusters, as (query_id, rank, index_id, score).

    A query set of up to ``broadcast_bytes`` is broadcast to a scan of the probed clusters; a larger one
    is dealt to them, and meets each cluster in tiles.
    """
    manifest = read_manifest(spark, index_dir)
    dim, metric = int(manifest["dimensions"]), manifest["space"]
    asked = standard_queries(queries, query_id, embedding_col, self_col)
    probes = max(1, min(nprobe or int(manifest["nprobe"]), int(manifest["nlist"])))
    return _query(spark, index_dir, asked, k, metric, dim, probes, self_col and "own_id", broadcast_bytes)


def _query(
    spark: SparkSession,
    index_dir: str,
    queries: DataFrame,
    k: int,
    metric: str,
    dim: int,
    nprobe: int,
    own: str | None,
    broadcast_bytes: int,
) -> DataFrame:
    asked = standard_queries(queries, "query_id", "embedding", own)
    schema = result_schema(asked.schema["query_id"].dataType)
    vectors = spark.read.parquet(f"{index_dir}/vectors")
    centres = spark.read.parquet(f"{index_dir}/centroids")
    tree = "top" in centres.columns
    # Bounded when the index is built: as many centres as a broadcast holds.
    known = spark.read.parquet(f"{index_dir}/upper").toArrow().sort_by("top") if tree else centres.toArrow().sort_by("cluster_id")
    first, sizes = to_wide(known["centroid"], dim), known["n_rows"].to_numpy()
    want = k + bool(own)
    counted = Observation()
    # Whoever asks for every cluster needs no list of them.
    all_of_them = nprobe >= (centres.count() if tree else len(first))
    if all_of_them:
        probes, listed = asked, F.lit(0)
    elif tree:
        probes, listed = probe_leaves(asked, first, sizes, centres, metric, nprobe, want), F.size("clusters")
    else:
        probes, listed = _probe(asked, first, sizes, metric, nprobe, want), F.size("clusters")
    probes = probes.observe(
        counted, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(listed), F.lit(0)).alias("probes")
    )
    probes = materialise(probes, "probes")
    rows = counted.get["rows"]
    if not rows:
        return best_per_query(spark.createDataFrame([], schema), k, metric)
    one = query_bytes(dim, k)
    if rows * one + counted.get["probes"] * 8 <= broadcast_bytes:
        if all_of_them:
            side = collect_queries(probes, dim, bool(own))
            found = scan_join(vectors.select("index_id", "embedding"), side, schema["query_id"].dataType, k, metric)
        else:
            found = _scan(vectors, probes, dim, k, metric, bool(own), len(first) if not tree else None)
    else:
        block, part = max(1, broadcast_bytes // one), max(1, broadcast_bytes // (dim * 8))
        found = _tiles(vectors, centres, probes, rows, dim, k, metric, block, part, schema)
    return best_per_query(found, k, metric)


def _scan(vectors: DataFrame, probes: DataFrame, dim: int, k: int, metric: str, has_own: bool, nlist: int | None):
    """Candidates for a query set that is broadcast; only its clusters are read."""
    rows = probes.toArrow()
    clusters = rows["clusters"].combine_chunks()
    owner = np.repeat(np.arange(rows.num_rows), np.diff(clusters.offsets.to_numpy()))
    probed = clusters.flatten().to_numpy()
    order = np.argsort(probed, kind="stable")
    names, starts = np.unique(probed[order], return_index=True)
    side = QuerySet(
        ids=rows["query_id"].combine_chunks(),
        vectors=to_matrix(rows["embedding"], dim),
        own=rows["own_id"].to_numpy() if has_own else None,
        clusters=dict(zip(names.tolist(), np.split(owner[order], starts[1:]))),
    )
    read = vectors.select("index_id", "embedding", "cluster_id")
    if len(side.clusters) != nlist:
        read = read.filter(F.col("cluster_id").isin(names.tolist()))
    return scan_join(read, side, probes.schema["query_id"].dataType, k, metric)


def _grid(queries: int, rows: int, dim: int, k: int, most_queries: int, most_rows: int, tasks: int) -> tuple[int, int]:
    """Blocks of queries and parts of rows, both bounded, that make ``tasks`` tiles with the least to move.

    Each part gets the queries and returns k rows for each; each block gets the rows.
    """
    blocks, parts = -(-queries // most_queries), -(-rows // most_rows)
    row = dim * 4 + 16

    def moved(n: int) -> int:
        return n * queries * (row + k * 28) + max(blocks, -(-tasks // n)) * rows * row

    parts = min(range(parts, max(parts, tasks) + 1), key=moved)
    return max(blocks, -(-tasks // parts)), parts


def _deal(probes: DataFrame, parts: int, slices: dict[int, int]) -> DataFrame:
    """``probes`` once for each part that holds some of its ``clusters``, with those; no shuffle.

    A cluster begins in the part of its number; one of several slices goes on in the parts behind it.
    """
    wide = np.array(sorted(slices), np.int64)
    counts = np.minimum(np.array([slices[c] for c in wide.tolist()], np.int64), parts)
    asked = [f for f in probes.schema.fields if f.name != "clusters"]
    names = [f.name for f in asked] + ["part", "clusters"]

    def run(batches):
        for batch in batches:
            lists = batch.column("clusters")
            lengths = np.diff(lists.offsets.to_numpy())
            starts = row_blocks(len(lengths), lengths.max(initial=1))
            for lo in starts:
                some = batch.slice(lo, starts.step)
                size, clusters = lengths[lo : lo + starts.step], some.column("clusters").flatten().to_numpy()
                owner, times = np.repeat(np.arange(len(size)), size), np.ones(len(clusters), np.int64)
                if len(wide):
                    at = np.minimum(np.searchsorted(wide, clusters), len(wide) - 1)
                    times = np.where(wide[at] == clusters, counts[at], 1)
                step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                clusters = np.repeat(clusters, times)
                place = np.repeat(owner, times) * parts + (clusters + step) % parts
                order = place.argsort(kind="stable")
                met, first = np.unique(place[order], return_index=True)
                offsets = pa.array(np.append(first, len(order)).astype(np.int32))
                held = pa.ListArray.from_arrays(offsets, pa.array(clusters[order].astype(np.int32)))
                columns = [some.column(f.name).take(pa.array(met // parts)) for f in asked]
                yield pa.RecordBatch.from_arrays([*columns, pa.array((met % parts).astype(np.int32)), held], names=names)

    kinds = [T.StructField("part", T.IntegerType()), T.StructField("clusters", T.ArrayType(T.IntegerType()))]
    return probes.mapInArrow(run, T.StructType([*asked, *kinds]))


def _tiles(
    vectors: DataFrame,
    centres: DataFrame,
    probes: DataFrame,
    n_queries: int,
    dim: int,
    k: int,
    metric: str,
    block_rows: int,
    part_rows: int,
    schema: T.StructType,
) -> DataFrame:
    """Candidates for a query set of any size: blocks of queries meet parts of the rows in tiles.

    Queries form blocks by hash, clusters form parts by their number; what holds much of a part is cut
    into slices. A query goes once to each part that holds some of its clusters and gets k rows from it,
    however many clusters those are. Without ``clusters`` it asks for all of them.
    """
    spark = probes.sparkSession
    n_rows = centres.agg(F.sum("n_rows")).first()[0] or 0
    tasks = TILES_PER_CORE * spark.sparkContext.defaultParallelism
    blocks, parts = _grid(n_queries, n_rows, dim, k, block_rows, part_rows, tasks)
    # No more than a few for each part.
    slice_rows = max(1, n_rows // (SLICES_PER_PART * parts))
    large = centres.filter(F.col("n_rows") > slice_rows).select("cluster_id", F.ceil(F.col("n_rows") / slice_rows))
    slices = {r[0]: r[1] for r in large.collect()}
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")
    chosen = "clusters" in probes.columns
    sent = _deal(probes, parts, slices).select("*", block) if chosen else probes.select("*", block, every(parts).alias("part"))
    known = F.broadcast(spark.createDataFrame(list(slices.items()), "cluster_id INT, slices BIGINT"))
    shift = F.pmod(F.xxhash64("index_id"), F.coalesce("slices", F.lit(1)))
    part = F.pmod(F.col("cluster_id") + shift, F.lit(parts)).cast("int").alias("part")
    held = vectors.join(known, "cluster_id", "left").select("index_id", "embedding", "cluster_id", part)
    held = held.select("*", every(blocks).alias("block"))
    return meet_in_tiles(sent, held if chosen else held.drop("cluster_id"), dim, k, metric, schema)
