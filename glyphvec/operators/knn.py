"""Exact k-nearest-neighbour join.

The query matrix is broadcast and the corpus streams past it in Arrow batches, without a shuffle. Each
task keeps k rows per query, so that the one shuffle, by query, moves (tasks x queries x k) small rows
however large the corpus is. A query set beyond the measured bound is joined tile by tile instead.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphvec.functions.vectors import check_metric
from glyphvec.operators.tiles import tile_join
from glyphvec.operators.topk import BestRows, to_matrix
from glyphvec.session import materialise, runs_python

BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass
class QuerySet:
    """The broadcast side: query ids, vectors, own ordinals, and probed clusters where there are any."""

    ids: pa.Array
    vectors: np.ndarray
    own: np.ndarray | None
    clusters: dict[int, np.ndarray] | None


def query_bytes(dim: int, k: int) -> int:
    """What one query takes in a task: its vector in double precision and its k best rows twice."""
    return dim * 8 + k * 48


def result_schema(query_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", query_type),
            T.StructField("index_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )


def arrow_result_schema(query_type: T.DataType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(result_schema(query_type))


def best_per_query(candidates: DataFrame, k: int, metric: str) -> DataFrame:
    """Rank by score, ties by ordinal. Spark cuts each task's rows to k before the shuffle.

    Inner products are ranked as they are and shown minus one.
    """
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("index_id"))
    ranked = candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    shown = F.col("score") - 1.0 if metric == "ip" else F.col("score")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "index_id", shown.alias("score"))


def scan_join(corpus: DataFrame, queries: QuerySet, query_type: T.DataType, k: int, metric: str):
    """Candidates of ``corpus(index_id, embedding[, cluster_id])`` against the broadcast queries."""
    spark = corpus.sparkSession
    shared = spark.sparkContext.broadcast(queries)
    dim = queries.vectors.shape[1]
    schema = arrow_result_schema(query_type)

    def run(batches):
        side = shared.value
        best = BestRows(side.vectors, side.own, k, metric)
        for batch in batches:
            ids = batch.column("index_id").to_numpy()
            vectors = to_matrix(batch.column("embedding"), dim)
            if side.clusters is None:
                best.add(vectors, ids)
                continue
            cluster = batch.column("cluster_id").to_numpy()
            for c in np.unique(cluster):
                rows = side.clusters.get(int(c))
                if rows is not None:
                    here = cluster == c
                    best.add(vectors[here], ids[here], rows)
        yield best.to_arrow(side.ids, schema)

    return corpus.mapInArrow(run, result_schema(query_type))


def standard_queries(
    queries: DataFrame, query_id: str, embedding_col: str, self_col: str | None
) -> DataFrame:
    columns = [F.col(query_id).alias("query_id"), F.col(embedding_col).alias("embedding")]
    if self_col:
        columns.append(F.col(self_col).cast("long").alias("own_id"))
    return queries.select(*columns)


def collect_queries(queries: DataFrame, dim: int, has_own: bool) -> QuerySet:
    table = queries.toArrow()
    return QuerySet(
        ids=table["query_id"].combine_chunks(),
        vectors=to_matrix(table["embedding"], dim),
        own=table["own_id"].to_numpy() if has_own else None,
        clusters=None,
    )


def knn_join(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    *,
    query_id: str = "query_id",
    embedding_col: str = "embedding",
    self_col: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The k nearest rows of ``corpus(index_id, embedding)`` for every query, as (query_id, rank,
    index_id, score).

    Scores are doubles of each pair by itself and equal scores rank by ``index_id``, so the result does
    not depend on partitioning. ``self_col`` names the query's own ordinal, which is then
    left out. k beyond the corpus returns the whole corpus.
    """
    check_metric(metric)
    if k < 1:
        raise ValueError("k must be at least 1")
    # Written first: queries that come from an encoder are encoded once.
    size = Observation()
    counted = standard_queries(queries, query_id, embedding_col, self_col).observe(
        size, F.count(F.lit(1)).alias("rows"), F.max(F.size("embedding")).alias("dim")
    )
    asked = materialise(counted, "queries")
    rows = corpus.select("index_id", F.col(embedding_col).alias("embedding"))
    schema = result_schema(asked.schema["query_id"].dataType)
    if not size.get["rows"]:
        return best_per_query(corpus.sparkSession.createDataFrame([], schema), k, metric)
    dim = size.get["dim"]
    one = query_bytes(dim, k)
    if size.get["rows"] * one <= broadcast_bytes:
        side = collect_queries(asked, dim, bool(self_col))
        return best_per_query(scan_join(rows, side, schema["query_id"].dataType, k, metric), k, metric)
    # The vectors are read several times; those that come from an encoder are encoded once.
    rows = materialise(rows, "vectors") if runs_python(rows) else rows
    n_rows = rows.count()
    if not n_rows:
        return best_per_query(corpus.sparkSession.createDataFrame([], schema), k, metric)
    block, part = max(1, broadcast_bytes // one), max(1, broadcast_bytes // (dim * 8))
    return best_per_query(tile_join(asked, rows, n_rows, dim, k, metric, block, part, schema), k, metric)
