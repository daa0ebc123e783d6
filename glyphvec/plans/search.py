"""Search jobs: query an index with metadata, sample an index for quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.operators.ivf import query_index
from glyphvec.operators.knn import knn_join
from glyphvec.operators.lookup import attach_metadata, vectors_at
from glyphvec.operators.sampling import report_lines, seeded_sample
from glyphvec.sources.vectors import read_index_metadata, read_manifest, vector_dim


def search_index(
    spark: SparkSession, index_dir: str, queries: DataFrame, k: int = 5, **options
) -> DataFrame:
    """Ranked neighbours with id and title: query_id, rank, index_id, score, video_id, video_title."""
    found = query_index(spark, index_dir, queries, k, **options)
    return attach_metadata(found, spark.read.parquet(f"{index_dir}/metadata"))


def sample_neighbours(
    vectors: DataFrame,
    metadata: DataFrame,
    *,
    n: int = 5,
    k: int = 10,
    seed: int = 0,
    include_self: bool = False,
    metric: str = "cosine",
    embedding_col: str = "embedding",
    search=None,
) -> DataFrame:
    """Neighbours of ``n`` sampled rows, ready for ``report_lines``.

    ``search(queries, self_col)`` answers the queries; by default the exact join does.
    """
    titled = "video_title" in metadata.columns
    title = F.col("video_title") if titled else F.lit("")
    drawn = seeded_sample(metadata, n, seed).select(
        F.col("draw"),
        F.col("index_id").alias("query_index_id"),
        F.col("video_id").alias("query_video_id"),
        title.alias("query_video_title"),
    )
    dim = vector_dim(vectors, embedding_col)
    picked = drawn.select(F.col("query_index_id").alias("index_id"))
    queries = vectors_at(vectors, picked, dim, embedding_col=embedding_col)
    self_col = None if include_self else "index_id"
    if search is not None:
        found = search(queries, self_col)
    else:
        found = knn_join(
            queries, vectors, k, metric, query_id="index_id", embedding_col="embedding", self_col=self_col
        )
    rows = attach_metadata(found, metadata)
    return drawn.join(rows.withColumnRenamed("query_id", "query_index_id"), "query_index_id").select(
        "draw",
        "query_index_id",
        "query_video_id",
        "query_video_title",
        "rank",
        "index_id",
        "score",
        "video_id",
        "video_title",
    )


def sample_index(
    spark: SparkSession,
    index_dir: str,
    *,
    mode: str = "video",
    url_prefix: str = "",
    n: int = 5,
    k: int = 10,
    seed: int = 0,
    nprobe: int | None = None,
    include_self: bool = False,
) -> DataFrame:
    """The report over a written index, as (draw, line_no, line)."""
    metadata = read_index_metadata(spark, index_dir)
    if mode == "text" and "video_title" not in metadata.columns:
        raise ValueError("the text report needs a video_title column in the metadata")
    metric = read_manifest(spark, index_dir)["space"]
    vectors = spark.read.parquet(f"{index_dir}/vectors")

    def search(queries: DataFrame, self_col: str | None) -> DataFrame:
        return query_index(
            spark, index_dir, queries, k, nprobe=nprobe, query_id="index_id", self_col=self_col
        )

    rows = sample_neighbours(
        vectors,
        metadata,
        n=n,
        k=k,
        seed=seed,
        include_self=include_self,
        metric=metric,
        search=search,
    )
    return report_lines(rows, mode, url_prefix)
