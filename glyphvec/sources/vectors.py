"""Vector tables, query vectors, index manifests and index metadata."""

from __future__ import annotations

import io
import json
import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.functions.text import or_empty, strip
from glyphvec.operators.lookup import vector_at
from glyphvec.operators.ordinals import number_parquet_rows, row_at

MANIFEST_SCHEMA = (
    "input STRING, output_dir STRING, embedding_col STRING, space STRING, dimensions INT, count BIGINT, "
    "nlist INT, nprobe INT, recall_target DOUBLE, recall DOUBLE, seed BIGINT, created_at STRING, "
    "index_file STRING, metadata_file STRING"
)
QUERY_SCHEMA = "query_id BIGINT, embedding ARRAY<FLOAT>"


def read_vectors(
    spark: SparkSession, path: str, *, embedding_col: str = "embedding"
) -> DataFrame:
    """A Parquet table of vectors with ``index_id``: the one it has, or its row order in the files."""
    df = spark.read.parquet(path)
    if embedding_col not in df.columns:
        raise ValueError(f"missing embedding column {embedding_col!r} in {path}")
    return df if "index_id" in df.columns else number_parquet_rows(spark, path)


def vector_dim(df: DataFrame, embedding_col: str = "embedding") -> int:
    """Length of the first vector; the operators reject any row of another length."""
    row = df.select(F.size(embedding_col).alias("dim")).head()
    if row is None:
        raise ValueError("the vector table is empty")
    if row["dim"] is None or row["dim"] < 1:
        raise ValueError("the first vector is null or empty")
    return row["dim"]


def _one_query(spark: SparkSession, values: list) -> DataFrame:
    if not isinstance(values, list) or not values:
        raise ValueError("a query vector is a non-empty list of numbers")
    return spark.createDataFrame([(0, [float(v) for v in values])], QUERY_SCHEMA)


def read_vector_file(spark: SparkSession, path: str) -> DataFrame:
    """One query vector from a ``.npy`` file or a text file holding a JSON list."""
    row = spark.read.format("binaryFile").load(path).select("content").head()
    content = bytes(row["content"])
    if os.path.splitext(path)[1].lower() == ".npy":
        values = np.load(io.BytesIO(content), allow_pickle=False).astype(float).tolist()
    else:
        text = content.decode("utf-8").strip()
        if not text:
            raise ValueError(f"empty vector file {path}")
        values = json.loads(text)
    return _one_query(spark, values)


def query_vector(
    spark: SparkSession,
    *,
    literal: str = "",
    file: str = "",
    table: str = "",
    index_id: int = -1,
    embedding_col: str = "embedding",
) -> DataFrame:
    """One query as (query_id, embedding): a JSON literal wins over a table row, that over a file."""
    if not (literal or file or table):
        raise ValueError("give a JSON literal, a vector file or a vector table")
    if table and index_id < 0:
        raise ValueError("a vector table needs the index_id of the row")
    if literal:
        return _one_query(spark, json.loads(literal))
    if not table:
        return read_vector_file(spark, file)
    stored = spark.read.parquet(table)
    # Without stored ordinals the row is found by its file, and only that file is read.
    vectors = stored if "index_id" in stored.columns else row_at(spark, table, index_id)
    found = vector_at(vectors, index_id, embedding_col=embedding_col)
    return found.select(F.lit(0).cast("long").alias("query_id"), "embedding")


def parse_vectors(df: DataFrame, json_col: str) -> DataFrame:
    """A column of JSON lists as ``embedding``: many query vectors at once."""
    return df.withColumn("embedding", F.from_json(json_col, "array<float>"))


def read_manifest(spark: SparkSession, index_dir: str) -> dict:
    """The one-row manifest beside an index."""
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{index_dir}/manifest.json").head().asDict()


def read_index_metadata(spark: SparkSession, index_dir: str) -> DataFrame:
    """Metadata for reports: ids and titles as text, nulls empty, titles stripped."""
    meta = spark.read.parquet(f"{index_dir}/metadata")
    if "video_id" not in meta.columns:
        raise ValueError(f"the metadata in {index_dir} has no video_id column")
    out = meta.withColumn("video_id", or_empty(F.col("video_id").cast("string")))
    if "video_title" in meta.columns:
        out = out.withColumn("video_title", strip(or_empty(F.col("video_title").cast("string"))))
    return out
