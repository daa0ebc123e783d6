"""Lookups by ordinal: one vector, a batch of vectors, metadata of result rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphvec.functions.text import or_empty


def vector_at(vectors: DataFrame, index_id: int, *, embedding_col: str = "embedding") -> DataFrame:
    """The vector of one row. The filter reaches the scan, where file statistics prune it."""
    if embedding_col not in vectors.columns:
        raise ValueError(f"missing embedding column {embedding_col!r}")
    found = vectors.filter(F.col("index_id") == index_id).select("index_id", embedding_col)
    if found.isEmpty():
        raise ValueError(f"index_id out of range: {index_id}")
    return found.withColumnRenamed(embedding_col, "embedding")


def checked_ids(ids: DataFrame, table: DataFrame, id_col: str = "index_id") -> DataFrame:
    """``ids`` unchanged; fails if one of them is not an ordinal of ``table``."""
    stray = ids.select(id_col).join(table.select(id_col), id_col, "left_anti").head()
    if stray is not None:
        raise ValueError(f"{id_col} out of range: {stray[0]}")
    return ids


def vectors_at(
    vectors: DataFrame, ids: DataFrame, dim: int, *, embedding_col: str = "embedding"
) -> DataFrame:
    """The vectors of the rows named in ``ids``; the planner broadcasts the id list if it is small."""
    from glyphvec.functions.vectors import checked_vector

    found = vectors.select("index_id", embedding_col).join(
        ids.select("index_id").distinct(), "index_id", "left_semi"
    )
    return found.select(
        "index_id", checked_vector(F.col(embedding_col), dim).alias("embedding")
    )


def available(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The requested columns that exist."""
    return [c for c in columns if c in df.columns]


def attach_metadata(
    results: DataFrame,
    metadata: DataFrame,
    columns: Sequence[str] = ("video_id", "video_title"),
    *,
    index_id: str = "index_id",
) -> DataFrame:
    """Metadata columns of each result row; a column or a value that is missing becomes ``''``.

    ``results`` holds queries x k rows. Its ids first thin the metadata (a semi join, which streams
    the metadata past a broadcast of the ids whenever the planner finds them small), then the few
    rows left join the results.
    """
    present = available(metadata, columns)
    out = results
    if present:
        ids = results.select(F.col(index_id).alias("_id")).distinct()
        rows = metadata.select(F.col("index_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in present])
        out = results.join(
            rows.join(ids, "_id", "left_semi"), F.col(index_id) == F.col("_id"), "left"
        )
    added = [
        or_empty(F.col(f"_{c}").cast("string") if c in present else F.lit("")).alias(c)
        for c in columns
    ]
    return out.select(*results.columns, *added)
