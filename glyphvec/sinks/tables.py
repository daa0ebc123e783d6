"""Table and file writers."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from glyphvec.functions.slugs import dataset_slug, model_slug, model_slug_from_path, slug
from glyphvec.functions.vectors import checked_vector
from glyphvec.session import is_directory

FORMATS = ("parquet", "vectors")
OUTPUT_ROOT = "output/models"


def embedding_columns(df: DataFrame, dim: int) -> DataFrame:
    """The stored shape: optional text id, text, checked vector."""
    columns = [F.col("video_title").cast("string")]
    if "video_id" in df.columns:
        columns.insert(0, F.col("video_id").cast("string"))
    return df.select(*columns, checked_vector(F.col("embedding"), dim).alias("embedding"))


def in_order(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows in ordinal order over the partitions and inside each."""
    ranges = (partitions, "index_id") if partitions else ("index_id",)
    return df.repartitionByRange(*ranges).sortWithinPartitions("index_id")


def ordered_vectors(df: DataFrame, dim: int, ordered: bool = False) -> DataFrame:
    """Only ordinals and vectors, in ordinal order over the files and inside each file."""
    vectors = df.select("index_id", checked_vector(F.col("embedding"), dim).alias("embedding"))
    return vectors if ordered else in_order(vectors)


def write_embeddings(
    df: DataFrame,
    path: str,
    *,
    dim: int,
    fmt: str = "parquet",
    ordered: bool = False,
    total_rows: int | None = None,
    mode: str = "errorifexists",
) -> int:
    """Write embeddings and return the row count, which is measured in the write itself.

    ``parquet`` keeps id and text; ``vectors`` keeps only the ordered vectors of a frame with
    ``index_id``; ``ordered`` says that the rows are in order already, otherwise they are sorted here,
    which evaluates them twice. An empty frame still writes a typed table. ``total_rows`` is the count to expect.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported output format {fmt!r}, use one of {FORMATS}")
    out = embedding_columns(df, dim) if fmt == "parquet" else ordered_vectors(df, dim, ordered)
    written = Observation()
    out.observe(written, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    rows = written.get["rows"]
    if total_rows is not None and rows != total_rows:
        raise RuntimeError(f"row count mismatch: expected {total_rows}, wrote {rows}")
    return rows


def format_of(path: str) -> str:
    """Output format by the suffix of the path."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    suffix = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    if suffix not in FORMATS:
        raise ValueError(f"unsupported output suffix in {path!r}, use .parquet or .vectors")
    return suffix


def suffix_format(path: str) -> str:
    """Output format by the suffix of the path; Parquet where it says nothing."""
    return "vectors" if path.rstrip("/").lower().endswith(".vectors") else "parquet"


def write_partitioned(df: DataFrame, root: str, part: str, model: str, dataset: str) -> None:
    """One table for all models and datasets below ``root``/``part``; reads prune on both columns.

    A rerun replaces the rows of its model and dataset and leaves all others.
    """
    (
        df.withColumn("model", model_slug(F.lit(model)))
        .withColumn("dataset", slug(F.lit(dataset)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model", "dataset")
        .parquet(f"{root}/{part}")
    )


def _evaluate(spark: SparkSession, **columns: Column):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).head()


def embeddings_path(
    spark: SparkSession, root: str, model: str, source: str, *, dataset: str = "", suffix: str = "parquet"
) -> str:
    """Default output of an embedding job: ``<root>/<model>/embeddings/<dataset>.<suffix>``."""
    name = slug(F.lit(dataset)) if dataset else dataset_slug(F.lit(source), is_directory(spark, source))
    row = _evaluate(spark, model=model_slug(F.lit(model)), name=name)
    return f"{root.rstrip('/')}/{row['model']}/embeddings/{row['name']}.{suffix.lstrip('.')}"


def index_path(
    spark: SparkSession, root: str, embeddings: str, *, model: str = "", dataset: str = ""
) -> str:
    """Default folder of an index: ``<root>/<model>/ann_index/<dataset>_index``, both names taken from
    the path of the embeddings unless given."""
    known = model_slug(F.lit(model)) if model else model_slug_from_path(F.lit(embeddings))
    name = slug(F.lit(dataset)) if dataset else dataset_slug(F.lit(embeddings))
    row = _evaluate(spark, model=known, name=name)
    return f"{root.rstrip('/')}/{row['model']}/ann_index/{row['name']}_index"


def write_manifest(spark: SparkSession, manifest: dict, index_dir: str, *, mode: str) -> None:
    line = spark.createDataFrame([(json.dumps(manifest, ensure_ascii=False),)], "value STRING")
    line.coalesce(1).write.mode(mode).text(f"{index_dir}/manifest.json")


def write_results(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Query results as JSON lines; nothing happens for an empty path."""
    if path:
        df.write.mode(mode).json(path)


def text_lines(df: DataFrame, id_col: str = "video_id", text_col: str = "video_title") -> DataFrame:
    """``id<TAB>text`` lines, raw: read them back with ``quote=""``."""
    return df.select(F.concat_ws("\t", F.col(id_col), F.col(text_col)).alias("value"))


def write_text_table(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    text_lines(df).write.mode(mode).text(path)


def write_combos(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Category paths as tab-separated text in input order, quoted only where needed."""
    out = df.orderBy("row_ord") if "row_ord" in df.columns else df
    (
        out.select("combo_id", "combo_name")
        .write.mode(mode)
        .option("sep", "\t")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
