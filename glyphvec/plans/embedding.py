"""Read, clean, embed and write in one pass over the input."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from glyphvec.operators.embed import BATCH_SIZE, ProviderFactory, embed
from glyphvec.sinks.tables import (
    FORMATS,
    OUTPUT_ROOT,
    embeddings_path,
    in_order,
    suffix_format,
    write_embeddings,
)
from glyphvec.session import widen
from glyphvec.sources.texts import read_texts


def embed_texts(
    spark: SparkSession,
    source: str,
    output: str,
    factory: ProviderFactory,
    *,
    fmt: str | None = None,
    rules: dict | None = None,
    patterns: str = "intended",
    batch_size: int = BATCH_SIZE,
    normalize: bool = True,
    partitions: int | None = None,
    model: str = "",
    output_root: str = OUTPUT_ROOT,
    mode: str = "errorifexists",
    **options,
) -> dict:
    """Embed all records of ``source`` and return the run's rows, dim, output and seconds.

    ``fmt`` defaults by the suffix of ``output``, ``.vectors`` or anything else. Ordered vectors are
    ordered as texts, before they are encoded, so each text is encoded once.

    An empty ``output`` stands for the default path of ``model`` and ``source`` below ``output_root``.
    ``partitions`` repartitions the texts before encoding, to bound the number of concurrent calls to a
    remote provider; by default only an input of fewer splits than cores is dealt out.
    """
    fmt = fmt or suffix_format(output)
    if fmt not in FORMATS:
        raise ValueError(f"unsupported output format {fmt!r}, use one of {FORMATS}")
    started = time.monotonic()
    output = output or embeddings_path(spark, output_root, model, source, suffix=fmt)
    dim = factory().dim
    texts = read_texts(spark, source, ordered=fmt == "vectors", **options)
    if fmt == "vectors":
        texts = in_order(texts, partitions)
    else:
        texts = texts.repartition(partitions) if partitions else widen(texts)
    vectors = embed(
        texts, factory, rules=rules, patterns=patterns, batch_size=batch_size, normalize=normalize
    )
    rows = write_embeddings(vectors, output, dim=dim, fmt=fmt, ordered=fmt == "vectors", mode=mode)
    return {"rows": rows, "dim": dim, "output": output, "seconds": time.monotonic() - started}


def run_metrics(spark: SparkSession, path: str):
    """Rows and dimension of written embeddings, as one row."""
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size("embedding")).cast("long").alias("dim")
    )
