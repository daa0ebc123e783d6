"""The row-wise part of the library on a stream: clean, embed, append to Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glyphvec.functions.text import or_empty
from glyphvec.operators.embed import ProviderFactory, embed
from glyphvec.sources.texts import ID, TEXT


def stream_tsv(spark: SparkSession, folder: str, *, quote: str = "") -> DataFrame:
    """New headerless ``id<TAB>text`` files of a folder, as they arrive."""
    raw = (
        spark.readStream.schema(f"{ID} STRING, {TEXT} STRING")
        .option("sep", "\t")
        .option("quote", quote)
        .csv(folder)
    )
    return raw.select(or_empty(F.col(ID)).alias(ID), or_empty(F.col(TEXT)).alias(TEXT))


def embed_stream(
    texts: DataFrame,
    factory: ProviderFactory,
    output: str,
    checkpoint: str,
    *,
    rules: dict | None = None,
    text_col: str = TEXT,
    available_now: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start the stream. There is no state, so the checkpoint only holds offsets and commits."""
    writer = (
        embed(texts, factory, text_col=text_col, rules=rules)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
