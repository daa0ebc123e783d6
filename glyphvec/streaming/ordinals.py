"""Ordinals for the rows of a stream that a replayed batch gets again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glyphvec.operators.ordinals import assign_index_id
from glyphvec.session import is_directory


def number_batches(output: str, offsets: str, order_by: Sequence[str | Column]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends ``index_id`` and writes the rows below ``output``.

    A batch goes on where the earlier ones end: ``offsets`` keeps the number of rows of each batch, one
    row for each. Both folders are partitioned by ``batch_id`` and a batch replaces its own part, so one
    that is run again (after a failure between the two writes, or by Spark) gets the same ordinals and
    leaves no row twice. ``order_by`` must order the rows of a batch totally.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Spark hands over a session of its own for the batch.
        spark = batch.sparkSession
        first = 0
        if is_directory(spark, offsets):
            earlier = spark.read.schema("n_rows BIGINT, batch_id BIGINT").parquet(offsets)
            first = earlier.filter(F.col("batch_id") < batch_id).agg(F.sum("n_rows")).first()[0] or 0
        numbered = assign_index_id(batch, order_by).withColumn("index_id", F.col("index_id") + F.lit(first))
        written = Observation()
        numbered = numbered.observe(written, F.count(F.lit(1)).alias("rows"))
        numbered.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
        counted = spark.createDataFrame([(written.get["rows"],)], "n_rows BIGINT")
        counted.coalesce(1).write.mode("overwrite").parquet(f"{offsets}/batch_id={batch_id}")

    return write


def number_stream(
    rows: DataFrame,
    output: str,
    checkpoint: str,
    order_by: Sequence[str | Column],
    *,
    available_now: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start a stream that numbers ``rows`` in the order of their batches, and by ``order_by`` in a batch."""
    writer = rows.writeStream.foreachBatch(number_batches(output, f"{checkpoint}/ordinals", order_by))
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.option("checkpointLocation", f"{checkpoint}/stream").trigger(**trigger).start()
