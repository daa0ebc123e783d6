"""Dense row numbers 0..n-1 without pulling the rows through one task.

All three forms need one small table of offsets and add a local position to it:

* ``number_parquet_rows``: one offset per file, position from the Parquet reader. No shuffle.
* ``number_split_rows``: one offset per input split of a text scan. No shuffle.
* ``assign_index_id``: any sort key; one range shuffle, written once, one offset per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphvec.functions.order import natural_key
from glyphvec.session import materialise, planned_bytes

BROADCAST_UNITS = 1_000_000
# Above it, splits have the full spark.sql.files.maxPartitionBytes for any likely number of cores.
FIXED_SPLIT_BYTES_PER_CORE = 512 * 1024 * 1024


def _running_offsets(counts: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows before each unit. One row per file, split or partition: the list that the driver of any
    Spark scan already holds, so one task orders it."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_rows").over(before), F.lit(0)).cast("long")
    return counts.withColumn("_offset", offset)


def _join_offsets(rows: DataFrame, offsets: DataFrame, keys: list[str]) -> DataFrame:
    """Offsets are broadcast while there are no more than a million of them, a few hundred bytes each."""
    if offsets.count() <= BROADCAST_UNITS:
        offsets = F.broadcast(offsets)
    return rows.join(offsets, keys, "left")


def file_directory(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _offset, _rows) of a Parquet table: its files in natural order, the ordinal of the first
    row of each, and its number of rows. No column is read. Written once, it serves any number of lookups."""
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    counts = rows.groupBy("_file").agg((F.max("_row") + 1).alias("_rows"))
    placed = _running_offsets(counts, [natural_key(F.col("_file")), "_file"])
    return materialise(placed.select("_file", "_offset", "_rows"), "file-offsets")


def row_at(spark: SparkSession, path: str, index_id: int, directory: DataFrame | None = None) -> DataFrame:
    """The row of a Parquet table at an ordinal, by ``file_directory``: only the file that holds it is read."""
    files = directory if directory is not None else file_directory(spark, path)
    at = F.lit(index_id) - F.col("_offset")
    name = F.url_decode(F.replace("_file", F.lit("+"), F.lit("%2B")))
    found = files.filter((at >= 0) & (at < F.col("_rows"))).select(name, at).head()
    if found is None:
        raise ValueError(f"index_id out of range: {index_id}")
    rows = spark.read.option("basePath", path).parquet(found[0]).drop("index_id")
    return rows.filter(F.col("_metadata.row_index") == found[1]).select(F.lit(index_id).cast("long").alias("index_id"), "*")


def number_parquet_rows(spark: SparkSession, path: str) -> DataFrame:
    """``index_id`` in natural file order, then row order in the file; replaces one that is stored."""
    df = spark.read.parquet(path).drop("index_id")
    place = [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    ]
    offsets = file_directory(spark, path).select("_file", "_offset")
    placed = _join_offsets(df.select("*", *place), offsets, ["_file"])
    return placed.select((F.col("_offset") + F.col("_row")).alias("index_id"), *df.columns)


def number_split_rows(scan: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """``index_id`` for a text scan: file order, then order in the file, then ``columns`` of the scan.

    A split is read in one go by one task, so the distance to the first row id of the split is the
    position in it. The scan runs twice (once without its columns) and nothing is shuffled. Only where
    the input is so small that Spark sizes its splits by the number of cores, which may change between
    the two passes, it is parsed once into a table.
    """
    unit = ["_file", "_block"]
    placed = scan.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        *columns,
    )
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if planned_bytes(scan) < cores * FIXED_SPLIT_BYTES_PER_CORE:
        placed = materialise(placed, "records")
    counts = placed.groupBy(*unit).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first")
    )
    order = [natural_key(F.col("_file")), "_file", "_block"]
    offsets = materialise(_running_offsets(counts, order), "split-offsets")
    position = F.col("_row") - F.col("_first")
    moved = F.raise_error(F.lit("the input splits changed between the two passes of the scan"))
    index_id = F.when(
        position.between(0, F.col("_rows") - 1), F.col("_offset") + position
    ).otherwise(moved.cast("long"))
    names = [c for c in placed.columns if c not in (*unit, "_row")]
    return _join_offsets(placed, offsets, unit).select(index_id.alias("index_id"), *names)


def assign_index_id(df: DataFrame, order_by: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """``index_id`` by any total order. Equal keys all land in one range, so make the key unique.

    The driver gets up to 300 keys for each of ``partitions``, by default ``spark.sql.shuffle.partitions``.
    """
    ranges = (partitions, *order_by) if partitions else order_by
    placed = (
        df.repartitionByRange(*ranges)
        .sortWithinPartitions(*order_by)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_pos"),
        )
    )
    table = materialise(placed, "ranges")
    counts = table.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = _running_offsets(counts, ["_part"]).select("_part", "_offset")
    # One row per range partition.
    return table.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_pos")).alias("index_id"), *df.columns
    )
