"""The category table: one row per category of a tree of up to three levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.functions.order import natural_key
from glyphvec.functions.text import or_empty, strip
from glyphvec.sources.texts import breaks_in_quotes, first_fields

KEY_COLUMNS = ("category_level", "category_id", "parent_id", "root_id")


def read_categories(
    spark: SparkSession, path: str, *, name_col: str = "category_name_en"
) -> DataFrame:
    """Valid rows as (level, category_id, parent_id, root_id, name, row_ord).

    ``row_ord`` orders rows as they stand in the input: file in natural order, split, position in it.
    Names may hold line breaks inside quotes.
    """
    fields = first_fields(spark, path, ",", '"')
    missing = sorted({*KEY_COLUMNS, name_col} - set(fields))
    if missing:
        raise ValueError(f"missing required columns {missing} in {path}")
    labels = {name: f"_c{i}" for i, name in enumerate(fields)}
    scan = (
        spark.read.schema(", ".join(f"`_c{i}` STRING" for i in range(len(fields))))
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", breaks_in_quotes(spark, path, '"'))
        .csv(path)
    )
    columns = [F.col(labels[c]).alias(c) for c in KEY_COLUMNS]
    position = F.struct(
        natural_key(F.col("_metadata.file_path")).alias("place"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    raw = scan.select(*columns, F.col(labels[name_col]).alias("name"), position.alias("row_ord"))
    return valid_categories(raw)


def valid_categories(raw: DataFrame) -> DataFrame:
    """Strip all fields and drop rows whose level is not a positive integer or whose id is blank."""
    text = {c: strip(or_empty(F.col(c))) for c in ("category_id", "parent_id", "root_id", "name")}
    level = strip(or_empty(F.col("category_level").cast("string"))).try_cast("int")
    return raw.select(
        level.alias("level"), *[c.alias(n) for n, c in text.items()], "row_ord"
    ).filter((F.col("level") > 0) & (F.col("category_id") != ""))
