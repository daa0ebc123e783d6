"""Prepare inputs: merge a folder of text files, write the category path table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.functions.order import numeric_first_key
from glyphvec.functions.text import file_stem, single_line
from glyphvec.operators.categories import distinct_combos, named_paths, path_stats, with_combo
from glyphvec.session import materialise, passing_tables
from glyphvec.sinks.tables import write_combos, write_text_table
from glyphvec.sources.categories import read_categories
from glyphvec.sources.texts import ID, TEXT, file_text, text_names, with_content


def merged_texts(spark: SparkSession, folder: str, *, limit: int = 0) -> DataFrame:
    """One single-line record per text file, numeric names first by value, then the others.

    A ``limit`` picks its files by name alone, before any content is read.
    """
    # From the URI, which is known before a file is opened.
    stem = file_stem(F.url_decode(F.replace(F.col("file_uri"), F.lit("+"), F.lit("%2B"))))
    order = numeric_first_key(stem).alias("key"), stem.alias("stem"), F.col("file_uri").alias("uri")
    place = F.struct(*order)
    files = text_names(spark, folder)
    if limit > 0:
        last = files.select(place.alias("place")).orderBy("place").offset(limit - 1).head(1)
        if last:
            key, name, uri = last[0]["place"]
            literal = F.struct(*(F.lit(key[c]).alias(c) for c in ("is_text", "size", "text")))
            files = files.filter(place <= F.struct(literal.alias("key"), F.lit(name).alias("stem"), F.lit(uri).alias("uri")))
    return with_content(files, *order).select(
        stem.alias(ID), single_line(file_text(F.col("content"))).alias(TEXT)
    )


def merge_texts(
    spark: SparkSession, folder: str, output: str, *, limit: int = 0, mode: str = "errorifexists"
) -> None:
    """Write the merged records as raw ``id<TAB>text`` lines."""
    write_text_table(merged_texts(spark, folder, limit=limit), output, mode=mode)


@passing_tables()
def write_category_paths(
    spark: SparkSession,
    source: str,
    output: str,
    *,
    name_col: str = "category_name_en",
    mode: str = "errorifexists",
) -> dict[str, int]:
    """Write the path table and return its counts: rows, written, skipped, missing_names."""
    # The input is parsed once and joined once; table and counts come from what that wrote.
    categories = materialise(read_categories(spark, source, name_col=name_col), "categories")
    paths = materialise(with_combo(named_paths(categories)), "paths")
    write_combos(distinct_combos(paths), output, mode=mode)
    return path_stats(categories, paths).head().asDict()
