"""Three-level category paths from a category table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = ("root_id", "parent_id", "category_id")


def category_names(categories: DataFrame) -> DataFrame:
    """Name of each category: the first in input order, even a blank one."""
    return categories.groupBy("category_id").agg(F.min_by("name", "row_ord").alias("name"))


def named_paths(categories: DataFrame) -> DataFrame:
    """Every level-3 row with its three names, ``''`` where a category has none.

    Three left joins to the name table. No side is forced to be broadcast: the planner decides from
    the measured sizes, and splits the partition of a root that holds much of the tree. Rows without a
    root or parent take no part in the joins; their names stay ``''``.
    """
    names = category_names(categories)
    leaves = categories.filter(F.col("level") == 3)
    has_path = (F.col("root_id") != "") & (F.col("parent_id") != "")
    bare = leaves.filter(~has_path).select(
        *LEVELS, "row_ord", *[F.lit("").alias(f"n{i}") for i in (1, 2, 3)], F.lit(False).alias("has_path")
    )
    out = leaves.filter(has_path)
    for i, column in enumerate(LEVELS, start=1):
        lookup = names.select(F.col("category_id").alias(f"_id{i}"), F.col("name").alias(f"_n{i}"))
        out = out.join(lookup, F.col(column) == F.col(f"_id{i}"), "left")
    filled = [F.coalesce(f"_n{i}", F.lit("")).alias(f"n{i}") for i in (1, 2, 3)]
    return out.select(*LEVELS, "row_ord", *filled, F.lit(True).alias("has_path")).unionByName(bare)


def with_combo(paths: DataFrame) -> DataFrame:
    complete = F.col("has_path") & (F.col("n1") != "") & (F.col("n2") != "") & (F.col("n3") != "")
    return paths.select(
        F.concat_ws("_", *LEVELS).alias("combo_id"),
        F.concat_ws(" > ", "n1", "n2", "n3").alias("combo_name"),
        "has_path",
        complete.alias("complete"),
        "row_ord",
    )


def category_combos(categories: DataFrame) -> DataFrame:
    """(combo_id, combo_name, row_ord): complete paths, the first of equal combo ids."""
    return distinct_combos(with_combo(named_paths(categories)))


def distinct_combos(paths: DataFrame) -> DataFrame:
    first = F.min_by(F.struct("combo_name", "row_ord"), "row_ord").alias("first")
    return (
        paths.filter("complete")
        .groupBy("combo_id")
        .agg(first)
        .select("combo_id", "first.combo_name", "first.row_ord")
    )


def category_stats(categories: DataFrame) -> DataFrame:
    """One row: valid rows, distinct paths written, rows without a full id path, rows lacking a name."""
    return path_stats(categories, with_combo(named_paths(categories)))


def path_stats(categories: DataFrame, paths: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    names = ("written", "skipped", "missing_names")
    rows = categories.select(F.lit(1).alias("one")).agg(F.count("one").alias("rows"))
    counts = paths.agg(
        F.count_distinct(F.when(F.col("complete"), F.col("combo_id"))).alias("written"),
        F.count_if(~F.col("has_path")).alias("skipped"),
        F.count_if(F.col("has_path") & ~F.col("complete")).alias("missing_names"),
    )
    both = rows.select("rows", *[zero.alias(n) for n in names]).unionByName(
        counts.select(zero.alias("rows"), *names)
    )
    return both.agg(*[F.sum(n).alias(n) for n in ("rows", *names)])
