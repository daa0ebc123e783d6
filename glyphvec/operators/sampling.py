"""Seeded sampling and the neighbour report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphvec.functions.text import item_label, media_url, non_empty

MODES = ("video", "text")


def seeded_sample(df: DataFrame, n: int, seed: int = 0, *, id_col: str = "video_id") -> DataFrame:
    """``n`` rows with a non-blank id, without replacement, in draw order (``draw`` from 1).

    The draw is by a hash of seed and ordinal, so it is the same for any partitioning.
    """
    ticket = F.md5(F.concat(F.lit(f"{seed}:"), F.col("index_id").cast("string")))
    usable = df.filter(non_empty(F.col(id_col).cast("string"))).withColumn("_ticket", ticket)
    drawn = usable.orderBy("_ticket", "index_id").limit(n)
    # At most n rows are left, so one task may number them.
    draw = F.row_number().over(Window.orderBy("_ticket", "index_id"))
    return drawn.withColumn("draw", draw).drop("_ticket")


def _two_digits(n: Column) -> Column:
    return F.format_string("%02d", n)


def report_lines(neighbours: DataFrame, mode: str = "video", url_prefix: str = "") -> DataFrame:
    """The report as (draw, line_no, line): a heading per query, then one entry per neighbour.

    Needs draw, query_video_id, query_video_title, rank, score, video_id and video_title.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    shown = F.concat(F.lit("  score="), F.format_string("%.6f", "score"))
    number = F.concat(F.lit("  "), _two_digits(F.col("rank")), F.lit(". "))

    def titled(head: Column, indent: str, title: str) -> Column:
        tail = F.concat(F.lit("\n" + indent), F.col(title))
        return F.concat(head, F.when(F.col(title) != "", tail).otherwise(F.lit("")))

    if mode == "text":
        heading = F.concat(
            F.lit("Query: "), item_label(F.col("query_video_id"), F.col("query_video_title"))
        )
        entry = F.concat(number, item_label(F.col("video_id"), F.col("video_title")), shown)
    else:
        url = media_url(F.col("query_video_id"), url_prefix)
        heading = titled(
            F.concat(F.lit("Query: "), F.col("query_video_id"), F.lit("  "), url),
            "  Title: ",
            "query_video_title",
        )
        url = media_url(F.col("video_id"), url_prefix)
        entry = titled(
            F.concat(number, F.col("video_id"), F.lit("  "), url, shown), "      ", "video_title"
        )
    lines = F.when(
        F.col("rank") == 1,
        F.array(
            F.struct(F.lit(0).alias("line_no"), heading.alias("line")),
            F.struct(F.col("rank").alias("line_no"), entry.alias("line")),
        ),
    ).otherwise(F.array(F.struct(F.col("rank").alias("line_no"), entry.alias("line"))))
    return neighbours.select("draw", F.inline(lines))
