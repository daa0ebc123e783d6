"""Connected components of a set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphvec.session import materialise, settled


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _stars(edges: DataFrame) -> DataFrame:
    """One round: hang larger neighbours, then smaller ones, on the smallest neighbour."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    larger = (
        near.join(least, "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .distinct()
    )
    least = larger.groupBy("u").agg(F.min("v").alias("m"))
    moved = larger.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(moved).distinct()


@settled("components")
def components(edges: DataFrame) -> DataFrame:
    """(u, v): each linked node other than the smallest of its component, and that smallest node.

    ``edges`` has longs ``u`` and ``v``, in any direction, repeated or not; nulls and loops do not
    count. Edges never leave the executors: a round is three shuffles of edges, written to the shared
    folder, and rounds end when every node hangs on a root. Only the last round's table stays.
    """
    edges = edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = materialise(edges.distinct(), "edges")
    while True:
        degree = edges.groupBy("u").agg(F.count("*").alias("n"))
        chained = edges.join(degree.select(F.col("u").alias("v")), "v", "left_semi")
        if degree.filter("n > 1").isEmpty() and chained.isEmpty():
            return edges
        edges = materialise(_stars(edges), "edges")
