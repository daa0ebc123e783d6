"""Registered queries over the given tables, each beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Catalogue:
    """Collects queries and their SQL under one name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None):
        def register(query: Query) -> Query:
            key = name or query.__name__
            self.queries[key] = query
            if sql:
                self.sql[key] = sql
            return query

        return register
