"""Compare a Spark result with a DuckDB result as bags of rows."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def as_bag(rows, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else a short description."""
    mine = as_bag(spark_df.collect(), spark_df.columns)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = as_bag(cursor.fetchall(), names)
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if mine == theirs:
        return None
    a, b = set(mine), set(theirs)
    return (
        f"{len(mine)} rows against {len(theirs)}; only here: {sorted(a - b)[:2]}; "
        f"only there: {sorted(b - a)[:2]}"
    )
