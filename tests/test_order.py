import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glyphvec.functions.order import natural_key, numeric_first_key
from glyphvec.operators.ordinals import assign_index_id, number_parquet_rows

QUIET = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def python_natural(name):
    return [int(p) if p.isdigit() else p.lower() for p in re.split("([0-9]+)", name)], name


def python_numeric_first(stem):
    try:
        return 0, int(stem), "", stem
    except ValueError:
        return 1, 0, stem, stem


def ordered(spark, names, key):
    df = spark.createDataFrame([(n,) for n in names], "n STRING").repartition(3)
    return [r["n"] for r in df.orderBy(key(F.col("n")), "n").collect()]


@QUIET
@given(st.lists(st.text("aB01_29.-", max_size=12), min_size=30, max_size=60, unique=True))
def test_natural_order(spark, names):
    assert ordered(spark, names, natural_key) == sorted(names, key=python_natural)


@QUIET
@given(st.lists(st.text("a0159_- +.", max_size=6), min_size=30, max_size=60, unique=True))
def test_numeric_first_order(spark, names):
    assert ordered(spark, names, numeric_first_key) == sorted(names, key=python_numeric_first)


def test_long_numbers(spark):
    names = ["9" * 60, "1" + "0" * 60, "a", "-" + "9" * 50, "5"]
    want = ["-" + "9" * 50, "5", "9" * 60, "1" + "0" * 60, "a"]
    assert ordered(spark, names, numeric_first_key) == want


def test_assigned_ordinals_are_dense_and_ordered(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("p"))
    rows = assign_index_id(df, ["k"]).collect()
    assert sorted((r["index_id"], r["k"]) for r in rows) == [(i, i) for i in range(1000)]
    empty = assign_index_id(df.filter("k < 0"), ["k"])
    assert empty.count() == 0 and empty.columns[0] == "index_id"


def test_parquet_ordinals_follow_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 500).repartitionByRange(12, "id").sortWithinPartitions("id")
    df.write.option("maxRecordsPerFile", 17).parquet(path)
    rows = number_parquet_rows(spark, path).collect()
    assert all(r["index_id"] == r["id"] for r in rows) and len(rows) == 500
