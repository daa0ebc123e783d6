"""How long intermediate tables live."""

import os
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from glyphvec import session
from glyphvec.operators.ivf import build_index, query_index
from glyphvec.plans.prepare import write_category_paths
from glyphvec.session import materialise, passing_tables, settled


@pytest.fixture
def shared(tmp_path, monkeypatch):
    """The folder of intermediate tables, for this test alone."""
    folder = tmp_path / "shared"
    monkeypatch.setattr(session, "work_path", lambda spark, label: f"{folder}/{label}-{uuid.uuid4().hex}")
    return folder


def left(shared: Path) -> list[str]:
    """Labels of the tables that are there."""
    return sorted(name.rsplit("-", 1)[0] for name in os.listdir(shared)) if shared.is_dir() else []


def test_settled_keeps_the_result_alone(spark, shared):
    @settled("squares")
    def squares(n):
        numbers = materialise(spark.range(n), "numbers")
        return numbers.select((F.col("id") * F.col("id")).alias("square"))

    found = squares(4)
    assert left(shared) == ["squares"]
    assert sorted(r["square"] for r in found.collect()) == [0, 1, 4, 9]


def test_settled_results_pass_with_the_job_around_them(spark, shared):
    @settled("inner")
    def inner():
        return materialise(spark.range(3), "first")

    @settled("outer")
    def outer():
        table = inner()
        assert left(shared) == ["inner"]
        return table.unionByName(table)

    assert outer().count() == 6
    assert left(shared) == ["outer"]


def test_tables_outside_any_job_stay(spark, shared):
    kept = materialise(spark.range(2), "kept")
    with passing_tables():
        materialise(kept, "gone")
        assert left(shared) == ["gone", "kept"]
    assert left(shared) == ["kept"]
    assert kept.count() == 2


def test_failed_jobs_leave_nothing(spark, shared):
    @settled("never")
    def fails(late):
        table = materialise(spark.range(3), "numbers")
        if not late:
            raise KeyError("early")
        return table.select(F.raise_error(F.lit("late")).alias("x"))

    for late in (False, True):
        with pytest.raises(Exception, match="late" if late else "early"):
            fails(late)
        # A write that fails may leave an empty folder of the result; no table of the job is there.
        assert "numbers" not in left(shared)
    materialise(spark.range(1), "next")
    assert "next" in left(shared)


@pytest.mark.parametrize("max_centres", [None, 3])
def test_an_index_leaves_no_other_table(spark, shared, tmp_path, max_centres):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)]
    vectors = spark.createDataFrame(rows, "index_id BIGINT, embedding ARRAY<FLOAT>")
    index = str(tmp_path / f"index-{max_centres}")
    build_index(spark, vectors, index, nlist=6, nprobe=6, max_centres=max_centres)
    assert left(shared) == []
    query = vectors.filter("index_id = 3").select(F.col("index_id").alias("query_id"), "embedding")
    assert query_index(spark, index, query, 2).count() == 2


def test_category_paths_leave_no_other_table(spark, shared, tmp_path):
    source = tmp_path / "categories.csv"
    source.write_text("category_level,category_id,parent_id,root_id,category_name_en\n1,1,,,A\n2,2,1,1,B\n3,3,2,1,C\n")
    write_category_paths(spark, str(source), str(tmp_path / "out"))
    assert left(shared) == []
