"""Large query sets against an index, in tiles."""

import numpy as np
import pytest

from glyphvec.operators import ivf
from glyphvec.operators.knn import knn_join, query_bytes

DIM = 8


@pytest.fixture(scope="module")
def rows(spark):
    made = np.random.default_rng(3).normal(size=(400, DIM)).astype(np.float32)
    made[100:300] = made[0]  # one cluster holds half of the rows
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(made)], "index_id BIGINT, embedding ARRAY<FLOAT>")


def answer(spark, index, rows, **options):
    found = ivf.query_index(spark, index, rows, 5, query_id="index_id", self_col="index_id", **options)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
@pytest.mark.parametrize("tree", [{}, {"max_centres": 5}])
def test_tiles_find_what_a_scan_finds(spark, tmp_path, monkeypatch, rows, metric, tree):
    index = str(tmp_path / "index")
    ivf.build_index(spark, rows, index, metric=metric, nlist=20, nprobe=7, **tree)
    candidates, rank = [], ivf.best_per_query
    monkeypatch.setattr(ivf, "best_per_query", lambda found, *a: candidates.append(found.count()) or rank(found, *a))
    bound = 400 * query_bytes(DIM, 5) // 2
    for probes in (7, 10**6):
        scanned = answer(spark, index, rows, nprobe=probes)
        assert answer(spark, index, rows, nprobe=probes, broadcast_bytes=bound) == scanned
        # k rows for each query and part, of which there are few, and not for each probed cluster.
        assert candidates[-1] <= 400 * 5 * 6
    exact = knn_join(rows, rows, 5, metric, query_id="index_id", self_col="index_id")
    assert scanned == sorted(tuple(r) for r in exact.collect())


def test_grid():
    assert ivf._grid(1000, 1000, 64, 10, 100, 100, 4) == (10, 10)
    blocks, parts = ivf._grid(100_000, 100_000, 64, 10, 67_000, 131_000, 24)
    assert blocks * parts >= 24 and blocks >= 2 and parts < 8
