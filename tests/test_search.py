import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from glyphvec.operators.ivf import build_index, query_index
from glyphvec.operators.knn import knn_join, query_bytes
from glyphvec.operators.lookup import attach_metadata, checked_ids, vectors_at
from glyphvec.operators.topk import drop_far_copies
from glyphvec.plans.search import sample_index, sample_neighbours, search_index
from glyphvec.sinks.tables import write_results
from glyphvec.sources.vectors import read_manifest

SCHEMA = "index_id BIGINT, embedding ARRAY<FLOAT>"


def frame(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def brute(queries, corpus, k, metric, own=False):
    """The answer by definition: the score of every pair, ties by ordinal."""
    q, x = queries.astype(np.float32).astype(float), corpus.astype(np.float32).astype(float)
    out = []
    for i in range(len(q)):
        same = np.repeat(q[i : i + 1], len(x), axis=0)
        s = np.einsum("ij,ij->i", same, x)
        if metric == "cosine":
            norms = np.sqrt(np.einsum("ij,ij->i", same, same)) * np.sqrt(np.einsum("ij,ij->i", x, x))
            s = np.divide(s, norms, out=np.zeros_like(s), where=norms > 0)
        elif metric == "l2":
            s = -np.einsum("ij,ij->i", same - x, same - x)
        s = s + 0.0
        ids = [j for j in range(len(x)) if not (own and j == i)]
        best = sorted(ids, key=lambda j: (-s[j], j))[:k]
        out += [(i, r + 1, j, s[j] - 1.0 if metric == "ip" else s[j]) for r, j in enumerate(best)]
    return out


def got(df):
    return sorted((r["query_id"], r["rank"], r["index_id"], r["score"]) for r in df.collect())


@pytest.fixture(scope="module")
def messy():
    """Copies of one vector in a third of the rows, zero rows, long vectors, near ties."""
    rng = np.random.default_rng(7)
    m = rng.normal(size=(240, 6))
    m[::3] = m[0]
    m[5] = m[40] = m[77] = 0.0
    m[100:110] *= 1000.0
    m[110:120] = m[111] + rng.normal(size=(10, 6)) * 1e-7
    return m.astype(np.float32)


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
@pytest.mark.parametrize("own", [False, True])
@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 90 * query_bytes(6, 7)])
def test_exact_join(spark, messy, metric, own, broadcast_bytes):
    df = frame(spark, messy)
    found = knn_join(
        df,
        df,
        7,
        metric,
        query_id="index_id",
        self_col="index_id" if own else None,
        broadcast_bytes=broadcast_bytes,
    )
    assert got(found) == brute(messy, messy, 7, metric, own)


def test_small_arrow_batches(spark, messy):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        df = frame(spark, messy)
        assert got(knn_join(df, df, 4, "cosine", query_id="index_id")) == brute(messy, messy, 4, "cosine")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_k_beyond_the_corpus(spark):
    m = np.eye(3)
    assert got(knn_join(frame(spark, m), frame(spark, m), 99, query_id="index_id")) == brute(m, m, 99, "cosine")


def test_small_distances_rank(spark):
    corpus = frame(spark, np.array([[0, 1e-4], [1e-4, 0], [9e-5, 0]]))
    query = spark.createDataFrame([(7, [1e-4, 0.0])], "query_id BIGINT, embedding ARRAY<FLOAT>")
    for metric in ("l2", "ip"):
        assert [r[2] for r in got(knn_join(query, corpus, 3, metric))] == [1, 2, 0]


def test_default_probing_finds_the_neighbours(spark, tmp_path):
    rng = np.random.default_rng(9)
    m = rng.normal(size=(900, 16)).astype(np.float32)
    index = str(tmp_path / "index")
    manifest = build_index(spark, frame(spark, m), index, metric="ip")
    assert manifest["recall"] >= manifest["recall_target"] == 0.95
    found = got(query_index(spark, index, frame(spark, m[:200]), 10, query_id="index_id"))
    exact = brute(m[:200], m, 10, "ip")
    assert len({f[::2][:2] for f in found} & {e[::2][:2] for e in exact}) >= 0.9 * len(exact)


def test_two_dimensions(spark):
    corpus = frame(spark, np.array([[1, 0], [0, 1], [0.8, 0.2]]))
    query = spark.createDataFrame([("q", [1.0, 0.0])], "query_id STRING, embedding ARRAY<FLOAT>")
    rows = got(knn_join(query, corpus, 2))
    assert [(r[0], r[1], r[2]) for r in rows] == [("q", 1, 0), ("q", 2, 2)] and rows[0][3] > 0.99


def test_errors(spark):
    corpus = frame(spark, np.eye(3))
    wrong = spark.createDataFrame([(0, [1.0, 0.0])], "query_id BIGINT, embedding ARRAY<FLOAT>")
    with pytest.raises(PySparkException, match="dimension mismatch: expected 2, got 3"):
        knn_join(wrong, corpus).collect()
    with pytest.raises(ValueError, match="metric"):
        knn_join(wrong, corpus, metric="other")
    with pytest.raises(ValueError, match="k must"):
        knn_join(wrong, corpus, 0)
    assert knn_join(wrong.limit(0), corpus).count() == 0
    null = spark.createDataFrame([(0, None)], SCHEMA)
    with pytest.raises(PySparkException, match="null"):
        knn_join(frame(spark, np.eye(3)), null, query_id="index_id").collect()


def test_copies_beyond_k_are_not_scored():
    m = np.zeros((50, 3), np.float32)
    m[::2] = [1, 2, 3]
    ids = np.arange(50)[::-1].copy()
    kept = drop_far_copies(m, ids, 4)
    assert sorted(ids[kept]) == [0, 1, 2, 3, 4, 5, 6, 7]
    different = np.arange(150, dtype=np.float32).reshape(50, 3)
    assert len(drop_far_copies(different, ids, 4)) == 50


def test_lookups(spark):
    df = frame(spark, np.eye(3))
    ids = spark.createDataFrame([(2,), (0,)], "index_id BIGINT")
    found = {r["index_id"]: r["embedding"] for r in vectors_at(df, checked_ids(ids, df), 3).collect()}
    assert found == {0: [1, 0, 0], 2: [0, 0, 1]}
    with pytest.raises(ValueError, match="out of range: 9"):
        checked_ids(spark.createDataFrame([(9,)], "index_id BIGINT"), df)
    with pytest.raises(PySparkException, match="dimension mismatch"):
        vectors_at(df, ids, 4).collect()


def test_metadata_that_is_missing(spark):
    results = spark.createDataFrame([(0, 1, 5, 0.5)], "query_id INT, rank INT, index_id BIGINT, score DOUBLE")
    meta = spark.createDataFrame([(5, None)], "index_id BIGINT, video_title STRING")
    row = attach_metadata(results, meta).head()
    assert (row["video_id"], row["video_title"], row["index_id"]) == ("", "", 5)
    assert attach_metadata(results, meta.select("index_id")).head()["video_title"] == ""


@pytest.fixture(scope="module")
def clustered():
    """Ten tight groups; one of them holds a third of all rows."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(10, 8)) * 4
    group = np.where(np.arange(600) % 3 == 0, 0, np.arange(600) % 10)
    return (centres[group] + rng.normal(size=(600, 8)) * 0.3).astype(np.float32)


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_index(spark, clustered, tmp_path, metric):
    index = str(tmp_path / "index")
    df = frame(spark, clustered)
    manifest = build_index(spark, df, index, metric=metric, nlist=12)
    assert (manifest["count"], manifest["dimensions"], manifest["space"]) == (600, 8, metric)
    assert read_manifest(spark, index)["nlist"] == 12
    queries = frame(spark, clustered[:60])
    exact = brute(clustered[:60], clustered, 5, metric)
    recall = []
    for nprobe in (1, 3, 6, 12):
        options = {"nprobe": nprobe, "query_id": "index_id"}
        found = got(query_index(spark, index, queries, 5, **options))
        assert found == got(query_index(spark, index, queries, 5, broadcast_bytes=30 * query_bytes(8, 5), **options))
        assert len(found) == 300
        recall.append(len({(f[0], f[2]) for f in found} & {(e[0], e[2]) for e in exact}) / 300)
    assert recall == sorted(recall) and recall[-1] == 1.0 and found == exact
    if metric != "ip":
        assert recall[0] > 0.8 and recall[1] > 0.9


def test_index_probes_on_until_it_has_k_rows(spark, clustered, tmp_path):
    index = str(tmp_path / "index")
    build_index(spark, frame(spark, clustered), index, nlist=12)
    found = query_index(
        spark, index, frame(spark, clustered[:4]), 599, nprobe=1, query_id="index_id", self_col="index_id"
    )
    assert got(found) == brute(clustered[:4], clustered, 599, "cosine", own=True)


def test_index_from_a_table_without_ids(spark, tmp_path):
    table, index = str(tmp_path / "emb.parquet"), str(tmp_path / "index")
    rows = [("only-title-1", [1.0, 0.0]), ("only-title-2", [0.0, 1.0])]
    spark.createDataFrame(rows, "video_title STRING, embedding ARRAY<FLOAT>").coalesce(1).write.parquet(table)
    assert build_index(spark, table, index)["input"] == table
    query = spark.createDataFrame([(0, [1.0, 0.0])], "query_id INT, embedding ARRAY<FLOAT>")
    row = search_index(spark, index, query, 1).head()
    assert (row["rank"], row["video_id"], row["video_title"]) == (1, "", "only-title-1")
    with pytest.raises(ValueError, match="video_id"):
        sample_index(spark, index)
    out = str(tmp_path / "results")
    write_results(search_index(spark, index, query, 2), out)
    assert spark.read.json(out).count() == 2
    write_results(query, "")


def test_index_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        build_index(spark, spark.createDataFrame([], SCHEMA), str(tmp_path / "i"))
    with pytest.raises(ValueError, match="missing column"):
        build_index(spark, spark.range(3), str(tmp_path / "i"))
    one = frame(spark, np.eye(1))
    build_index(spark, one, str(tmp_path / "one"))
    assert got(query_index(spark, str(tmp_path / "one"), one, 3, query_id="index_id")) == [(0, 1, 0, 1.0)]


@pytest.fixture
def described(spark):
    rng = np.random.default_rng(1)
    rows = [
        (i, None if i == 3 else " " if i == 4 else f"v{i}", f" title {i} " if i % 2 else "", v.tolist())
        for i, v in enumerate(rng.normal(size=(12, 4)))
    ]
    schema = "index_id BIGINT, video_id STRING, video_title STRING, embedding ARRAY<FLOAT>"
    return spark.createDataFrame(rows, schema)


def test_sample(spark, described):
    def draw(seed, parts, **options):
        df = described.repartition(parts)
        return sample_neighbours(df, df.drop("embedding"), n=4, k=3, seed=seed, **options).collect()

    rows = draw(0, 2)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, draw(0, 5)))
    assert {r["draw"] for r in rows} == {1, 2, 3, 4} and len(rows) == 12
    assert all(r["index_id"] != r["query_index_id"] for r in rows)
    assert all(r["query_video_id"].strip() for r in rows)
    with_self = draw(0, 3, include_self=True)
    assert {r["index_id"] == r["query_index_id"] for r in with_self if r["rank"] == 1} == {True}
    everything = sample_neighbours(described, described.drop("embedding"), n=99, k=20)
    assert everything.select("query_index_id").distinct().count() == 10
    assert everything.count() == 110


def test_report(spark, described, tmp_path):
    index = str(tmp_path / "index")
    build_index(spark, described, index)
    options = {"n": 2, "k": 2, "nprobe": 99, "url_prefix": "http://h"}
    for mode in ("video", "text"):
        rows = sample_index(spark, index, mode=mode, **options).orderBy("draw", "line_no").collect()
        assert [r["line_no"] for r in rows] == [0, 1, 2, 0, 1, 2]
        for r in rows:
            head = "Query: v" if r["line_no"] == 0 else f"  {r['line_no']:02d}. "
            assert r["line"].startswith(head)
            assert ("http://h/v" in r["line"] or "http://h/" in r["line"]) == (mode == "video")
            assert ("score=" in r["line"]) == (r["line_no"] > 0)
    with pytest.raises(ValueError, match="mode"):
        sample_index(spark, index, mode="other")


def test_scan_plan_has_one_shuffle_and_no_nested_loop(spark):
    df = frame(spark, np.eye(4)).drop("x")
    plan = knn_join(df, df, 2, query_id="index_id")._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert "NestedLoop" not in initial and "Cartesian" not in initial
    assert initial.count("WindowGroupLimit") == 2
    assert initial.count("Exchange hashpartitioning(query_id") == 1


def test_vector_functions(spark):
    from glyphvec.functions.vectors import l2_normalize, score, zero_vector

    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [4.0, 3.0])], "a ARRAY<FLOAT>, z ARRAY<FLOAT>, b ARRAY<FLOAT>")
    row = df.select(
        l2_normalize(F.col("a")).alias("unit"),
        l2_normalize(F.col("z")).alias("zero"),
        *[score(F.col("a"), F.col("b"), m).alias(m) for m in ("cosine", "l2", "ip")],
        score(F.col("a"), zero_vector(2), "cosine").alias("none"),
    ).head()
    assert row["unit"] == [0.6, 0.8] and row["zero"] == [0.0, 0.0]
    assert abs(row["cosine"] - 0.96) < 1e-12 and row["l2"] == -2.0 and row["ip"] == 23.0
    assert row["none"] == 0.0


@pytest.mark.parametrize("cells", [40, 4_000_000])
def test_streamed_best_rows_match_brute_force(monkeypatch, cells):
    """Many small additions, blank queries, ties: the held rows are those of one big sort."""
    import pyarrow as pa

    import glyphvec.operators.topk as topk

    monkeypatch.setattr(topk, "BLOCK_CELLS", cells)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 13)
    rng = np.random.default_rng(5)
    corpus = rng.integers(-1, 2, size=(400, 3)).astype(np.float32)
    queries = np.vstack([corpus[:25], np.zeros((5, 3), np.float32)])
    best = topk.BestRows(queries, None, 6, "cosine")
    for lo in range(0, 400, 37):
        ids = np.arange(lo, min(lo + 37, 400))[::-1].copy()
        best.add(corpus[ids], ids)
    schema = pa.schema([("query_id", pa.int64()), ("index_id", pa.int64()), ("score", pa.float64())])
    out = best.to_arrow(pa.array(np.arange(30)), schema).to_pydict()
    want = brute(queries, corpus, 6, "cosine")
    assert sorted(zip(out["query_id"], out["index_id"], out["score"])) == sorted(
        (q, i, s) for q, _, i, s in want
    )


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_tree_of_centres(spark, clustered, tmp_path, metric):
    index = str(tmp_path / "tree")
    manifest = build_index(spark, frame(spark, clustered), index, metric=metric, nlist=30, max_centres=7)
    assert manifest["count"] == 600 and 15 <= manifest["nlist"] <= 45 and manifest["recall"] >= 0.9
    assert spark.read.parquet(f"{index}/upper").count() <= 7
    queries = frame(spark, clustered[:40])
    exact = brute(clustered[:40], clustered, 5, metric)
    for size in (1 << 26, 15 * query_bytes(8, 5)):
        found = got(query_index(spark, index, queries, 5, query_id="index_id", nprobe=100, broadcast_bytes=size))
        assert found == exact
    long = query_index(spark, index, frame(spark, clustered[:3]), 599, nprobe=1, query_id="index_id", self_col="index_id")
    assert got(long) == brute(clustered[:3], clustered, 599, metric, own=True)
    with pytest.raises(ValueError, match="must not exceed"):
        build_index(spark, frame(spark, clustered), str(tmp_path / "no"), nlist=30, max_centres=5)


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_tiles_of_large_sets(spark, clustered, metric, monkeypatch):
    """Small tiles, a cell with a third of all rows, copies, a zero row: the exact answer, no driver pass."""
    rows = np.concatenate([clustered, clustered[:50], np.zeros((1, 8), np.float32), clustered[:40] * 1e-4]).astype(np.float32)
    queries = rows[::9]
    ids = [int(i) for i in range(0, len(rows), 9)]
    asked = spark.createDataFrame([(i, q.tolist()) for i, q in zip(ids, queries)], "index_id BIGINT, embedding ARRAY<FLOAT>")
    plain = got(knn_join(asked, frame(spark, rows), 6, metric, query_id="index_id", self_col="index_id"))
    from glyphvec.operators import knn

    monkeypatch.setattr(knn, "collect_queries", None)
    tiled = knn_join(
        asked, frame(spark, rows), 6, metric, query_id="index_id", self_col="index_id", broadcast_bytes=20 * query_bytes(8, 6)
    )
    assert got(tiled) == plain


def test_cells_are_left_out(clustered):
    from glyphvec.operators.tiles import Cells

    for metric in ("cosine", "l2", "ip"):
        cells = Cells(np.empty((0, 8)), clustered[:300], np.arange(300), metric)
        cells.pivots = cells.points(clustered[:10])
        points = cells.points(clustered)
        gaps = cells.gaps(points)
        home = gaps.argmin(axis=1)
        cells.radius = np.array([gaps[home == c, c].max() if (home == c).any() else 0.0 for c in range(10)])
        _, meets = cells.reached(clustered[:60], np.arange(60), 5)
        assert meets.mean() < 0.8
        best = brute(clustered[:60], clustered, 5, metric, own=True)
        assert all(meets[q, home[i]] for q, _, i, _ in best)
