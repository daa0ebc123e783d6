import hashlib

import numpy as np
import pytest
from providers import Busy, Failing, Lengths, Seeded
from pyspark.errors import PySparkException

from glyphvec.operators.embed import HashingProvider, RetryingProvider, embed, encode_texts
from glyphvec.operators.ivf import build_index
from glyphvec.plans.embedding import embed_texts, run_metrics
from glyphvec.sinks.tables import embeddings_path, format_of, index_path, write_embeddings
from glyphvec.sources.vectors import read_vectors


def test_blank_texts_give_zero_rows():
    out = encode_texts(Seeded(), ["你好", "", "   ", None, "世界"], batch_size=4, normalize=True)
    assert out.dtype == np.float32 and out.shape == (5, 8)
    assert not out[1:4].any()
    assert np.allclose(np.linalg.norm(out[[0, 4]], axis=1), 1.0, atol=1e-4)


def test_batches_and_put_back():
    provider = Lengths()
    out = encode_texts(provider, ["hi", "", "  ", "world", "x"], batch_size=2, normalize=False)
    assert provider.calls == [["hi", "world"], ["x"]]
    assert out.tolist() == [[2, 3, 4, 5], [0] * 4, [0] * 4, [5, 6, 7, 8], [1, 2, 3, 4]]
    one = encode_texts(provider, ["abc"], batch_size=1, normalize=True)
    assert abs(np.linalg.norm(one[0]) - 1.0) < 1e-5
    assert encode_texts(provider, [], batch_size=2, normalize=True).shape == (0, 4)


def test_wrong_shape():
    class Wrong(Lengths):
        def encode(self, texts):
            return np.zeros((len(texts), 3))

    with pytest.raises(RuntimeError, match="shape"):
        encode_texts(Wrong(), ["a"], batch_size=1, normalize=False)


def test_retry():
    naps = []
    provider = RetryingProvider(Failing(7), (Busy,), max_retries=7, sleep=naps.append)
    assert len(provider.encode(["a"])) == 1 and provider.dim == 4
    assert naps == [2, 4, 8, 16, 32, 60, 60]
    naps.clear()
    with pytest.raises(Busy):
        RetryingProvider(Failing(3), (Busy,), max_retries=2, sleep=naps.append).encode(["a"])
    assert naps == [2, 4]
    with pytest.raises(KeyError):
        RetryingProvider(Failing(1, KeyError), (Busy,), sleep=naps.append).encode(["a"])


def test_hashing_provider():
    provider = HashingProvider(dim=16, max_words=1)
    out = provider.encode(["Red red, BLUE_sky 7", "!!"])
    want = np.zeros(16)
    for word in ("red", "red", "blue", "sky", "7"):
        want[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 16] += 1
    assert out[0].tolist() == want.tolist() and not out[1].any()


def texts(spark, rows):
    return spark.createDataFrame(rows, "video_id STRING, video_title STRING, n INT")


def test_embed_keeps_columns_and_cleans(spark):
    df = texts(spark, [("1", " a\nb ", 1), (None, None, 2), ("3", "x", None)])
    out = embed(df, HashingProvider, rules={}).orderBy("n").collect()
    assert [(r["video_id"], r["video_title"], r["n"]) for r in out] == [
        ("3", "x", None),
        ("1", "ab", 1),
        (None, "", 2),
    ]
    assert [len(r["embedding"]) for r in out] == [64] * 3 and not any(out[2]["embedding"])
    schema = embed(df, HashingProvider).schema["embedding"]
    assert not schema.dataType.containsNull


def test_embed_csv_to_parquet_and_vectors(spark, tmp_path):
    source = tmp_path / "sample.csv"
    titles = ["冬天穿搭推荐", "#搞笑 今日份快乐", "真的太香了！", "", "  ", "萌宠日常 🐶"]
    source.write_text(
        "video_id,video_title\n" + "".join(f'{i},"{t}"\n' for i, t in enumerate(titles)), encoding="utf-8"
    )
    tables = {}
    for fmt in ("parquet", "vectors"):
        out = str(tmp_path / f"out.{fmt}")
        run = embed_texts(spark, str(source), out, Lengths, fmt=fmt, partitions=3)
        assert (run["rows"], run["dim"]) == (6, 4) and run["seconds"] > 0
        assert tuple(run_metrics(spark, out).head()) == (6, 4)
        tables[fmt] = spark.read.parquet(out)
    assert tables["parquet"].columns == ["video_id", "video_title", "embedding"]
    assert tables["vectors"].columns == ["index_id", "embedding"]
    by_id = {r["video_id"]: r["embedding"] for r in tables["parquet"].collect()}
    assert all(by_id[str(r["index_id"])] == r["embedding"] for r in tables["vectors"].collect())
    assert [any(by_id[str(i)]) for i in range(6)] == [True, True, True, False, False, True]
    with pytest.raises(ValueError, match="format"):
        embed_texts(spark, str(source), "x", Lengths, fmt="npy")


def test_empty_input_still_writes_a_typed_table(spark, tmp_path):
    source, out = tmp_path / "e.tsv", str(tmp_path / "out")
    source.write_text("")
    assert embed_texts(spark, str(source), out, Lengths)["rows"] == 0
    assert spark.read.parquet(out).columns == ["video_id", "video_title", "embedding"]


def test_sink_checks(spark, tmp_path):
    df = embed(texts(spark, [("1", "a", 1)]), Lengths)
    with pytest.raises(PySparkException, match="dimension mismatch"):
        write_embeddings(df, str(tmp_path / "a"), dim=5)
    with pytest.raises(RuntimeError, match="expected 2, wrote 1"):
        write_embeddings(df, str(tmp_path / "b"), dim=4, total_rows=2)
    with pytest.raises(ValueError, match="format"):
        write_embeddings(df, str(tmp_path / "c"), dim=4, fmt="csv")
    assert format_of("a/b.parquet") == "parquet" and format_of("x.VECTORS") == "vectors"
    for path in ("a.npy", "a/b", "parquet"):
        with pytest.raises(ValueError, match="suffix"):
            format_of(path)


def test_vectors_come_out_in_order(spark, tmp_path):
    path = str(tmp_path / "v")
    df = spark.range(100).selectExpr("99 - id AS index_id", "array(float(99 - id)) AS embedding")
    write_embeddings(df.repartition(6), path, dim=1, fmt="vectors")
    back = read_vectors(spark, path)
    assert all(r["embedding"] == [r["index_id"]] for r in back.collect())
    from glyphvec.operators.ordinals import number_parquet_rows

    rows = number_parquet_rows(spark, path).collect()
    assert all(r["embedding"] == [r["index_id"]] for r in rows)


def test_default_paths(spark, tmp_path):
    path = embeddings_path(spark, "output/models", "acme/model-x", "/tmp/title_en.tsv")
    assert path == "output/models/model-x/embeddings/title_en.parquet"
    assert index_path(spark, "output/models", path) == "output/models/model-x/ann_index/title_en_index"
    named = embeddings_path(spark, "out/", "", "x.csv", dataset="my set", suffix=".vectors")
    assert named == "out/unknown-model/embeddings/my-set.vectors"
    folder = tmp_path / "texts.d"
    folder.mkdir()
    assert embeddings_path(spark, "o", "m", str(folder)) == "o/m/embeddings/texts.d.parquet"
    assert index_path(spark, "o", "a/b.parquet", model="x/y", dataset="d 1") == "o/y/ann_index/d-1_index"
    assert index_path(spark, "o", "a/b.parquet") == "o/unknown-model/ann_index/b_index"


def test_jobs_on_default_paths(spark, tmp_path):
    source, root = tmp_path / "title_en.tsv", str(tmp_path / "models")
    source.write_text("1\tone\n2\ttwo words\n")
    run = embed_texts(spark, str(source), "", Lengths, model="acme/model-x", output_root=root)
    assert run["output"] == f"{root}/model-x/embeddings/title_en.parquet"
    manifest = build_index(spark, run["output"], output_root=root)
    assert manifest["output_dir"] == f"{root}/model-x/ann_index/title_en_index"
    with pytest.raises(ValueError, match="index_dir"):
        build_index(spark, spark.read.parquet(run["output"]))


def test_stream(spark, tmp_path):
    from glyphvec.streaming.embedding import embed_stream, stream_tsv

    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    for n, body in enumerate(['1\t"a\n2\t\n', "3\tc\\d\n"]):
        (source / f"{n}.tsv").write_text(body)
        stream = stream_tsv(spark, str(source))
        embed_stream(stream, Lengths, out, state, rules={}, available_now=True).awaitTermination()
    rows = sorted((r["video_id"], r["video_title"], any(r["embedding"])) for r in spark.read.parquet(out).collect())
    assert rows == [("1", '"a', True), ("2", "", False), ("3", "c\\d", True)]
