"""Tables and texts in folders of many files."""

import hashlib
import os

from checks import texts
from glyphvec.plans.prepare import merged_texts
from glyphvec.sources.texts import count_records, read_text_folder


def test_streamed_table_of_several_files(spark, tmp_path):
    rows = [(i, f"text  {i}", "en", "web", 7) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = texts.streamed_embedding(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == [(i, f"text {i}", 64) for i in range(30)]


def test_large_folder(spark, tmp_path):
    """Names do not come to Python one by one, and tasks take many small files each."""
    for i in range(300):
        (tmp_path / f"{i}.txt").write_text(f"text {i}" if i % 100 else "")
    for name in ("_a.txt", ".b.TXT", "_c.csv"):
        (tmp_path / name).write_text("hidden")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    calls, send = [], type(spark.sparkContext._gateway._gateway_client).send_command
    client = spark.sparkContext._gateway._gateway_client
    client.send_command = lambda command, *a, **b: calls.append(1) or send(client, command, *a, **b)
    try:
        df = read_text_folder(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() < 300
        assert len(calls) < 1500
    finally:
        del client.send_command
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = {r["video_id"]: r["video_title"] for r in df.collect()}
    assert rows == {str(i): f"text {i}" if i % 100 else "" for i in range(300)} | {"_a": "hidden", ".b": "hidden"}


def above_reading(df):
    """The optimised plan from the result down to where files are read."""
    head, read, _ = df._jdf.queryExecution().optimizedPlan().toString().partition("MapInArrow")
    assert read
    return head


def small_folder(tmp_path, n=60):
    for i in range(n):
        (tmp_path / f"{i}.txt").write_text(f"text {i}")
    return str(tmp_path)


def test_names_are_ranked_before_files_are_read(spark, tmp_path):
    df = read_text_folder(spark, small_folder(tmp_path), ordered=True)
    assert "Join" not in above_reading(df) and len(df.inputFiles()) < 60
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(i, str(i), f"text {i}") for i in range(60)]


def test_names_are_sorted_before_files_are_read(spark, tmp_path):
    df = merged_texts(spark, small_folder(tmp_path))
    assert "Sort" not in above_reading(df) and len(df.inputFiles()) < 60
    assert [tuple(r) for r in df.collect()] == [(str(i), f"text {i}") for i in range(60)]
    assert [r[0] for r in merged_texts(spark, str(tmp_path), limit=7).collect()] == [str(i) for i in range(7)]


def test_driver_does_not_hold_the_names(spark, tmp_path):
    df = read_text_folder(spark, small_folder(tmp_path))
    assert len(df.inputFiles()) < 60
    assert sorted(tuple(r) for r in df.collect()) == sorted((str(i), f"text {i}") for i in range(60))


def test_batches_are_cut_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("glyphvec.sources.texts.BYTES_PER_TASK", 1 << 40)
    monkeypatch.setattr("glyphvec.sources.texts.NAMES_PER_BATCH", 7)
    sizes = {str(i): i * 150_000 for i in range(40)}
    for name, size in sizes.items():
        (tmp_path / f"{name}.txt").write_text("x" * size)
    rows = read_text_folder(spark, str(tmp_path)).collect()
    assert {r["video_id"]: len(r["video_title"]) for r in rows} == sizes


def test_odd_names(spark, tmp_path):
    folder = os.fsencode(tmp_path / "a %41+b")
    os.mkdir(folder)
    names = [b"a%41", b"a+b", b"a b", "ü".encode(), b"bad \xff", b"_x=1", b"q?*[1]", b"c:d,e"]
    for name in names:
        with open(folder + b"/" + name + b".txt", "wb") as out:
            out.write(name)
    os.symlink(b"a b.txt", folder + b"/link.txt")
    os.symlink(b"nothing.txt", folder + b"/dangling.txt")
    os.mkdir(folder + b"/folder.txt")
    want = sorted([(t := n.decode(errors="replace"), t) for n in names] + [("link", "a b")])
    path = os.fsdecode(folder)
    assert sorted(tuple(r) for r in read_text_folder(spark, path).collect()) == want
    assert sorted(tuple(r)[1:] for r in read_text_folder(spark, path, ordered=True).collect()) == want
    assert sorted(tuple(r) for r in merged_texts(spark, path).collect()) == want
    assert count_records(spark, path) == len(want)


def test_folder_without_texts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("no")
    for ordered in (False, True):
        assert read_text_folder(spark, str(tmp_path), ordered=ordered).collect() == []
    assert merged_texts(spark, str(tmp_path)).collect() == []


ODD_ROWS = [(-5, "a\r\nb\n\n"), (None, "none"), (7, ""), (2**63 - 1, "last"), (-(2**63), "first"), (7, None), (30, "ü"), (4, "x")]


def as_documents(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_a_file_for_each_document(spark, tmp_path):
    rows = ODD_ROWS + [(100 + i, f"text {i}") for i in range(50)]
    sf_dir = as_documents(spark, tmp_path, rows)
    path = texts.one_file_per_document(spark, sf_dir).removeprefix("file:")
    assert len([n for n in os.listdir(path) if n.endswith(".txt")]) == len(rows)
    assert not [n for n in os.listdir(path) if n.endswith(".crc")]
    found = sorted(tuple(r) for r in texts.text_folder_ordered(spark, sf_dir).collect())
    texts_in_order = ["none", "first", "a\nb", "x", "", "", "ü", *(f"text {i}" for i in range(50)), "last"]
    digests = [hashlib.md5(t.encode()).hexdigest() for t in texts_in_order]
    assert found == [(i, len(rows), d) for i, d in enumerate(digests)]
    assert sorted(r["digest"] for r in texts.text_folder(spark, sf_dir).collect()) == sorted(digests)
    assert texts.merged_folder(spark, sf_dir).count() == len(rows)


def test_store_that_only_spark_reaches(spark, tmp_path, monkeypatch):
    """There Spark's own scan and writer do the same."""
    mount = "fs.viewfs.mounttable.folders.link./in"
    spark.sparkContext._jsc.hadoopConfiguration().set(mount, f"file://{tmp_path}")
    small_folder(tmp_path, 12)
    rows = [(i, f"text {i}") for i in range(12)]
    folder = "viewfs://folders/in"
    assert [tuple(r) for r in merged_texts(spark, folder).collect()] == [(str(i), t) for i, t in rows]
    found = read_text_folder(spark, folder, ordered=True).collect()
    assert sorted(tuple(r) for r in found) == [(i, str(i), t) for i, t in rows]
    sf_dir = as_documents(spark, tmp_path, rows)
    monkeypatch.setattr(texts, "work_path", lambda spark, label: f"{folder}/{label}")
    found = sorted(tuple(r) for r in texts.text_folder_ordered(spark, sf_dir).collect())
    assert found == [(i, 12, hashlib.md5(t.encode()).hexdigest()) for i, t in rows]
