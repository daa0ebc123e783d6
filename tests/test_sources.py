import json

import numpy as np
import pytest
from pyspark.errors import PySparkException

from glyphvec.plans.prepare import merge_texts, merged_texts
from glyphvec.sources.texts import count_records, read_tabular, read_text_folder, read_texts
from glyphvec.sources.vectors import query_vector, read_vectors, vector_dim


def put(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode("utf-8"))
    return str(path)


def records(df):
    rows = df.orderBy("index_id").collect()
    return [(r["video_id"], r["video_title"]) for r in rows]


def test_headerless_tsv(spark, tmp_path):
    path = put(tmp_path / "title_en.tsv", "1\tFirst title\n2\tSecond title\n3\t\n")
    want = [("1", "First title"), ("2", "Second title"), ("3", "")]
    assert records(read_texts(spark, path, ordered=True)) == want
    assert count_records(spark, path) == 3


def test_headered_tsv(spark, tmp_path):
    path = put(tmp_path / "combo.tsv", "video_id\tvideo_title\n14_163_1256\t教育 > 职业教育 > 产品与运营\n")
    assert records(read_texts(spark, path, ordered=True)) == [("14_163_1256", "教育 > 职业教育 > 产品与运营")]


def test_headered_csv(spark, tmp_path):
    body = 'video_id,video_title\n1,冬天穿搭推荐\n2,"a, ""b"""\n3,\n4,"  "\n5,🐶\n'
    path = put(tmp_path / "t.csv", "﻿" + body)
    want = [("1", "冬天穿搭推荐"), ("2", 'a, "b"'), ("3", ""), ("4", "  "), ("5", "🐶")]
    assert records(read_texts(spark, path, ordered=True)) == want
    assert count_records(spark, path) == 5


def test_csv_without_ids_and_with_columns_in_between(spark, tmp_path):
    df = read_texts(spark, put(tmp_path / "t.csv", "x,video_title,y\n1,a,2\n"))
    assert df.columns == ["video_title"] and df.head()[0] == "a"


def test_missing_title_column(spark, tmp_path):
    with pytest.raises(ValueError, match="video_title"):
        read_texts(spark, put(tmp_path / "t.csv", "a,b\n1,2\n"))


def test_dirty_tsv(spark, tmp_path):
    path = put(tmp_path / "t.txt", "\n001\tx\textra\n   \nshort\n2\t007\n3\tsay \"\"hi\"\"\n")
    got = records(read_texts(spark, path, ordered=True))
    assert got == [("001", "x"), ("short", ""), ("2", "007"), ("3", 'say ""hi""')]


def test_unmatched_quote_with_quoting_off(spark, tmp_path):
    path = put(tmp_path / "t.tsv", '1\t"open\n2\tback\\slash\n')
    assert records(read_tabular(spark, path, quote="", ordered=True)) == [("1", '"open'), ("2", "back\\slash")]


def test_one_column_tsv_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="two columns"):
        read_texts(spark, put(tmp_path / "t.tsv", "only\nonly\n"))


def test_surplus_field_in_headered_file_is_an_error(spark, tmp_path):
    path = put(tmp_path / "t.csv", "video_id,video_title\n1,a\n2,b,c\n3\n")
    with pytest.raises(PySparkException, match="more than 2 fields"):
        read_texts(spark, path).collect()


def test_empty_files(spark, tmp_path):
    for name in ("e.tsv", "e.csv", "e.txt"):
        df = read_texts(spark, put(tmp_path / name, ""))
        assert df.columns == ["video_id", "video_title"] and df.count() == 0


def test_quoted_line_breaks(spark, tmp_path):
    path = put(tmp_path / "t.csv", 'video_id,video_title\n1,"a\nb"\n2,c\n')
    assert records(read_tabular(spark, path, multi_line=True, ordered=True)) == [("1", "a\nb"), ("2", "c")]


@pytest.mark.parametrize("per_core", [0, 1 << 29])
def test_order_over_many_files_and_splits(spark, tmp_path, monkeypatch, per_core):
    import glyphvec.operators.ordinals as ordinals

    monkeypatch.setattr(ordinals, "FIXED_SPLIT_BYTES_PER_CORE", per_core)
    for part in range(12):
        lines = "".join(f"{part * 500 + i}\ttext {i}\n" for i in range(500))
        put(tmp_path / f"part-{part}.tsv", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = read_tabular(spark, str(tmp_path), sep="\t", ordered=True)
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 6000
    assert all(r["index_id"] == int(r["video_id"]) for r in rows)


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "texts"
    (path / "sub").mkdir(parents=True)
    (path / "k=1").mkdir()
    put(path / "10.txt", "ten\r\nlines\r\n\r\n")
    put(path / "2.txt", " two\ttabs ")
    put(path / "1.txt", b"bad \xff byte\n")
    put(path / "b.TXT", "")
    put(path / "c.csv", "no")
    put(path / "sub" / "3.txt", "no")
    put(path / "k=1" / "4.txt", "no")
    return str(path)


def test_text_folder(spark, folder):
    want = [("1", "bad � byte"), ("2", " two\ttabs "), ("10", "ten\nlines"), ("b", "")]
    assert records(read_texts(spark, folder, ordered=True)) == want
    assert count_records(spark, folder) == 4
    assert {r[0] for r in read_text_folder(spark, folder).collect()} == {"1", "2", "10", "b"}


def test_merge(spark, folder, tmp_path):
    out = str(tmp_path / "merged")
    merge_texts(spark, folder, out)
    back = read_tabular(spark, out, sep="\t", quote="", ordered=True)
    want = [("1", "bad � byte"), ("2", "two tabs"), ("10", "ten lines"), ("b", "")]
    assert records(back) == want
    first = [tuple(r) for r in merged_texts(spark, folder, limit=2).collect()]
    assert first == want[:2]
    assert len(merged_texts(spark, folder, limit=99).collect()) == 4


@pytest.fixture
def vector_table(spark, tmp_path):
    rows = [("t1", [1.0, 0.0], "v1"), ("t2", [0.0, 1.0], "v2"), ("t3", [0.8, 0.2], "v3")]
    path = str(tmp_path / "emb.parquet")
    schema = "video_title STRING, embedding ARRAY<FLOAT>, video_id STRING"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return path


def test_query_vectors(spark, vector_table, tmp_path):
    def only(**source):
        return query_vector(spark, **source).head()["embedding"]

    assert only(table=vector_table, index_id=1) == [0.0, 1.0]
    assert only(literal="[1, 2.5]", table=vector_table, index_id=0) == [1.0, 2.5]
    assert only(file=put(tmp_path / "v.json", json.dumps([3, 4]))) == [3.0, 4.0]
    np.save(tmp_path / "v.npy", np.array([5.0, 6.0], dtype=np.float32))
    assert only(file=str(tmp_path / "v.npy")) == [5.0, 6.0]
    with pytest.raises(ValueError, match="out of range"):
        only(table=vector_table, index_id=99)
    with pytest.raises(ValueError):
        only(table=vector_table)
    with pytest.raises(ValueError):
        only()
    with pytest.raises(ValueError, match="empty"):
        only(file=put(tmp_path / "e.json", " "))


def test_vector_table(spark, vector_table):
    df = read_vectors(spark, vector_table)
    assert vector_dim(df) == 2
    assert [r["index_id"] for r in df.orderBy("video_id").collect()] == [0, 1, 2]
    with pytest.raises(ValueError, match="missing embedding column"):
        read_vectors(spark, vector_table, embedding_col="other")
    with pytest.raises(ValueError, match="empty"):
        vector_dim(df.filter("index_id < 0"))


def test_quoted_line_breaks_by_default(spark, tmp_path):
    (tmp_path / "a.csv").write_text('video_id,video_title\n1,"a\nb"\n2,c\n')
    got = [(r["video_id"], r["video_title"]) for r in read_tabular(spark, str(tmp_path / "a.csv")).collect()]
    assert sorted(got) == [("1", "a\nb"), ("2", "c")]
    (tmp_path / "b.csv").write_text('video_id,video_title\n1,"say ""hi"", now"\n2,c\n')
    got = [(r["video_id"], r["video_title"]) for r in read_tabular(spark, str(tmp_path / "b.csv")).collect()]
    assert sorted(got) == [("1", 'say "hi", now'), ("2", "c")]


def test_names_that_begin_with_a_dot_or_underscore(spark, tmp_path):
    for name in ("1.txt", "_2.txt", ".3.txt", "10.txt"):
        (tmp_path / name).write_text(f"text of {name}")
    (tmp_path / "_4.txt").write_text("")
    folder = str(tmp_path)
    assert count_records(spark, folder) == 5
    rows = read_text_folder(spark, folder, ordered=True).orderBy("index_id").collect()
    assert {r["video_id"]: r["video_title"] for r in rows} == {
        "1": "text of 1.txt", "_2": "text of _2.txt", ".3": "text of .3.txt", "10": "text of 10.txt", "_4": "",
    }
    merged = [r["video_id"] for r in merged_texts(spark, folder, limit=3).collect()]
    assert merged == ["1", "10", ".3"]
