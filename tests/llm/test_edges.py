"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for all operators."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from glyphvec.llm import jaccard, langid, packing, pii, quality, secretscan, sentencepieces, topk, toxicity, urlfilter

P = pytest.importorskip("public_tokenizers")
BPE, PIECES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")

PROSE = " ".join(f"the word{i} of a line{i * 7 % 31} is in it" for i in range(20))
LONG = " ".join(f"long{i} and the tail{i % 97}" for i in range(40_000))
CLASHES = "score DOUBLE, row INT, body STRING, spans STRING, stats INT, votes INT, ids INT, kept BOOLEAN, secrets INT"
SCHEMA = f"doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, {CLASHES}"


def _row(doc_id, text, lang="en"):
    return (doc_id, text, lang, None, None, 0.5, 1, "b", "s", 2, 3, 4, True, 5)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        _row(1, PROSE), _row(2, PROSE), _row(2, PROSE), _row(3, ""), _row(4, None), _row(None, PROSE),
        _row(5, " \t\n"), _row(6, LONG), _row(7, "mail a@b.example and 10.1.2.3", None), _row(8, "\0▁\U0001f642 ﬁ", "xx"),
        _row(None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_language(docs, empty):
    model = langid.fit(docs)
    found = langid.identify(docs, model)
    rows = _by_id(found)
    assert found.count() == 11 and rows[3]["lang_pred"] == rows[4]["lang_pred"] == "und"
    assert rows[1]["lang_pred"] == "en" and 0 <= rows[1]["score"] <= 1
    assert found.columns == [*docs.columns, "lang_pred"]
    nothing = langid.fit(empty)
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(empty, model).count() == 0


def test_quality(docs, empty):
    found = docs.select("doc_id", quality.statistics(F.col("text")).alias("stats"))
    rows = _by_id(found)
    assert rows[3]["stats"] == rows[4]["stats"] and set(rows[4]["stats"]) == {0}
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, None}  # 6 repeats itself
    assert quality.filter_quality(empty).count() == 0


def test_near_duplicates(docs, empty):
    rows = jaccard.similar(docs).collect()
    assert len(rows) == 11
    assert {r["class_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert {(r["class_id"], r["n_links"]) for r in rows if r["doc_id"] is None} == {(None, 0)}
    assert {r["class_id"] for r in rows if r["doc_id"] in (3, 4, 5)} == {3, 4, 5}
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8]
    assert jaccard.similar(empty).count() == 0


def test_private(docs, empty):
    found = pii.pseudonymise(docs, b"k")
    rows = _by_id(found)
    assert found.columns == [*docs.columns, "n_entities"] and found.count() == 11
    assert rows[4]["text"] is None and rows[3]["text"] == "" and rows[6]["text"] == LONG
    assert rows[7]["n_entities"] == 2 and "a@b" not in rows[7]["text"] and "10.1.2.3" not in rows[7]["text"]
    assert pii.pseudonymise(empty, b"k").count() == 0


def test_packing(docs, empty):
    rows = packing.pack(packing.pieces(docs, BPE)).collect()
    assert sum(r["doc_id"] == 2 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) == 2
    assert [r["length"] for r in rows if r["doc_id"] == 4] == [1]
    assert max(r["length"] for r in rows) == 2048
    assert packing.pack(packing.pieces(empty, BPE)).count() == 0


def test_secrets(docs, empty):
    found = secretscan.scan(docs)
    assert found.count() == 11 and sorted(found.columns) == sorted(docs.columns)
    assert all(not r["secrets"] for r in found.collect())
    assert secretscan.scan(empty).count() == 0


def test_sentencepieces(docs, empty):
    found = sentencepieces.decode(sentencepieces.encode(docs, PIECES), PIECES)
    rows = _by_id(found)
    assert rows[4]["ids"] is None and rows[4]["decoded"] is None and rows[3]["ids"] == []
    assert rows[6]["decoded"] == LONG and all(r["parity"] for r in found.collect())
    assert sentencepieces.encode(empty, PIECES).count() == 0


def test_toxicity(spark, docs, empty):
    labels = spark.createDataFrame([(1, 0), (7, 1), (7, 0), (None, 1), (3, None)], "doc_id BIGINT, toxic INT")
    for model in (toxicity.fit(docs, labels), toxicity.fit(empty, labels), toxicity.fit(docs, labels.limit(0))):
        found = toxicity.score(docs, model)
        assert found.count() == 11
        assert all(0 <= r["score"] <= 1 for r in found.collect())
    assert _by_id(found)[4]["score"] == _by_id(found)[3]["score"]


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (None, [1.0, 0.0]), (6, []), (7, [1.0]), (8, [0.5, 0.5]), (100, [1e30, 1.0])]
    table = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    vectors = topk.clean(table)
    found = topk.search(vectors, vectors.filter("vec_id % 100 = 0"), k=3).collect()
    best = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == 0)
    assert best == [(1, 100), (2, 1), (3, 1)]
    assert topk.search(vectors, vectors.limit(0)).count() == 0
    assert topk.search(vectors.limit(0), vectors).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.b.example/x/y?q=1"), (1, "http://a.b.example/x/y?q=1"), (None, "http://a.b.example/x"), (2, None),
         (3, "no url"), (4, "http://c.example")],
        "page_id BIGINT, url STRING",
    )
    captures = pages.withColumns({"fetched_at": F.lit(10), "lists": F.lit("old")})
    entries = spark.createDataFrame(
        [("l", "b.example", "add", 5), ("l", "b.example", "remove", 20), ("m", "a.b.example/x", "add", 10),
         (None, "c.example", "add", 1), ("l", "c.example", None, 1), ("l", "c.example", "add", None)],
        "list STRING, key STRING, action STRING, at INT",
    )
    found = urlfilter.judge(captures, entries).collect()
    assert sorted((r["page_id"] or 0, r["blocked"], tuple(r["lists"])) for r in found) == [
        (0, True, ("l", "m")), (1, True, ("l", "m")), (1, True, ("l", "m")), (2, False, ()), (3, False, ()), (4, False, ()),
    ]
    assert not any(r["blocked"] for r in urlfilter.judge(captures, entries.limit(0)).collect())
    assert urlfilter.judge(captures.limit(0), entries).count() == 0


def test_deep_urls(spark):
    url = "http://a.b.c.d.e.f.g.h.i.j.example/1/2/3/4/5/6//7?q=/8"
    captures = spark.createDataFrame([(1, url, 10), (2, "http://x.example/1/2", 10)], "page_id INT, url STRING, fetched_at INT")
    for key in ("a.b.c.d.e.f.g.h.i.j.example/1/2/3/4/5", "a.b.c.d.e.f.g.h.i.j.example/1/2/3/4/5/6/7", "b.c.d.e.f.g.h.i.j.example"):
        entries = spark.createDataFrame([("l", key, "add", 5)], "list STRING, key STRING, action STRING, at INT")
        found = _by_page(urlfilter.judge(captures, entries))
        assert found[1]["blocked"] and found[1]["n_active"] == 1 and not found[2]["blocked"], key


def test_spellings_of_entries(spark):
    urls = ["http://Example.com:8080/x", "http://[2001:db8::1]/x", "http://www.example.com/Ads/b?c"]
    captures = spark.createDataFrame([(i, u, 10) for i, u in enumerate(urls)], "page_id INT, url STRING, fetched_at INT")
    for key, blocked in (
        ("Example.COM.", {0, 2}), (".example.com", {0, 2}), ("https://example.com/x/", {0}), ("//www.example.com", {2}),
        ("www.example.com//Ads/", {2}), ("www.example.com/ads", set()), ("[2001:DB8::1]", {1}), ("[2001:db8::1]:80/x#y", {1}),
        (" example.com/x?q=1", {0}), ("", set()), ("/x", set()), ("db8::1]", set()),
    ):
        entries = spark.createDataFrame([("l", key, "add", 5)], "list STRING, key STRING, action STRING, at INT")
        found = _by_page(urlfilter.judge(captures, entries))
        assert {i for i, row in found.items() if row["blocked"]} == blocked, key


def test_hot_hosts_in_parts(spark):
    rows = [(i, f"http://hot.example/{i % 7}/{i}", i % 30) for i in range(300)] + [(i, f"http://h{i}.example/", 5) for i in range(300, 330)]
    captures = spark.createDataFrame(rows, "page_id INT, url STRING, fetched_at INT")
    entries = spark.createDataFrame(
        [("l", "hot.example", "add", 5), ("l", "hot.example", "remove", 9), ("m", "hot.example/3", "add", 7), ("m", "h301.example", "add", 1)],
        "list STRING, key STRING, action STRING, at INT",
    )
    valid = urlfilter.intervals(entries)
    hot = {r["key"]: r["parts"] for r in urlfilter.hot_keys(captures, valid, 20).collect()}
    assert hot == {"hot.example": 15, "hot.example/3": 3}
    whole = sorted(map(tuple, urlfilter.judge(captures, entries).collect()))
    assert sorted(map(tuple, urlfilter.judge(captures, entries, 20).collect())) == whole
    expected = {i: ["l"] * (5 <= t < 9) + ["m"] * (i % 7 == 3 and t >= 7) for i, _, t in rows[:300]}
    assert {r[0]: r[4] for r in whole if r[0] < 300} == expected


def _by_page(df):
    return {r["page_id"]: r for r in df.collect()}


def test_stages_keep_columns(spark, docs, empty):
    for source in (docs, empty):
        left = source
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, left, "")
            assert left.columns == source.columns, name
