import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glyphvec.functions import text as X
from glyphvec.functions.slugs import dataset_slug, model_slug, model_slug_from_path, slug

OFF = {k: False for k, v in X.DEFAULT_RULES.items() if v is True}


def only(**rules):
    return {**OFF, **rules}


@pytest.mark.parametrize(
    "given_text, rules, expected",
    [
        (None, {}, ""),
        ("ﬁ①", {}, "fi1"),
        ("é", {}, "é"),
        ("a\nb\tc‍d­e", {}, "abcde"),
        ("  x　 ", {}, "x"),
        ("see https://a.com/x?y and WWW.b.org now", {}, "see and now"),
        ("http:/no https//no", {}, "http:/no https//no"),
        ("@bob hi", {}, "@bob hi"),
        ("@bob hi @", {"remove_mentions": True}, "hi @"),
        ("#搞笑 今日 # x", {"remove_hashtags": True}, "今日 # x"),
        ("a🐶🐶b☀c", {"remove_emojis": True}, "a b c"),
        ("ABC É", {"lowercase_latin": True}, "abc é"),
        ("   abcdef", {"max_length": 3}, "abc"),
        ("abc", {"max_length": -1}, "abc"),
        ("🐶🐶🐶", {"max_length": 2}, "🐶🐶"),
        ("a  b\n\nc", only(collapse_whitespace=True), "a b c"),
        (" a ", only(strip=True), "a"),
        ("a\nb", only(remove_control_chars=True), "ab"),
    ],
)
def test_cleaning_rules(values, given_text, rules, expected):
    assert values([given_text], lambda c: X.clean_text(c, rules)) == [expected]


def test_literal_patterns_only_match_backslashes(values):
    texts = ["https://a.com/x @bob #tag  two", r"a\ss b", r"https://\SSx", r"@\www y", r"#\w"]
    rules = {"remove_mentions": True, "remove_hashtags": True}
    got = values(texts, lambda c: X.clean_text(c, rules, "literal"))
    assert got == ["https://a.com/x @bob #tag  two", "a  b", "x", "y", ""]
    with pytest.raises(ValueError):
        X.clean_text(None, patterns="other")


def test_whitespace_set_is_that_of_python(values):
    points = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000]
    blank = values(points, X.strip)
    assert [p for p, b in zip(points, blank) if b == ""] == [p for p in points if p.isspace()]
    assert sorted(X.WHITESPACE_CHARS) == [p for p in points if p.isspace()]
    kept = values([f"a{p}b" for p in points], X.single_line)
    for p, out in zip(points, kept):
        assert out == re.sub(r"\s+", " ", f"a{p}b")


def test_controls_are_those_of_python(values):
    points = [chr(i) for i in range(0x14000) if not 0xD800 <= i < 0xE000]
    out = values(points, lambda c: X.clean_text(c, only(remove_control_chars=True)))
    gone = {p for p, o in zip(points, out) if o == ""}
    assert gone == {p for p in points if unicodedata.category(p) in ("Cc", "Cf")}


def test_emoji_ranges(values):
    blocks = [(0x1F300, 0x1F64F), (0x1F680, 0x1FAFF), (0x2600, 0x27BF)]
    points = list(range(0x2500, 0x2900)) + list(range(0x1F200, 0x1FC00))
    out = values([chr(p) for p in points], lambda c: X.clean_text(c, only(remove_emojis=True)))
    gone = {p for p, o in zip(points, out) if o == " "}
    assert gone == {p for p in points if any(lo <= p <= hi for lo, hi in blocks)}


def test_nfkc_on_every_character_and_on_pairs(values):
    points = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    assert values(points, X.nfkc) == [unicodedata.normalize("NFKC", p) for p in points]
    marks = ["́", "゙", "̈", "ᅡ", "ᆨ"]
    pairs = [p + m for p in "eouかカガ가ᄀАЕα" for m in marks]
    assert values(pairs, X.nfkc) == [unicodedata.normalize("NFKC", p) for p in pairs]


def test_nfkc_on_all_planes_without_python(spark, values):
    points = [chr(i) for i in range(0x10000, 0x30000)]
    points = [p for p in points if unicodedata.category(p) != "Cn"]
    assert values(points, X.nfkc) == [unicodedata.normalize("NFKC", p) for p in points]
    marks = [chr(i) for i in range(0x300, 0x370)] + ["゙", "゚", "\u0327", "\u1161", "\u11a8"]
    rows = [f"{a}{m}{n}" for a in "eoカ가ᄀﬁ①½㌀" for m in marks for n in marks[::9]]
    assert values(rows, X.nfkc) == [unicodedata.normalize("NFKC", r) for r in rows]
    assert values([None, "", "ﬁ"], X.nfkc) == [None, "", "fi"]
    plan = spark.range(1).select(X.clean_text(F.col("id").cast("string")))._jdf.queryExecution().toString()
    assert "Python" not in plan


@settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(st.text(st.characters(exclude_categories=("Cs", "Cn")), max_size=30), min_size=50, max_size=100))
def test_cleaning_twice_changes_nothing(values, texts):
    plain = only(collapse_whitespace=True, strip=True, normalize_unicode_nfkc=True)
    once = values(texts, lambda c: X.clean_text(c, plain))
    assert values(once, lambda c: X.clean_text(c, plain)) == once
    stripped = [re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t)).strip() for t in texts]
    assert once == stripped


def test_non_empty(values):
    texts = ["a", "", "  ", None, "　\t", " x "]
    assert values(texts, X.non_empty) == [True, False, False, False, False, True]


def test_file_names(values):
    paths = ["/d/1.txt", "d/a.b.TXT", "x", ".txt", "..txt", "a..txt", "s3://b/c.d/e"]
    assert values(paths, X.file_stem) == ["1", "a.b", "x", ".txt", "..txt", "a.", "e"]


def test_slugs(values):
    texts = ["a b/c", "  --x..", "!!", None, "ok_1.2-3", "é"]
    assert values(texts, slug) == ["a-b-c", "x", "unknown", "unknown", "ok_1.2-3", "unknown"]
    models = ["acme/model-x", "acme\\m\\", "", None, "  ", "/p/My Model/ ", "!!"]
    assert values(models, model_slug) == [
        "model-x",
        "m",
        "unknown-model",
        "unknown-model",
        "unknown-model",
        "My-Model",
        "unknown",
    ]
    files = ["/tmp/title_en.tsv", "dir/a.b.csv", ".tsv", "", "x/"]
    assert values(files, dataset_slug) == ["title_en", "a.b", "tsv", "dataset", "x"]
    assert values(["/tmp/texts.d/"], lambda c: dataset_slug(c, True)) == ["texts.d"]
    paths = ["output/models/m 1/embeddings/t.parquet", "models", "a/b", None, "x/models/models/y"]
    assert values(paths, model_slug_from_path) == [
        "m-1",
        "unknown-model",
        "unknown-model",
        "unknown-model",
        "models",
    ]


def test_labels(values):
    from pyspark.sql import functions as F

    assert values(["7"], lambda c: X.media_url(c, "http://h/p")) == ["http://h/p/7.mp4"]
    assert values(["t", ""], lambda c: X.item_label(F.lit("9"), c)) == ["9  (t)", "9"]


