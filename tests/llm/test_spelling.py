"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from glyphvec.llm import spelling


def _words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1 :]
            if len(low) >= 7:
                counts[low] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len, reverse=True)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def _brute(words):
    rows = {}
    for w, n in words.items():
        near = [v for v in words if _near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        rows[w] = [n, len(near), form, words[form] if form else None]
    found = set()
    for w, (n, n_near, form, form_n) in rows.items():
        root = w
        while rows[root][2]:
            root = rows[root][2]
        found.add((w, n, n_near, form, form_n, root))
    return found


def _variants(spark, words):
    df = spark.createDataFrame(list(words.items()), "word STRING, n BIGINT")
    rows = spelling.variants(df).collect()
    assert len(rows) == len(words)
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def _similar_words(count, alphabet="abé", seed=1):
    rng, words = random.Random(seed), {}
    while len(words) < count:
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(7, 10)))
        words[w] = rng.choice([2, 3, 20, 30, 400, 4000, 100000])
    return words


def test_dense_vocabulary(spark):
    words = _similar_words(700)
    assert _variants(spark, words) == _brute(words)


def test_blocks_of_large_groups(spark, monkeypatch):
    words = _similar_words(500, "ab", 2)
    monkeypatch.setattr(spelling, "GROUP", 6)
    monkeypatch.setattr(spelling, "TASK_BYTES", 20_000)
    assert _variants(spark, words) == _brute(words)


def test_tiles_smaller_than_groups(monkeypatch):
    import numpy as np
    import pyarrow as pa

    words = _similar_words(400, "ab", 3)
    own = [w for w in words if len(w) in (8, 9)]
    row = {
        "word": own, "n": [words[w] for w in own], "longest": [9] * len(own), "zone": [2] * len(own),
        "key": [5] * len(own), "low": [0] * len(own), "high": [0] * len(own), "side": [0] * len(own),
    }
    whole = spelling._compare(pa.table(row)).to_pylist()
    monkeypatch.setattr(spelling, "CELLS", 100)
    assert spelling._compare(pa.table(row)).to_pylist() == whole
    assert np.sum([r["n_near"] for r in whole]) > 0


def test_chains_and_ties(spark):
    words = {"aaaaaaaaaa": 2, "aaaaaaaaab": 30, "aaaaaaaabb": 400, "aaaaaaabbb": 5000, "aaaaaabbbb": 60000,
             "aaaaabbbbb": 700000, "éaaaaaaaaa": 30, "zaaaaaaaaa": 30, "solitary": 2}
    found = _variants(spark, words)
    assert found == _brute(words)
    by_word = {r[0]: r for r in found}
    assert by_word["aaaaaaaaaa"][3] == "aaaaaaaaab"  # ties go to the smallest
    assert by_word["aaaaaaaaaa"][5] == "aaaaabbbbb"
    assert by_word["solitary"] == ("solitary", 2, 0, None, None, "solitary")


def test_very_long_words(spark):
    base = "ab" * 30_000
    words = {base: 50, base[:-1]: 2, base[:20_000] + "z" + base[20_001:]: 3, "x" + base: 4, base + "zz": 2}
    assert _variants(spark, words) == _brute(words)


def test_runs_and_counts(spark):
    rng = random.Random(4)
    vocabulary = ["Weather", "weather", "wetherés", "Éclairsé", "umbrella", "umbrellas", "a1b2c3d4", "shorter"]
    docs = [(i, " ".join(rng.choice(vocabulary) + rng.choice(["", "-", "_x", "\n"]) for _ in range(40))) for i in range(200)]
    docs += [(None, "umbrellas umbrellas"), (7, None), (8, ""), (9, "1234567 ____"), (5, "weather weather"), (5, "weather")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id BIGINT, text STRING, word STRING, n INT")
    found = spelling.variants(spelling.vocabulary(spelling.runs(df.repartition(4))))
    expected = _words(docs)
    assert any(len(w) == 7 and w not in {"weather", "shorter"} for w in expected)
    assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found.collect()} == _brute(expected)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "abc")]])
def test_no_words(spark, rows):
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert spelling.variants(spelling.vocabulary(spelling.runs(df))).collect() == []
