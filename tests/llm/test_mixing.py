"""Source mixing against targets worked out by hand and plain repetition."""

import random
from collections import Counter
from fractions import Fraction

import pytest

from glyphvec.llm import mixing


def _targets(sizes, weights=(5, 2, 1), budget=Fraction(3, 2), most=2):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, held = budget * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in held)
        open_weight = sum(weight[s] for s in order if s not in held)
        share = {s: most * sizes[s] if s in held else rest * weight[s] / open_weight for s in order}
        above = {s for s in order if s not in held and share[s] > most * sizes[s]}
        if not above:
            return share
        held |= above
        if len(held) == len(order):
            return {s: most * sizes[s] for s in order}


def _docs(sources, seed=3):
    rng = random.Random(seed)
    rows = []
    for source, count in sources.items():
        for _ in range(count):
            rows.append((len(rows), " ".join(["w"] * int(rng.lognormvariate(3, 1))), source))
    rng.shuffle(rows)
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "doc_id BIGINT, text STRING, source STRING, size STRING, mix_own INT"
    ).repartition(5)


@pytest.mark.parametrize(
    "sources",
    [
        {"a": 300, "b": 300, "c": 300, None: 100},
        {"hot": 2000, "é": 50, "b": 60, "Z": 70, "d": 1, "e": 400, None: 30},
        {"only": 40},
        {None: 25},
    ],
)
def test_targets_and_copies(spark, sources):
    rows = _docs(sources)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    expected = _targets(sizes)
    source_of = {r[0]: r[2] for r in rows}
    found = mixing.plan(_frame(spark, rows)).collect()
    assert len(found) == len(rows)
    taken = Counter()
    for r in found:
        source = source_of[r.doc_id]
        assert r.size == len(rows_text(rows)[r.doc_id].split())
        assert r.source_size == sizes[source]
        assert abs(r.target - float(expected[source])) <= 1e-9 * max(1, r.target)
        rate = expected[source] / sizes[source] if sizes[source] else 0
        assert r.copies in (rate.__floor__(), rate.__ceil__()) and r.copies <= 2
        taken[source] += r.size * r.copies
    for source, target in expected.items():
        if sources[source] >= 50:
            assert abs(taken[source] - target) <= 0.05 * target
    again = mixing.plan(_frame(spark, rows[::-1])).collect()
    assert sorted(found) == sorted(again)


def rows_text(rows):
    return {r[0]: r[1] for r in rows}


def test_mix_repeats_rows_with_all_columns(spark):
    rows = _docs({"a": 60, "b": 90, None: 40})
    df = _frame(spark, rows)
    copies = {r.doc_id: r.copies for r in mixing.plan(df).collect()}
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    got = Counter(tuple(r) for r in mixed.collect())
    assert got == Counter({(*r, "x", 1): copies[r[0]] for r in rows if copies[r[0]]})


def test_nulls_empty_texts_and_repeated_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", "a"), (None, "x y", "b"), (None, "x y", "b"), (None, "z", "b"),
            (4, "one two three", None), (4, "one two three", None), (4, "other", None)]
    found = mixing.plan(_frame(spark, rows)).collect()
    assert len(found) == len(rows)
    assert {(r.size, r.copies) for r in found if r.doc_id in (1, 2, 3)} == {(0, 0)}
    assert len({r.copies for r in found if r.doc_id == 4 and r.size == 3}) == 1
    assert mixing.plan(_frame(spark, rows[:3])).select("target").distinct().collect()[0][0] == 0
    assert mixing.mix(_frame(spark, rows[:3])).count() == 0
    assert mixing.plan(_frame(spark, [])).count() == 0


def test_budget_beyond_the_limits(spark):
    rows = _docs({"a": 30, "b": 30})
    found = mixing.plan(_frame(spark, rows), budget=(5, 1), weights=(1,)).collect()
    assert all(r.copies == 2 and r.target == 2 * r.source_size for r in found)


def test_many_sources_hold_their_limits_in_turn(spark):
    rows = [(i, " ".join(["w"] * (2 ** (i % 12))), f"s{i % 12:02}") for i in range(480)]
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    expected = _targets(sizes)
    found = mixing.targets(mixing.measure(_frame(spark, rows))).collect()
    assert {r.source: round(r.target, 6) for r in found} == {s: round(float(t), 6) for s, t in expected.items()}
