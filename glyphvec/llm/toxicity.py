"""Toxicity by weak supervision.

1. Voters: a seed lexicon, words and word beginnings that stand out in labelled toxic texts, and patterns.
   A voter votes or abstains.
2. A generative label model estimates by expectation-maximisation how often each voter speaks up on toxic
   and on clean texts, and from what the votes still have in common, given the class, how far voters
   repeat each other; repeated evidence counts once.
3. A linear classifier learns the posterior labels and scores every text.

The fit sees a bounded sample of labelled rows (``SAMPLE``) in one task; scoring is a pass without a
shuffle.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm.common import id_remainder, portions, table
from glyphvec.session import materialise

#: Most labelled rows that the model is fitted on, chosen by a hash of their id; at most half are toxic.
SAMPLE = 8_000
#: A mined voter stands out by so many standard errors of its log odds ratio, in so many toxic texts.
STANDS_OUT, SUPPORT, VOTERS = 4.0, 5, 256
#: What the classifier looks at may stand out less.
FEATURES, FEATURE_STANDS_OUT = 768, 3.0
ROUNDS, STEPS = 20, 12
PENALTY = 0.02
#: How often a human label says toxic, on clean and on toxic texts; a voter whose rates are fixed.
LABEL = (0.01, 0.97)
THRESHOLD = 0.7

#: Insults that need no examples.
SEEDS = (
    "idiot idiots idiotic moron morons moronic stupid loser losers scum trash pathetic worthless disgusting clown "
    "imbecile dumb dumbass bastard scumbag "
    "idioten dummkopf arschloch abschaum wertlos widerlich "
    "imbécile crétin connard pourriture minable "
    "idiota imbécil estúpido estúpida basura escoria patético"
).split()
PATTERNS = {
    "pattern:masked": re.compile(r"\b[^\W\d_]\*{2,}[^\W\d_]"),
    "pattern:shouting": re.compile(r"(?:\b[A-ZÀ-Ý]{3,}\b[ !]+){3}"),
    "pattern:bangs": re.compile(r"!{3,}"),
    "pattern:addressed": re.compile(r"(?i)\byou(?:'re| are) (?:an? |such an? |so )?[a-z]+"),
}
_WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)


def features(text: str | None) -> set[str]:
    """Distinct words, word beginnings (marked by ``*``) and patterns of a text."""
    found: set[str] = set()
    for word in set(_WORD.findall((text or "").lower())):
        found.add(word)
        for n in BEGINNINGS:
            if len(word) >= n:
                found.add(word[:n] + "*")
    return found | {name for name, pattern in PATTERNS.items() if pattern.search(text or "")}


def _stand_out(often: Counter, rare: Counter, t: int, c: int) -> list[tuple[float, str]]:
    """(standard errors, feature) of what ``t`` toxic texts hold more often than ``c`` clean ones."""
    ranked = []
    for f, n in often.items():
        a, b = n + 0.5, rare[f] + 0.5
        odds = math.log(a / (t - n + 0.5)) - math.log(b / (c - rare[f] + 0.5))
        ranked.append((odds / math.sqrt(1 / a + 1 / b), f))
    return sorted(ranked, key=lambda x: (-x[0], x[1]))


@dataclass
class LabelModel:
    """How often each voter votes on clean (0) and toxic (1) texts, and how much of a vote is its own."""

    prior: float
    speaks: np.ndarray
    own: np.ndarray

    def posterior(self, votes: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
        """Probability that each text is toxic, by its votes and, where given, its label.

        Who abstains says nothing: there are many ways to be toxic, and a text uses few of them.
        """
        says = self.own * np.log(self.speaks[:, 1] / self.speaks[:, 0])
        odds = math.log(self.prior / (1 - self.prior)) + votes @ says
        if labels is not None:
            said, unsaid = math.log(LABEL[1] / LABEL[0]), math.log((1 - LABEL[1]) / (1 - LABEL[0]))
            odds = odds + np.where(labels > 0, said, unsaid)
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over ``votes`` (texts x voters, 0 or 1) and the labels as one more voter.

    The label keeps the classes from drifting to other groups of like texts. It starts from voters that speak up on a tenth of the toxic texts and rarely on others. After half
    of the rounds the correlations of votes within the classes are estimated; a voter's weight becomes
    one over the sum of its correlations, so that voters that always vote together weigh as one.
    """
    n, m = votes.shape
    start = np.tile([0.005, 0.1], (m, 1))
    model = LabelModel(min(max(float(labels.mean()), 0.01), 0.5), start, np.ones(m))
    for k in range(rounds):
        toxic = model.posterior(votes, labels)
        share = np.stack([1 - toxic, toxic], axis=1)
        total = share.sum(axis=0)
        model.speaks = np.clip((votes.T @ share + start * 10) / (total + 10), 1e-4, 1 - 1e-4)
        if k == rounds // 2:
            rest = votes - share @ model.speaks.T
            spread = np.sqrt((rest**2).mean(axis=0)) + 1e-9
            correlation = (rest.T @ rest) / n / np.outer(spread, spread)
            np.fill_diagonal(correlation, 1)
            model.own = 1 / np.maximum(1, np.clip(correlation, 0, 1).sum(axis=1))
    return model


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression on soft labels, by Newton steps."""
    full = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1).astype(np.float64)
    ridge = np.full(full.shape[1], PENALTY)
    ridge[-1] = 1e-3
    w = np.zeros(full.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -40, 40)))
        gradient = full.T @ (p - y) + ridge * w
        curvature = (full * (p * (1 - p))[:, None]).T @ full + np.diag(ridge)
        step = np.linalg.solve(curvature, gradient)
        w -= step * min(1.0, 8 / (np.abs(step).max() + 1e-12))
    return w[:-1], float(w[-1])


def fit_texts(texts: list[str | None], labels: list[int], share: float | None = None) -> dict:
    """Model of labelled texts: weights by feature, and the bias.

    Labels pick voters and anchor the label model; the classifier learns from its posteriors. ``share``
    is the share of toxic texts in general, if the sample has another. A text counts once for each
    label. Without texts of both classes only seeds vote, with fixed weights.
    """
    rows = sorted({(t or "", int(y)) for t, y in zip(texts, labels)})
    marks = np.array([y for _, y in rows], np.int64)
    if not marks.any() or marks.all():
        return {"weights": dict.fromkeys(SEEDS, 4.0), "bias": -3.0}
    often: Counter = Counter()
    for t, y in rows:
        if y:
            often.update(features(t))
    often = Counter({f: n for f, n in often.items() if n >= SUPPORT or f in SEEDS or f in PATTERNS})
    sets = [{f for f in features(t) if f in often} for t, _ in rows]
    rare = Counter(f for s, y in zip(sets, marks) if not y for f in s)
    ranked = _stand_out(often, rare, int(marks.sum()), int(len(marks) - marks.sum()))
    mined = [f for z, f in ranked if z >= STANDS_OUT][:VOTERS]
    voters = sorted({*mined, *(f for f in (*SEEDS, *PATTERNS) if f in often)})
    votes = _matrix(sets, voters)
    posterior = fit_label_model(votes, marks).posterior(votes, marks)
    looked_at = sorted({*voters, *[f for z, f in ranked if z >= FEATURE_STANDS_OUT][:FEATURES]})
    looked_at = _most_general(sets, looked_at)
    weights, bias = fit_linear(_matrix(sets, looked_at), posterior)
    if share:
        own = float(marks.mean())
        bias += math.log(share / (1 - share)) - math.log(own / (1 - own))
    found = {f: round(float(w), 9) for f, w in zip(looked_at, weights)}
    # What a sampled seed tells is in the weights, its own or those of a beginning that stands for it.
    sampled = {f for t, _ in rows for f in features(t)}
    unseen = {f: 4.0 for f in SEEDS if f not in sampled}
    return {"weights": {**unseen, **found}, "bias": round(bias, 9)}


def _most_general(sets: list[set[str]], names: list[str]) -> list[str]:
    """One of the features that are in the same texts throughout: the shortest beginning, if any."""
    seen: dict[bytes, str] = {}
    columns = _matrix(sets, names).astype(bool)
    for i in sorted(range(len(names)), key=lambda i: (not names[i].endswith("*"), len(names[i]), names[i])):
        seen.setdefault(np.packbits(columns[:, i]).tobytes(), names[i])
    return sorted(seen.values())


def _matrix(sets: list[set[str]], names: list[str]) -> np.ndarray:
    out = np.zeros((len(sets), len(names)), np.float32)
    place = {f: i for i, f in enumerate(names)}
    for row, s in enumerate(sets):
        out[row, [place[f] for f in s if f in place]] = 1
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Model of at most ``sample`` labelled documents.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic; rows with nulls in them do not count, a
    document labelled both ways counts as toxic. The sample reaches one task, its model the driver.
    """

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        marks: list[int] = []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            marks += batch.column(1).to_pylist()
        yield pa.RecordBatch.from_pydict({"model": [json.dumps(fit_texts(texts, marks, share))]})

    known = labels.select("doc_id", "toxic").dropna().groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    known = materialise(known, "labels")
    share = known.agg(F.avg(F.col("toxic").cast("int"))).first()[0]
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    toxic = known.filter("toxic").orderBy(*order).limit(sample // 2)
    clean = known.filter("NOT toxic").orderBy(*order).limit(sample // 2)
    rows = docs.select("doc_id", "text").dropna().join(F.broadcast(toxic.unionByName(clean)), "doc_id")
    rows = rows.orderBy(*order, "text").limit(sample).select("text", F.col("toxic").cast("int"))
    found = rows.coalesce(1).mapInArrow(in_task, "model string").first()
    return json.loads(found["model"]) if found else fit_texts([], [])


class Scorer:
    def __init__(self, model: dict) -> None:
        self.weights, self.bias = model["weights"], model["bias"]
        self.patterns = {n: p for n, p in PATTERNS.items() if n in self.weights}
        self.starts = {f[:4] for f in self.weights if not f.startswith("pattern:")}

    def score(self, text: str | None) -> float:
        weights, found = self.weights, set()
        for word in set(_WORD.findall((text or "").lower())):
            if word[:4] in self.starts:
                found.update(f for f in (word, word[:4] + "*", word[:5] + "*" * (len(word) >= 5),
                                         word[:6] + "*" * (len(word) >= 6)) if f in weights)
        found.update(n for n, p in self.patterns.items() if p.search(text or ""))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.bias + sum(weights[f] for f in sorted(found))))))


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; old columns of these names are replaced.

    Null and empty texts get the score of a text in which nothing was found. Only the text counts.
    Repeated rows and null ids are rows like any other.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Scorer(shared.value)
        for texts in batches:
            yield pa.array([own.score(t) for part in portions(texts) for t in part.to_pylist()], pa.float64())

    found = docs.withColumn("score", scored(F.col(f"`{text}`")))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    held = F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    model = fit(docs, labels.filter(~held))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


QUERIES = {"op1_toxicity": op1_toxicity}
