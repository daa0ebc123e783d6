"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting and scoring run in tasks on Arrow batches. What reaches the driver, and is broadcast, is one
row of ``buckets`` counts for each language, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm.common import free_name, id_remainder, portions, slices, table

UNKNOWN = "und"
SIZES = (1, 2, 3)
BUCKET_BITS = 16
SMOOTHING = 0.5
#: The posterior is stated as for a text of this many n-grams, so that long texts do not all score 1.
EVIDENCE = 64
#: Values that one slice of a batch may hold; a slice has a row for each character and language.
SLICE = 4_000_000

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        found = np.zeros(0x110000, bool)
        found[[i for i in range(0x110000) if chr(i).isalpha()]] = True
        _letters.append(found)
    return _letters[0]


def _positions(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each between two blanks, and where each text begins.

    What is no letter becomes a blank; two blanks in a row never lie within an n-gram, which also keeps
    n-grams from crossing into the next text.
    """
    lowered = [t.lower() for t in texts]
    joined = "".join(f" {t} " for t in lowered)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letter_table()[codes], codes, np.uint32(32))
    starts = np.cumsum([0] + [len(t) + 2 for t in lowered[:-1]])
    return codes, starts


def _hashed(codes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """For each n-gram size, the bucket at each position; ``1 << bits`` where no n-gram begins."""
    blank = codes == 32
    broken = np.append(blank[:-1] & blank[1:], True)
    none = blank.copy()
    value = np.zeros(len(codes), np.uint32)
    for size in range(1, max(SIZES) + 1):
        if size > 1:
            none = none | np.append(broken[size - 2 :], np.ones(size - 2, bool)) if size > 2 else broken.copy()
        shifted = np.append(codes[size - 1 :], np.zeros(size - 1, np.uint32))
        value = (value ^ shifted) * np.uint32(0x9E3779B1)
        value ^= value >> np.uint32(15)
        if size in SIZES:
            mixed = (value + np.uint32(size)) * np.uint32(0x85EBCA6B)
            bucket = (mixed >> np.uint32(32 - bits)).astype(np.int64)
            bucket[none] = 1 << bits
            yield bucket


@dataclass(frozen=True)
class LanguageModel:
    """Log-probabilities by bucket (the last row is for no n-gram) and language."""

    languages: list[str]
    log_prior: np.ndarray
    log_likelihood: np.ndarray
    bits: int = BUCKET_BITS
    sizes: tuple[int, ...] = field(default=SIZES)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior of each text; ``und`` and 0 without letters or without a model."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        filled = [i for i, t in enumerate(texts) if t]
        width = len(self.languages)
        for a, b in slices((len(texts[i]) + 2 for i in filled), max(1, SLICE // width)):
            sums, grams = self._sums([texts[i] for i in filled[a:b]])
            scaled = sums * np.minimum(1.0, EVIDENCE / np.maximum(grams, 1))[:, None] + self.log_prior
            full = sums + self.log_prior
            best = full.argmax(axis=1)
            weight = np.exp(scaled - scaled.max(axis=1, keepdims=True))
            share = weight[np.arange(len(best)), best] / weight.sum(axis=1)
            for i, language, score, n in zip(filled[a:b], best, share, grams):
                if n:
                    names[i], scores[i] = self.languages[language], score
        return names, scores

    def _sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sums = np.zeros((len(texts), len(self.languages)))
        grams = np.zeros(len(texts), np.int64)
        for part, first in _pieces(texts, max(1, SLICE // len(self.languages))):
            codes, starts = part
            rows = np.arange(first, first + len(starts))
            for bucket in _hashed(codes, self.bits):
                sums[rows] += np.add.reduceat(self.log_likelihood[bucket], starts, axis=0, dtype=np.float64)
                grams[rows] += np.add.reduceat((bucket < 1 << self.bits).astype(np.int64), starts)
        return sums, grams


def _pieces(texts: list[str], most: int):
    """Texts as character arrays; a text over ``most`` comes in pieces of words, each with its row."""
    if len(texts) > 1 or len(texts[0]) <= most:
        yield _positions(texts), 0
        return
    text, start = texts[0], 0
    while start < len(text):
        end = min(len(text), start + most)
        while start < end < len(text) and text[end].isalpha() and end < start + 2 * most:
            end += 1
        yield _positions([text[start:end]]), 0
        start = end


def count_ngrams(docs: DataFrame, text: str = "text", lang: str = "lang", bits: int = BUCKET_BITS) -> DataFrame:
    """(lang, bucket, n): n-grams of each language by bucket; bucket -1 holds the number of documents.

    Rows without text or language do not count. Each task adds up its own rows first.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in (part for whole in batches for part in portions(whole)):
            texts, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by_name: dict[str, list[str]] = {}
            for t, name in zip(texts, names):
                by_name.setdefault(name, []).append(t)
            for name, own in by_name.items():
                total = counts.setdefault(name, np.zeros((1 << bits) + 2, np.int64))
                total[-1] += len(own)
                for a, b in slices(map(len, own), SLICE):
                    for (codes, _), _ in _pieces(own[a:b], SLICE):
                        for bucket in _hashed(codes, bits):
                            total[:-1] += np.bincount(bucket, minlength=(1 << bits) + 1)
        for name, total in counts.items():
            used = np.flatnonzero(total[: 1 << bits])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * (len(used) + 1), pa.string()),
                    pa.array(np.append(used, -1).astype(np.int32)),
                    pa.array(np.append(total[used], total[-1])),
                ],
                names=["lang", "bucket", "n"],
            )

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    counted = rows.mapInArrow(count, "lang string, bucket int, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", bits: int = BUCKET_BITS) -> LanguageModel:
    """Model of all rows of ``docs`` that have a text and a language.

    The driver gets (languages x buckets) sums; nothing else of the corpus.
    """
    counted = count_ngrams(docs, text, lang, bits).toPandas()
    languages = sorted(counted["lang"].unique())
    place = {name: i for i, name in enumerate(languages)}
    column = counted["lang"].map(place).to_numpy(np.int64)
    bucket, n = counted["bucket"].to_numpy(np.int64), counted["n"].to_numpy(np.float64)
    totals = np.zeros((1 << bits, len(languages)))
    totals[bucket[bucket >= 0], column[bucket >= 0]] = n[bucket >= 0]
    documents = np.zeros(len(languages))
    documents[column[bucket < 0]] = n[bucket < 0]
    smooth = totals + SMOOTHING
    likelihood = np.zeros(((1 << bits) + 1, len(languages)), np.float32)
    if languages:
        likelihood[:-1] = np.log(smooth / smooth.sum(axis=0))
    prior = np.log(documents / documents.sum()) if languages else documents
    return LanguageModel(languages, prior, likelihood, bits)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns that had these names are replaced.

    Null, empty and letterless texts are ``und`` with score 0. Ties go to the first language by name.
    Repeated rows stay. A model without languages says ``und`` everywhere.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [shared.value.predict(part.to_pylist()) for part in portions(texts)]
            names = pa.array([name for own, _ in found for name in own], pa.string())
            scores = pa.array(np.concatenate([np.zeros(0), *(own for _, own in found)]), pa.float64())
            yield pa.StructArray.from_arrays([names, scores], names=["lang_pred", "score"])

    name = free_name(docs, "found")
    found = docs.withColumn(name, predict(F.col(f"`{text}`")))
    return found.withColumns({"lang_pred": F.col(name)["lang_pred"], "score": F.col(name)["score"]}).drop(name)


def held_out(docs: DataFrame) -> DataFrame:
    """``docs`` with the flag of the rows that no model may learn from."""
    return docs.withColumn("held_out", F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False)))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = held_out(table(spark, sf_dir, "documents"))
    model = fit(docs.filter(~F.col("held_out")))
    return identify(docs, model).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op9_language_id": op9_language_id}
