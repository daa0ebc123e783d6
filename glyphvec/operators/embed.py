"""Text to vectors in Arrow batches through a pluggable provider.

A provider is any object with ``dim`` and ``encode(texts) -> matrix``. Operators take a *factory*, which
is called once per task, so that clients and models never travel inside a closure.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphvec.functions.text import clean_text
from glyphvec.session import materialise

BATCH_SIZE = 128
MAX_BACKOFF_SECONDS = 60
VECTOR_TYPE = T.ArrayType(T.FloatType(), containsNull=False)


class Provider(Protocol):
    dim: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


ProviderFactory = Callable[[], Provider]


@dataclass
class HashingProvider:
    """Bag of words without a model: a lower-cased word counts at ``md5(word) mod dim``."""

    dim: int = 64
    max_words: int = 200_000

    def __post_init__(self) -> None:
        self._word = re.compile(r"[^\W_]+")
        self._place: dict[str, int] = {}

    def _place_of(self, word: str) -> int:
        head = hashlib.md5(word.encode("utf-8"), usedforsecurity=False).digest()[:4]
        return int.from_bytes(head, "big") % self.dim

    def encode(self, texts: list[str]) -> np.ndarray:
        words = [self._word.findall(text.lower()) for text in texts]
        flat = list(itertools.chain.from_iterable(words))
        if len(self._place) > self.max_words:
            self._place = {}
        self._place |= {w: self._place_of(w) for w in set(flat).difference(self._place)}
        places = np.fromiter(map(self._place.__getitem__, flat), np.int64, len(flat))
        rows = np.repeat(np.arange(len(texts)), [len(w) for w in words])
        counts = np.bincount(rows * self.dim + places, minlength=len(texts) * self.dim)
        return counts.reshape(len(texts), self.dim).astype(np.float32)


@dataclass
class RetryingProvider:
    """Repeat a failed call after 2, 4, 8 ... seconds, at most 60; give up after ``max_retries``.

    ``retry_on`` are the failures the wrapped provider declares as passing.
    """

    inner: Provider
    retry_on: tuple[type[BaseException], ...]
    max_retries: int = 5
    sleep: Callable[[float], Any] = time.sleep

    @property
    def dim(self) -> int:
        return self.inner.dim

    def encode(self, texts: list[str]) -> np.ndarray:
        for delay in (*self.delays(), None):
            try:
                return self.inner.encode(texts)
            except self.retry_on:
                if delay is None:
                    raise
            self.sleep(delay)
        raise AssertionError("the last attempt returns or raises")

    def delays(self) -> list[int]:
        """Seconds to wait before each repetition."""
        return [min(2**n, MAX_BACKOFF_SECONDS) for n in range(1, self.max_retries + 1)]


def encode_texts(
    provider: Provider, texts: Sequence[str | None], *, batch_size: int, normalize: bool
) -> np.ndarray:
    """One float32 row per text. Null and blank texts are not encoded and give zero rows."""
    out = np.zeros((len(texts), provider.dim), dtype=np.float32)
    full = [i for i, t in enumerate(texts) if t is not None and t.strip()]
    for lo in range(0, len(full), batch_size):
        rows = full[lo : lo + batch_size]
        got = np.asarray(provider.encode([texts[i] for i in rows]), dtype=np.float32)
        if got.shape != (len(rows), provider.dim):
            raise RuntimeError(
                f"the provider returned shape {got.shape}, expected {(len(rows), provider.dim)}"
            )
        out[rows] = got
    if normalize:
        norms = np.linalg.norm(out.astype(np.float64), axis=1, keepdims=True)
        out = (out / np.where(norms == 0.0, 1.0, norms)).astype(np.float32)
    return out


def embed_once(
    df: DataFrame,
    factory: ProviderFactory,
    *,
    text_col: str = "video_title",
    output_col: str = "embedding",
    rules: dict | None = None,
    patterns: str = "intended",
    batch_size: int = BATCH_SIZE,
    normalize: bool = True,
    max_calls: int | None = None,
) -> DataFrame:
    """As ``embed``, but equal texts are encoded once: for providers whose calls cost more than a join.

    Distinct texts are encoded and written, in at most ``max_calls`` tasks, which bounds the calls that
    run at once; rows then join them by their text. Null texts get zero vectors.
    """
    if rules is not None:
        df = df.withColumn(text_col, clean_text(F.col(text_col), rules, patterns))
    texts = df.select(F.col(text_col).alias("_text")).filter(F.col("_text").isNotNull()).distinct()
    if max_calls:
        texts = texts.repartition(max_calls, "_text")
    vectors = embed(
        texts, factory, text_col="_text", output_col="_vector", batch_size=batch_size, normalize=normalize
    )
    vectors = materialise(vectors, "distinct-texts")
    zero = F.array_repeat(F.lit(0.0).cast("float"), factory().dim)
    kept = [F.col(c) for c in df.columns if c != output_col]
    joined = df.join(vectors, F.col(text_col) == F.col("_text"), "left")
    return joined.select(*kept, F.coalesce("_vector", zero).alias(output_col))


def embed(
    df: DataFrame,
    factory: ProviderFactory,
    *,
    text_col: str = "video_title",
    output_col: str = "embedding",
    rules: dict | None = None,
    patterns: str = "intended",
    batch_size: int = BATCH_SIZE,
    normalize: bool = True,
) -> DataFrame:
    """Append ``output_col``; with ``rules`` the text is cleaned first and stored cleaned.

    Row-wise and stateless, so it runs on a stream as on a table. The number of tasks is the number
    of input partitions, which also bounds how many remote calls run at once.
    """
    if rules is not None:
        df = df.withColumn(text_col, clean_text(F.col(text_col), rules, patterns))

    def run(batches):
        provider = factory()
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            matrix = encode_texts(provider, texts, batch_size=batch_size, normalize=normalize)
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * provider.dim
            vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, vectors], names=[*batch.schema.names, output_col]
            )

    kept = [f for f in df.schema.fields if f.name != output_col]
    schema = T.StructType([*kept, T.StructField(output_col, VECTOR_TYPE, nullable=False)])
    return df.select(*[f.name for f in kept]).mapInArrow(run, schema)
