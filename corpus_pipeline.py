"""From raw documents to packed training sequences; each stage applies one operator to all it is given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphvec.llm import jaccard, langid, packing, pii, quality
from glyphvec.llm.common import free_name
from glyphvec.session import settled, ship_package


def _set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns of these names under free ones, and the columns as they were."""
    moved = {c: free_name(docs, f"own_{c}") for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(moved), [F.col(f"`{moved.get(c, c)}`").alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language; columns and their values stay.

    The model learns from all rows that have a language. ``und`` and posteriors below one half go.
    """
    ship_package(spark)
    rows, own = _set_aside(docs, "lang_pred", "score")
    found = langid.identify(rows, langid.fit(docs))
    return found.filter((found["lang_pred"] != langid.UNKNOWN) & (found["score"] >= 0.5)).select(*own)


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the weighted quality rules reject."""
    return quality.filter_quality(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of copies and near copies."""
    ship_package(spark)
    return jaccard.keep_one(docs)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; ``n_chars`` follows, all other values stay."""
    ship_package(spark)
    rows, own = _set_aside(docs, "n_entities")
    found = pii.pseudonymise(rows, pii.SAMPLE_KEY)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*own)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenises what is left and packs it; one row for each piece of a document."""
    import public_tokenizers

    ship_package(spark)
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language", identify_language),
    ("quality", filter_quality),
    ("near_duplicates", join_near_duplicates),
    ("private", replace_private),
    ("packing", pack_sequences),
]

#: Learned models and sketches decide here; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again.

    A stage's own tables go when its result is written, that result when the next one is.
    """

    def up_to(stages: list) -> DataFrame:
        if not stages:
            return spark.read.parquet(f"{sf_dir}/documents.parquet")
        name, stage = stages[-1]
        return settled(name)(lambda: stage(spark, up_to(stages[:-1]), sf_dir))()

    return up_to(STAGES)
