"""Sort keys for file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphvec.functions.text import WHITESPACE


def _number_key(digits: Column) -> tuple[Column, Column]:
    """Digits of any length order like numbers by (length, text) once leading zeros are gone."""
    bare = F.regexp_replace(digits, "^0+(?=[0-9])", "")
    return F.coalesce(F.length(bare), F.lit(-1)), F.coalesce(bare, F.lit(""))


def natural_key(name: Column) -> Column:
    """``2.txt`` before ``10.txt``: text runs compare lower-cased, digit runs compare as numbers."""
    pairs = F.arrays_zip(
        F.split(F.lower(name), "[0-9]+", -1).alias("text"),
        F.regexp_extract_all(name, F.lit("[0-9]+"), F.lit(0)).alias("digits"),
    )

    def one(pair: Column) -> Column:
        size, digits = _number_key(pair["digits"])
        return F.struct(pair["text"].alias("text"), size.alias("size"), digits.alias("digits"))

    return F.transform(pairs, one)


def numeric_first_key(stem: Column) -> Column:
    """Whole-number stems first, by value; then all other stems as text."""
    blank = f"[{WHITESPACE}]*"
    number = rf"^{blank}([+-]?)([0-9]+(?:_[0-9]+)*){blank}$"
    is_text = ~stem.rlike(number)
    digits = F.regexp_replace(F.regexp_extract(stem, number, 2), "_", "")
    size, bare = _number_key(digits)
    negative = (F.regexp_extract(stem, number, 1) == "-") & (bare != "0")
    flipped = F.translate(bare, "0123456789", "9876543210")
    return F.struct(
        is_text.alias("is_text"),
        F.when(is_text, 0).when(negative, -size).otherwise(size).alias("size"),
        F.when(is_text, stem).when(negative, flipped).otherwise(bare).alias("text"),
    )
