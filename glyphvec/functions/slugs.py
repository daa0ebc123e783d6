"""Slugs for artifact paths, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphvec.functions.text import or_empty, strip


def slug(value: Column) -> Column:
    """Keep letters, digits, dot, underscore and hyphen; anything else folds into one hyphen."""
    folded = F.regexp_replace(strip(or_empty(value)), r"[^A-Za-z0-9._-]+", "-")
    bare = F.regexp_replace(folded, r"^[-._]+|[-._]+$", "")
    return F.when(bare == "", F.lit("unknown")).otherwise(bare)


def model_slug(model: Column) -> Column:
    """Slug of the last path component of a model name."""
    bare = F.regexp_replace(strip(or_empty(model)), r"[\\/]+$", "")
    tail = F.regexp_extract(bare, r"([^\\/]*)$", 1)
    return F.when(bare == "", F.lit("unknown-model")).otherwise(slug(tail))


def dataset_slug(path: Column, is_directory: bool = False) -> Column:
    """Slug of a file's stem, or of a directory's whole name."""
    bare = F.regexp_replace(or_empty(path), r"(?<=.)/+$", "")
    name = F.element_at(F.split(bare, "/"), -1)
    stem = name if is_directory else F.regexp_replace(name, r"(?s)^(.+)\.[^.]+$", "$1")
    return slug(F.when(stem == "", F.lit("dataset")).otherwise(stem))


def model_slug_from_path(path: Column) -> Column:
    """Slug of the component after the first one named ``models``."""
    parts = F.filter(F.split(or_empty(path), "/"), lambda p: p != "")
    after = F.get(parts, F.array_position(parts, "models").cast("int"))
    known = F.array_contains(parts, "models") & after.isNotNull()
    return F.when(known, slug(after)).otherwise(F.lit("unknown-model"))
