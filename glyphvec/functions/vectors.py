"""Vector arithmetic over array columns.

These are the readable row-wise forms, for projections and small joins. Scoring of whole tables runs
as matrix products over Arrow batches (``glyphvec.operators.knn``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "l2", "ip")
SCORE_DECIMALS = 6


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    return metric


def as_vector(values: Column) -> Column:
    return values.cast("array<float>")


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """Unit length in double precision; an all-zero vector stays zero."""
    # The one-element array binds the norm to a name, so that it is computed once per vector.
    scaled = F.transform(
        F.array(l2_norm(v)),
        lambda norm: F.transform(
            v, lambda x: x.cast("double") / F.when(norm == 0.0, 1.0).otherwise(norm)
        ),
    )
    return scaled[0]


def score(a: Column, b: Column, metric: str) -> Column:
    """Larger is nearer: cosine similarity, minus the squared distance, or inner product minus one."""
    check_metric(metric)
    if metric == "cosine":
        return F.coalesce(F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b)), F.lit(0.0))
    if metric == "ip":
        return dot(a, b) - 1.0
    gap = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return -dot(gap, gap)


def checked_vector(v: Column, dim: int) -> Column:
    """The vector as floats; the job fails on a null or on another length."""
    message = F.concat(
        F.lit(f"embedding dimension mismatch: expected {dim}, got "),
        F.coalesce(F.size(v).cast("string"), F.lit("null")),
    )
    good = v.isNotNull() & (F.size(v) == dim)
    return F.when(good, as_vector(v)).otherwise(F.raise_error(message).cast("array<float>"))
