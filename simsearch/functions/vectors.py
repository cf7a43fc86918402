"""Column expressions over ``array<float>`` embeddings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_DIGITS = 6


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(left: Column, right: Column) -> Column:
    """Inner product, which is the cosine when both sides have unit length."""
    products = F.zip_with(as_double(left), as_double(right), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(vector), F.lit(0.0), lambda total, x: total + x * x))


def l2_normalize(vector: Column) -> Column:
    """The vector at unit length; null for a zero vector, which has no direction."""
    length = norm(vector)
    return F.when(length > 0, F.transform(as_double(vector), lambda x: x / length))


def cosine(left: Column, right: Column) -> Column:
    lengths = norm(left) * norm(right)
    return F.when(lengths > 0, dot(left, right) / lengths)


def has_dim(vector: Column, dim: int) -> Column:
    """True for a usable vector; false (never null) for a null or a wrong length."""
    return F.coalesce(F.size(vector) == dim, F.lit(False)) & vector.isNotNull()
