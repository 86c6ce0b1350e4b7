"""Vector arithmetic on array columns, without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 if either has no length."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(0.0)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def sigmoid(c: Column, middle: float = 3.0, width: float = 2.0) -> Column:
    return 1 / (1 + F.exp(-(c - middle) / width))


def letter_vector(c: Column) -> Column:
    """How often each letter from a to z is in a text: an offline stand-in for a text's embedding."""
    low = F.lower(c)
    return F.array(*((F.length(low) - F.length(F.replace(low, F.lit(x)))).cast("double") for x in "abcdefghijklmnopqrstuvwxyz"))
