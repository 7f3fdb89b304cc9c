"""Vectors as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def length(a: Column) -> Column:
    """Euclidean."""
    return F.sqrt(dot(a, a))


def normalise(a: Column) -> Column:
    """Of length 1; zero vectors stay."""
    n = length(a)
    return F.transform(a, lambda x: x.cast("double") / F.when(n == 0, F.lit(1.0)).otherwise(n))


def cosine(stored: Column, unit_query: Column) -> Column:
    """Against a query of length 1; the stored side's length gets 1e-9 so that zero vectors score 0."""
    return dot(stored, unit_query) / (length(stored) + F.lit(1e-9))
