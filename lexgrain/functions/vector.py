"""Vector expressions on array columns, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """Of length one; an all-zero vector stays as it is."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def head(a: Column, dims: int) -> Column:
    """The first ``dims`` numbers, brought to length one (nested embeddings)."""
    return unit(F.slice(a, 1, dims))


def cosine(a: Column, b: Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))
