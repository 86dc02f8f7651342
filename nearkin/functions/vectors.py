"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def l2_normalize(vector: Column) -> Column:
    """Unit-length copy in double; a zero vector stays zero.

    The length rides along as a repeated array, so that it is computed once per row and not
    once per element.
    """
    doubles = vector.cast("array<double>")
    lengths = F.array_repeat(norm(vector), F.size(vector))
    return F.zip_with(doubles, lengths, lambda x, length: F.when(length > 0, x / length).otherwise(x))


def subvectors(vector: Column, m: int, dim: int) -> Column:
    """The vector cut into m equal parts."""
    if dim % m:
        raise ValueError(f"dimension {dim} is not divisible by {m} sub-vectors")
    width = dim // m
    doubles = vector.cast("array<double>")
    return F.array(*[F.slice(doubles, part * width + 1, width) for part in range(m)])
