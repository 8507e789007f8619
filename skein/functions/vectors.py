"""Vectors as arrays; sums are in double precision, in the order of the components."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where a length is 0."""
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0, 0.0).otherwise(dot(a, b) / lengths)


def normalized(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: F.when(n == 0, 0.0).otherwise(x.cast("double") / n))


def softmax(scores: Column, scale: float = 100.0) -> Column:
    top = F.array_max(scores)
    raw = F.transform(scores, lambda s: F.exp((s - top) * scale))
    return F.transform(raw, lambda x: x / total(raw))


def top_two(scores: Column) -> Column:
    """best, second and their margin."""
    s = F.sort_array(scores, asc=False)
    return F.struct(F.get(s, F.lit(0)).alias("best"), F.get(s, F.lit(1)).alias("second"), (F.get(s, F.lit(0)) - F.coalesce(F.get(s, F.lit(1)), F.lit(0.0))).alias("margin"))


def upper_median(values: Column) -> Column:
    """The element at n // 2 of the sorted values: not interpolated, the upper of the middle two."""
    return F.get(F.sort_array(values), F.floor(F.size(values) / 2).cast("int"))
