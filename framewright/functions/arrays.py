"""Arithmetic on array columns of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def cosine(a: Column, b: Column, eps: float = 1e-8) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + F.lit(eps))


def centred(a: Column) -> Column:
    return F.transform(F.array(total(a) / F.size(a)), lambda m: F.transform(a, lambda x: x - m))[0]


def pearson(a: Column, b: Column, flat: float | None = None) -> Column:
    """Correlation of two arrays; `flat` stands where one of them does not vary."""
    of = lambda x, y: F.try_divide(dot(x, y), F.sqrt(dot(x, x) * dot(y, y)))
    both = F.transform(F.array(F.struct(centred(a).alias("a"), centred(b).alias("b"))), lambda p: of(p["a"], p["b"]))[0]
    return both if flat is None else F.coalesce(both, F.lit(float(flat)))


def bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """The bin of a value when [low, high) is cut into equal ones; what lies outside falls into the first or last."""
    return F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((value - low) * (bins / (high - low))))).cast("int")


def colour_bin(r: Column, g: Column, b: Column, bins: int = 8) -> Column:
    """The bin of an RGB pixel in a colour histogram, red slowest."""
    of = lambda c: bin_of(c, 0, 256, bins)
    return (of(r) * bins + of(g)) * bins + of(b)
