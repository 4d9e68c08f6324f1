"""Expressions over ARRAY<DOUBLE> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, 0.0 if either has no length."""
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0, F.lit(0.0)).otherwise(dot(a, b) / lengths)


def l2_normalize(v: Column) -> Column:
    """Unit vector; the zero vector stays as it is."""
    length = norm(v)
    return F.when(length > 0, F.transform(v, lambda x: x / length)).otherwise(v)


def add(a: Column, b: Column, weight: float = 1.0) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y * weight)


def sinusoidal(position: Column, dimension: int) -> Column:
    """Sine in even slots, cosine in odd ones; an odd dimension leaves its last slot 0.

    The wave lengths are constants of the dimension, so they are literals of the plan.
    """
    scales = [10000.0 ** (2 * i / dimension) for i in range(dimension // 2)]
    waves = F.array(*map(F.lit, scales))
    pairs = F.transform(waves, lambda w: F.array(F.sin(position / w), F.cos(position / w)))
    vector = F.flatten(pairs)
    return F.concat(vector, F.array(F.lit(0.0))) if dimension % 2 else vector

