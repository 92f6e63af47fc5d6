"""Column expressions over ARRAY<DOUBLE> vectors."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def sqdist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance."""
    return vector_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def scaled_dist(v: Column, center: Column, total: Column | None = None) -> Column:
    """Squared distance divided by the component sum of ``v``; null when that sum is not positive."""
    total = vector_sum(v) if total is None else total
    return F.when(total > 0, sqdist(v, center) / total)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def round2(x: Column) -> Column:
    """Half-up to two places; 0.0 for what has no decimal form."""
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == math.inf), F.lit(0.0)).otherwise(F.round(x, 2))
