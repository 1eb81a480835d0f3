"""Numeric expressions for features, scores and thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def finite(c: Column) -> Column:
    """The value, or NULL where it is NaN or infinite."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(INF)), c)


def is_nonfinite(c: Column) -> Column:
    return c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(INF))


def threshold_flag(score: Column, threshold: Column | float) -> Column:
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= limit).cast("int")


def confidence(probability: Column) -> Column:
    """Distance from the undecided midpoint, as a share of the greatest possible distance."""
    return F.least(F.abs(probability - F.lit(0.5)) * F.lit(2.0), F.lit(1.0))


def ratio(num: Column, den: Column, empty: float = 0.0) -> Column:
    """num / den, or ``empty`` where the denominator is zero."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(float(empty)))


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def range_number(value: Column, per_octave: int = 256) -> Column:
    """Number of the range a double lies in: ``per_octave`` to every power of two and sign.

    Rises with the value, symmetric about zero, infinities at the ends; NULL for NULL, NaN above all.
    """
    size = F.abs(value)
    octave = F.floor(F.log2(size))
    inside = F.floor((size / F.pow(F.lit(2.0), octave) - 1) * per_octave)
    number = (octave + 1100) * per_octave + inside + 1
    number = F.when(F.isnan(value), 1 << 62).when(size == 0, 0).when(size == INF, 1 << 61).otherwise(number)
    return F.when(value < 0, -number).otherwise(number).cast("bigint")
