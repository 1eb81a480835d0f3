"""Counters, histograms and latency quantiles of scored events."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.operators.fitting import column_quantiles
from flowsift.schema import quoted

# Histogram bucket bounds.
PROBABILITY_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
LATENCY_BOUNDS_SECONDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0)


def event_counters(df: DataFrame, flag: Column, by: Sequence[str | Column] = ()) -> DataFrame:
    """Events scored, threats flagged and the threat rate per group."""
    events, threats = F.count(F.lit(1)), F.count_if(flag)
    return df.groupBy(*by).agg(
        events.alias("events_scored"), threats.alias("threats"), (threats / events).alias("threat_rate")
    )


def bucket_counts(value: Column, bounds: Sequence[float]) -> list[Column]:
    """One cumulative count per bound; a fixed number of aggregates whatever the data."""
    return [F.count_if(value <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)]


def unpivot_buckets(df: DataFrame, keep: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    """(keep, le, cumulative): one row per bound, and one for all values with an infinite bound."""
    rows = [
        F.struct(F.lit(float(b)).alias("le"), F.col(f"le_{i}").alias("cumulative"))
        for i, b in enumerate(bounds)
    ]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("observations").alias("cumulative")))
    return df.select(*keep, F.inline(F.array(*rows)))


def cumulative_histogram(
    df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """(by, le, cumulative, observations, total) in one pass over the table."""
    v = F.col(quoted(value))
    wide = df.groupBy(*by).agg(
        *bucket_counts(v, bounds), F.count(v).alias("observations"), F.sum(v).alias("total")
    )
    return unpivot_buckets(wide, [*by, "observations", "total"], bounds)


def latency_quantiles(df: DataFrame, value: str, probs: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """(quantile, value): exact, whatever the size of the table."""
    found = column_quantiles(df, [value], probs)[value]
    return df.sparkSession.createDataFrame(
        [(float(p), v) for p, v in zip(probs, found, strict=True)], "quantile double, value double"
    )


#: Magnitudes below this share the middle bucket of a sketch.
SMALLEST = 1e-9


def _gamma(error: float) -> float:
    return (1.0 + error) / (1.0 - error)


def sketch_bucket(value: Column, error: float) -> Column:
    """Number of a value's logarithmic bucket; buckets ascend with values, 0 holds those next to zero.

    All values of a bucket lie within the relative ``error`` of ``sketch_value``. NaN counts as infinite.
    """
    width, least = math.log(_gamma(error)), math.floor(math.log(SMALLEST) / math.log(_gamma(error)))
    size = F.least(F.abs(value.cast("double")), F.lit(sys.float_info.max))
    number = F.ceil(F.log(size) / F.lit(width)) - F.lit(least)
    return F.when(size < SMALLEST, F.lit(0).cast("bigint")).when(value < 0, -number).otherwise(number)


def sketch_value(bucket: Column, error: float) -> Column:
    """The value that stands for a bucket, within the relative ``error`` of all its values."""
    gamma, least = _gamma(error), math.floor(math.log(SMALLEST) / math.log(_gamma(error)))
    size = F.lit(2.0 / (gamma + 1.0)) * F.pow(F.lit(gamma), F.abs(bucket) + least)
    return F.when(bucket == 0, 0.0).when(bucket < 0, -size).otherwise(size)


def sketch_quantile(counts: DataFrame, by: Sequence[str], q: float, error: float, out: str = "value") -> DataFrame:
    """(by, n, out): the value at rank ``ceil(q * n)`` of each sketch ``(by, bucket, n)``.

    It is off by the relative ``error`` at most (values next to zero count as zero). Sketches of several
    sources are merged by adding up their counts.
    """
    merged = counts.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by)
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = merged.withColumns({"__upto": upto, "__n": F.sum("n").over(group)})
    reached = ranked.where(F.col("__upto") >= F.greatest(F.ceil(F.col("__n") * F.lit(q)), F.lit(1)))
    found = reached.groupBy(*by).agg(F.max("__n").alias("n"), F.min("bucket").alias("__bucket"))
    return found.select(*by, "n", sketch_value(F.col("__bucket"), error).alias(out))


def latency_check(df: DataFrame, value: str, budget: float, q: float = 0.99) -> DataFrame:
    return latency_quantiles(df, value, [q]).select(
        F.col("value").alias("p99"),
        F.lit(float(budget)).alias("budget"),
        (F.col("value") <= F.lit(float(budget))).alias("within_budget"),
    )
