"""Exact ranks inside strata of any size.

``row_number`` over a stratum sends the whole stratum to one task. Here the uniform hexadecimal
sort key is cut into prefix buckets first. A histogram of the buckets gives every bucket its rank
offset, so a task only ever orders one bucket of one stratum. Rows with equal keys share their
side of a cut.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.operators.joins import small_table
from flowsift.schema import quoted

# 4096 buckets per stratum; one task orders 1/4096 of a stratum.
PREFIX = 3


def solid_strata(df: DataFrame, strata: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Append non-null text copies of the strata columns, so that a NULL stratum joins with itself.

    No strata at all means a single stratum.
    """
    if not strata:
        return df.withColumn("__stratum_0", F.lit("")), ["__stratum_0"]
    names = [f"__stratum_{i}" for i in range(len(strata))]
    texts = {
        n: F.coalesce(F.concat(F.lit("="), F.col(quoted(c)).cast("string")), F.lit("null"))
        for n, c in zip(names, strata, strict=True)
    }
    return df.withColumns(texts), names


def _histogram(df: DataFrame, strata: Sequence[str], key: str, prefix: int) -> DataFrame:
    """(strata, bucket, rows before the bucket, rows up to its end, rows of the stratum).

    At most 16**prefix rows per stratum.
    """
    counts = df.groupBy(*strata, F.substring(key, 1, prefix).alias("__bucket")).agg(
        F.count(F.lit(1)).alias("__rows")
    )
    whole = Window.partitionBy(*strata)
    run = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(
        *strata,
        "__bucket",
        (F.sum("__rows").over(run) - F.col("__rows")).alias("__before"),
        F.sum("__rows").over(run).alias("__upto"),
        F.sum("__rows").over(whole).alias("__n"),
    )


def key_cuts(
    df: DataFrame,
    strata: Sequence[str],
    key: str,
    ranks: Mapping[str, Callable[[Column], Column]],
    prefix: int = PREFIX,
) -> DataFrame:
    """Per stratum the row count ``n`` and the key found at each requested 1-based rank.

    ``ranks`` maps an output name to a function of ``n``. A rank of 0 yields NULL. Rows can then
    be assigned by comparing their key with the cut, without shuffling them. Strata columns must
    not be NULL (see ``solid_strata``).
    """
    names = list(ranks)
    n = F.col("__n")

    def rank(name: str) -> Column:
        return F.least(ranks[name](n), n).cast("bigint")

    per_stratum = _histogram(df, strata, key, prefix).groupBy(*strata, "__n").agg(
        *[
            F.min(
                F.when(
                    (rank(name) > 0) & (F.col("__upto") >= rank(name)),
                    F.struct("__bucket", "__before"),
                )
            ).alias(name)
            for name in names
        ]
    )
    local = small_table(per_stratum)
    hint = F.broadcast if local is not None else (lambda frame: frame)
    per_stratum = per_stratum if local is None else local

    asked = per_stratum.select(
        *strata,
        "__n",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("__name"),
                        F.col(f"{name}.__bucket").alias("__bucket"),
                        (rank(name) - F.col(f"{name}.__before")).alias("__rank"),
                    )
                    for name in names
                ]
            )
        ).alias("__w"),
    ).select(*strata, "__w.*").where(F.col("__bucket").isNotNull())
    crossed = asked.select(*strata, "__bucket")
    inside = Window.partitionBy(*strata, "__bucket").orderBy(key)
    candidates = (
        df.select(*strata, key, F.substring(key, 1, prefix).alias("__bucket"))
        .join(hint(crossed), [*strata, "__bucket"], "left_semi")
        .withColumn("__rank", F.row_number().over(inside).cast("bigint"))
    )
    cuts = (
        candidates.join(hint(asked), [*strata, "__bucket", "__rank"])
        .groupBy(*strata)
        .agg(*[F.max(F.when(F.col("__name") == name, F.col(key))).alias(name) for name in names])
    )
    return per_stratum.select(*strata, n.alias("n")).join(cuts, list(strata), "left")


def ranked(
    df: DataFrame, strata: Sequence[str], key: str, out: str = "rank", prefix: int = PREFIX
) -> DataFrame:
    """Append the exact 1-based rank of every row within its stratum, ordered by ``key``.

    Rows are shuffled once, by (strata, bucket); the join with the offsets and the window share
    that partitioning.
    """
    df, strata = solid_strata(df, strata)
    offsets = _histogram(df, strata, key, prefix).select(*strata, "__bucket", "__before")
    inside = Window.partitionBy(*strata, "__bucket").orderBy(key)
    return (
        df.withColumn("__bucket", F.substring(key, 1, prefix))
        .join(offsets, [*strata, "__bucket"])
        .withColumn(out, F.col("__before") + F.row_number().over(inside))
        .drop("__bucket", "__before", *strata)
    )
