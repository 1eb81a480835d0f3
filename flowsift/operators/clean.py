"""Row cleaning and exact deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.functions.numeric import finite
from flowsift.schema import FLOW_FEATURES, quoted


def inf_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN and infinite values of the chosen columns become NULL (default: all flow features present)."""
    chosen = set(FLOW_FEATURES if cols is None else cols)
    floating = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.select(
        *[
            finite(F.col(quoted(c))).alias(c) if c in chosen and c in floating else F.col(quoted(c))
            for c in df.columns
        ]
    )


def drop_all_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows in which every listed column is missing."""
    return df.where(F.coalesce(*[F.col(quoted(c)).cast("double") for c in cols]).isNotNull())


def dedup_exact(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows over all columns, missing equal to missing.

    Folding NaN to NULL comes first because Spark groups them apart. The aggregate collapses
    copies before the shuffle, so a row copied millions of times costs one row per task.
    """
    return inf_to_null(df, cols).dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row: total rows, distinct rows, surplus copies, and whether there are any."""
    groups = df.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))
    return groups.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("surplus_rows"),
        F.count_if(F.col("__copies") > 1).alias("duplicated_groups"),
    ).withColumn("has_duplicates", F.col("surplus_rows") > 0)


def clean_flows(
    df: DataFrame,
    cols: Sequence[str] = FLOW_FEATURES,
    drop_duplicates: bool = True,
    training: bool = True,
    rows_in: Observation | None = None,
    rows_out: Observation | None = None,
) -> DataFrame:
    """Clean raw flows.

    Training folds bad cells, removes exact copies and rows without any feature. Serving only folds
    bad cells: every event keeps its row. The observations receive row counts from the same pass.
    """
    if rows_in is not None:
        df = df.observe(rows_in, F.count(F.lit(1)).alias("rows"))
    present = [c for c in cols if c in df.columns]
    out = inf_to_null(df, present)
    if training:
        if drop_duplicates:
            out = out.dropDuplicates()
        out = drop_all_null(out, present)
    if rows_out is not None:
        out = out.observe(rows_out, F.count(F.lit(1)).alias("rows"))
    return out
