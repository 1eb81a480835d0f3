"""Schema checks, projections and event validity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.labels import LABELS, label_id
from flowsift.functions.numeric import is_nonfinite
from flowsift.schema import FLOW_FEATURES, LABEL, PAYLOAD, quoted


def normalise_columns(df: DataFrame) -> DataFrame:
    """Trim column names; the first of Label, label, LABEL becomes ``Label``."""
    names = [c.strip() for c in df.columns]
    found = next((c for c in ("Label", "label", "LABEL") if c in names), None)
    return df.toDF(*[LABEL if c == found else c for c in names])


def require_columns(df: DataFrame, features: Sequence[str] = FLOW_FEATURES, label: str = LABEL) -> None:
    """Raise when the label or a feature column is missing; names the first five features."""
    if label not in df.columns:
        raise ValueError(f"no label column {label!r} among the columns")
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"{len(missing)} feature columns are missing, first: {missing[:5]}")


def schema_check(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row per required column: values that are NULL, and values that do not cast to its type."""
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"{len(missing)} required columns are missing, first: {missing[:5]}")
    counts = []
    for i, (name, kind) in enumerate(types.items()):
        c = F.col(quoted(name))
        counts.append(F.count_if(c.isNull()).alias(f"null_{i}"))
        counts.append(F.count_if(c.isNotNull() & c.try_cast(kind).isNull()).alias(f"bad_{i}"))
    one = df.agg(*counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"null_{i}").alias("null_values"),
                F.col(f"bad_{i}").alias("uncastable_values"),
            )
            for i, name in enumerate(types)
        ]
    )
    return one.select(F.inline(rows))


def project_canonical(
    df: DataFrame, features: Sequence[str] = FLOW_FEATURES, label: str = LABEL
) -> DataFrame:
    """Features and label in canonical order; raises when one is missing."""
    require_columns(df, features, label)
    return df.select(*[F.col(quoted(c)) for c in features], F.col(quoted(label)))


def reindex(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The named double columns in order: extras are dropped, absent ones become NULL."""
    present = set(df.columns)
    cols = [
        F.col(quoted(c)).cast("double").alias(c) if c in present else F.lit(None).cast("double").alias(c)
        for c in names
    ]
    return df.select(*[F.col(quoted(k)) for k in keep], *cols)


def encode_labels(df: DataFrame, label: str = LABEL, out: str = "class_id") -> DataFrame:
    """Append the class id; raises with the number of unknown labels and the first ones by name.

    ``unknown_labels`` lists them all.
    """
    found = unknown_labels(df, label)
    number = found.count()
    if number:
        first = [str(r["unknown_label"]) for r in found.orderBy("unknown_label").take(len(LABELS))]
        raise ValueError(f"{number} unknown labels, see unknown_labels: {sorted(first)}")
    return df.withColumn(out, label_id(F.col(quoted(label))))


def unknown_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Labels outside the label space with their row counts."""
    return (
        df.where(label_id(F.col(quoted(label))).isNull())
        .groupBy(F.col(quoted(label)).alias("unknown_label"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def cast_float32(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    wanted = set(cols)
    return df.select(
        *[F.col(quoted(c)).cast("float").alias(c) if c in wanted else F.col(quoted(c)) for c in df.columns]
    )


def count_nonfinite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: rows seen, cells that are missing, NaN or infinite, and rows holding such a cell."""
    bad = [is_nonfinite(F.col(quoted(c))) for c in cols]
    cells = sum((b.cast("bigint") for b in bad[1:]), bad[0].cast("bigint"))
    return df.select(cells.alias("__bad")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("__bad"), F.lit(0)).alias("bad_cells"),
        F.count_if(F.col("__bad") > 0).alias("bad_rows"),
    )


def is_valid_event(features: Column | str = "features", payload: Column | str = PAYLOAD) -> Column:
    """An event needs a non-empty feature map or a payload (the empty string is a payload)."""
    f = F.col(features) if isinstance(features, str) else features
    p = F.col(payload) if isinstance(payload, str) else payload
    return F.coalesce(F.size(f) > 0, F.lit(False)) | p.isNotNull()


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid events and rejected events."""
    return df.where(is_valid_event()), df.where(~is_valid_event())
