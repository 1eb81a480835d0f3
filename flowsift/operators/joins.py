"""Joins of a wide frame with a dimension whose size is checked first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
SALTS = 64


def _size(value: object) -> int:
    if isinstance(value, (str, bytes, bytearray)):
        return len(value)
    if isinstance(value, (list, tuple)):
        return sum(_size(v) for v in value)
    if isinstance(value, dict):
        return sum(_size(k) + _size(v) for k, v in value.items())
    return 8


def small_table(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame | None:
    """The frame as a local table when it keeps to both bounds, else None.

    Rows are streamed to the driver and the reading stops at the first bound, so the check itself
    is bounded.
    """
    rows, size = [], 0
    for row in df.limit(max_rows + 1).toLocalIterator():
        rows.append(row)
        size += _size(tuple(row))
        if len(rows) > max_rows or size > max_bytes:
            return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def attach(
    wide: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join ``wide`` with a dimension unique on ``on``.

    A dimension counted small is broadcast and the wide side is not shuffled. A larger one is
    joined on (key, salt): one key may hold a third of the wide rows, and the salt spreads it.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    on = list(on)
    small = small_table(dim, max_rows)
    if small is not None:
        return wide.join(F.broadcast(small), on, how)
    return salted_join(wide, dim, on, how)


def salted_join(
    wide: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Shuffle join that spreads every key of ``wide``, whatever its columns, over ``salts`` partitions."""
    on = list(on)
    left = wide.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    right = dim.select("*", copies.alias("__salt"))
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition rows that are about to expand, such as texts into n-grams.

    The partition count is fixed, because adaptive execution would merge partitions by their size
    before the expansion.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count, *keys)
