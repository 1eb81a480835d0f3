"""Column statistics and the fitted transforms built on them.

Fitted parameters are one value per feature, so they are held on the driver and applied as
literals: a transform is one projection without a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowsift.functions.numeric import finite
from flowsift.operators.columns import reindex
from flowsift.operators.joins import attach
from flowsift.schema import quoted
from flowsift.session import stage

# Equal parts of a range that is still too full.
PARTS = 4096
# Bits of a double below its first 8 binary digits, and the bits of infinity.
RANGE_SHIFT, INFINITE = 44, 0x7FF << 52
# Partial counts of a column that a task merges at once, and distinct values that it holds.
MERGED, HELD = 64, 1 << 20
# Distinct values of one range that one task puts in order.
ORDERED_VALUES = 1_000_000


def _ranks(wanted: Mapping[tuple[int, int], float]) -> dict[int, set[int]]:
    """Ranks, from 1, that the positions of each column lie between."""
    out: dict[int, set[int]] = {}
    for (i, _), position in wanted.items():
        out.setdefault(i, set()).update((math.floor(position) + 1, math.ceil(position) + 1))
    return out


def _holding(counts: DataFrame, ranks: Mapping[int, set[int]], by: str, given: Mapping[int, int] | None = None) -> DataFrame:
    """Rows of ``n, by, rows`` that hold a wanted rank of their ``n``, with the rows before them.

    The wanted ranks are two per column and probability, a table of bounded size.
    """
    asked = [(n, rank, (given or {}).get(n, 0)) for n, at in ranks.items() for rank in sorted(at)]
    table = F.broadcast(counts.sparkSession.createDataFrame(asked, "n int, rank bigint, offset bigint"))
    order = Window.partitionBy("n").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = counts.withColumn("run", F.sum("rows").over(order)).join(table, "n")
    run = run.withColumn("upto", F.col("run") + F.col("offset")).withColumn("before", F.col("upto") - F.col("rows"))
    return run.where("before < rank AND upto >= rank").drop("run", "rank", "offset").distinct()


def _counted(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their rows, of several such pairs."""
    values, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    rows = np.zeros(len(values), np.int64)
    np.add.at(rows, back, np.concatenate([f[1] for f in found]))
    return values, rows


def _count_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(n, range, rows)`` of a task; NULL and NaN are left out."""
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for n, column in enumerate(batch.columns):
            v = column.to_numpy(zero_copy_only=False)
            v = v[~np.isnan(v)]
            # the exponent and the first 8 binary digits of the fraction
            size = np.abs(v).view(np.int64) >> RANGE_SHIFT
            own = found.setdefault(n, [])
            own.append(np.unique(np.where(v < 0, -1 - size, np.where(v > 0, size + 1, 0)), return_counts=True))
            if len(own) > MERGED:
                found[n] = [_counted(own)]
    for n, own in found.items():
        ranges, rows = _counted(own)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), n, np.int32)), pa.array(ranges), pa.array(rows)], ["n", "range", "rows"])


def _range_ends(number: int) -> tuple[float, float]:
    """The smallest and the largest value that a range may hold."""
    if number == 0:
        return 0.0, 0.0
    first = abs(number) - 1
    ends = np.array([max(first << RANGE_SHIFT, 1), min(((first + 1) << RANGE_SHIFT) - 1, INFINITE)], np.int64).view(float)
    low, high = float(ends[0]), float(ends[1])
    return (low, high) if number > 0 else (-high, -low)


def _count_values(spots: Sequence[tuple[int, float, float]]):
    """``(n, v, rows)``: the values inside every spot ``(column, low, high)``; a task holds a bounded number at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            for n, own in found.items():
                values, rows = _counted(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), n, np.int32)), pa.array(values), pa.array(rows)], ["n", "v", "rows"])

        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in {s[0] for s in spots}}
            for n, (c, low, high) in enumerate(spots):
                v = columns[c]
                # zero of either sign is one value
                values, rows = np.unique(v[(v >= low) & (v <= high)] + 0.0, return_counts=True)
                if len(values):
                    found.setdefault(n, []).append((values, rows))
                    held += len(values)
            if held > HELD:
                found = {n: [_counted(own)] for n, own in found.items()}
                held = sum(len(own[0][0]) for own in found.values())
                if held > HELD // 2:
                    yield from out()
                    found, held = {}, 0
        yield from out()

    return run


def column_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], ordered_values: int = ORDERED_VALUES
) -> dict[str, list[float | None]]:
    """Exact quantiles (linear interpolation) of several columns; NULL and NaN are ignored.

    The first pass counts values per range, 256 to every power of two and sign, inside the tasks
    before the shuffle. The second counts the distinct values of the ranges that hold a wanted rank. A
    range of more distinct values than one task should order is counted again in equal parts, until
    its part is small. Every table takes this way. A frame that is dear to compute should be staged
    first: each pass reads it.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    cells = df.select(*[F.col(quoted(c)).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    counted = cells.mapInArrow(_count_ranges, "n int, range bigint, rows bigint")
    ranges = stage(counted.groupBy("n", "range").agg(F.sum("rows").alias("rows")), "quantile-ranges")
    totals = {r["n"]: r["rows"] for r in ranges.groupBy("n").agg(F.sum("rows").alias("rows")).collect()}
    wanted = {(i, j): p * (totals[i] - 1) for i in totals for j, p in enumerate(probs)}
    ranks = _ranks(wanted)
    # spots: the column, its rows before the spot and up to its end, the smallest and largest value
    spots = [(r["n"], r["before"], r["upto"], *_range_ends(r["range"])) for r in _holding(ranges, ranks, "range").collect()]
    found: dict[tuple[int, int], float] = {}
    while spots:
        inner = {n: {r for r in ranks[s[0]] if s[1] < r <= s[2]} for n, s in enumerate(spots)}
        before = {n: s[1] for n, s in enumerate(spots)}
        picked = cells.mapInArrow(_count_values([(s[0], s[3], s[4]) for s in spots]), "n int, v double, rows bigint")
        counts = stage(picked.groupBy("n", "v").agg(F.sum("rows").alias("rows")), "quantile-values")
        sizes = {r["n"]: r["values"] for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("values")).collect()}
        small = [n for n in sizes if sizes[n] <= max(ordered_values, 2)]
        if small:
            hits = _holding(counts.where(F.col("n").isin(small)), {n: inner[n] for n in small}, "v", before)
            for r in hits.collect():
                found.update({(spots[r["n"]][0], rank): r["v"] for rank in inner[r["n"]] if r["before"] < rank <= r["upto"]})
        full = [n for n in sizes if n not in small]
        if not full:
            break
        low, high = (F.element_at(F.create_map(*[F.lit(x) for n in full for x in (n, spots[n][k])]), F.col("n")) for k in (3, 4))
        part = F.least(F.floor((F.col("v") / 2 - low / 2) / (high / 2 - low / 2) * PARTS), F.lit(PARTS - 1))
        parts = counts.where(F.col("n").isin(full)).groupBy("n", part.alias("part")).agg(F.sum("rows").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
        nearer = _holding(parts, {n: inner[n] for n in full}, "part", before).collect()
        spots = [(spots[r["n"]][0], r["before"], r["upto"], r["low"], r["high"]) for r in nearer]

    def at(i: int, j: int) -> float | None:
        if i not in totals:
            return None
        position = wanted[i, j]
        first, last = math.floor(position), math.ceil(position)
        a, b = found[i, first + 1], found[i, last + 1]
        return a if a == b else (last - position) * a + (position - first) * b

    return {c: [at(i, j) for j in range(len(probs))] for i, c in enumerate(cols)}


def column_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Most frequent value per column, the smallest on ties; counted before the shuffle."""
    melted = df.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("feature"), F.col(quoted(c)).cast("double").alias("v")) for c in cols]
            )
        )
    ).where(F.col("v").isNotNull())
    counts = melted.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("rows"))
    best = counts.groupBy("feature").agg(
        F.max_by("v", F.struct(F.col("rows"), (-F.col("v")).alias("least"))).alias("v")
    )
    found = {r["feature"]: r["v"] for r in best.collect()}
    return {c: found.get(c) for c in cols}


def fit_imputer(
    df: DataFrame, cols: Sequence[str], strategy: str = "median"
) -> dict[str, float]:
    """Fill value per column; 0 for a column without any value."""
    if strategy == "median":
        fills = {c: q[0] for c, q in column_quantiles(df, cols, [0.5]).items()}
    elif strategy == "mean":
        row = df.agg(*[F.avg(F.col(quoted(c))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        fills = dict(zip(cols, row, strict=True))
    elif strategy == "most_frequent":
        fills = column_modes(df, cols)
    else:
        raise ValueError(f"unknown imputer strategy: {strategy}")
    return {c: 0.0 if fills[c] is None else float(fills[c]) for c in cols}


def filled(c: str, fills: Mapping[str, float]) -> Column:
    return F.coalesce(F.col(quoted(c)), F.lit(float(fills[c])))


def apply_imputer(df: DataFrame, fills: Mapping[str, float]) -> DataFrame:
    return df.select(*[filled(c, fills).alias(c) if c in fills else F.col(quoted(c)) for c in df.columns])


def fit_scaler(
    df: DataFrame, cols: Sequence[str], kind: str = "standard"
) -> dict[str, tuple[float, float]]:
    """(center, scale) per column; a scale of zero becomes 1.

    standard: mean and population deviation. robust: median and the 25-75 range. none: unchanged.
    """
    if kind == "none":
        return {c: (0.0, 1.0) for c in cols}
    if kind == "standard":
        row = df.agg(
            *[F.avg(F.col(quoted(c))).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.stddev_pop(F.col(quoted(c))).alias(f"s{i}") for i, c in enumerate(cols)],
        ).first()
        pairs = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}
    elif kind == "robust":
        quartiles = column_quantiles(df, cols, [0.25, 0.5, 0.75])
        pairs = {c: (q[1], None if q[1] is None else q[2] - q[0]) for c, q in quartiles.items()}
    else:
        raise ValueError(f"unknown scaler: {kind}")
    return {c: (float(m or 0.0), float(s) if s else 1.0) for c, (m, s) in pairs.items()}


def apply_scaler(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    def scaled(c: str) -> Column:
        center, scale = scaler[c]
        return ((F.col(quoted(c)) - F.lit(center)) / F.lit(scale)).alias(c)

    return df.select(*[scaled(c) if c in scaler else F.col(quoted(c)) for c in df.columns])


PARAMS_VERSION = 1


@dataclass(frozen=True)
class Preprocessor:
    """reindex -> fold bad cells -> impute -> scale, fitted on training rows only."""

    features: tuple[str, ...]
    strategy: str = "median"
    scaler: str = "standard"
    fills: Mapping[str, float] = field(default_factory=dict)
    scales: Mapping[str, tuple[float, float]] = field(default_factory=dict)

    @property
    def fitted(self) -> bool:
        return bool(self.fills)

    def _clean(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        lenient = reindex(df, self.features, keep)
        return lenient.select(
            *[F.col(quoted(k)) for k in keep], *[finite(F.col(quoted(c))).alias(c) for c in self.features]
        )

    def fit(self, train: DataFrame) -> Preprocessor:
        clean = self._clean(train, ())
        fills = fit_imputer(clean, self.features, self.strategy)
        scales = fit_scaler(apply_imputer(clean, fills), self.features, self.scaler)
        return Preprocessor(self.features, self.strategy, self.scaler, fills, scales)

    def transform(self, df: DataFrame, keep: Sequence[str] = (), as_float: bool = True) -> DataFrame:
        """The ``keep`` columns followed by the scaled features; one projection."""
        if not self.fitted:
            raise RuntimeError("the preprocessor is not fitted")
        lenient = reindex(df, self.features, keep)

        def scaled(c: str) -> Column:
            center, scale = self.scales[c]
            value = F.coalesce(finite(F.col(quoted(c))), F.lit(float(self.fills[c])))
            out = (value - F.lit(center)) / F.lit(scale)
            return (out.cast("float") if as_float else out).alias(c)

        return lenient.select(*[F.col(quoted(k)) for k in keep], *[scaled(c) for c in self.features])

    def to_table(self, spark: SparkSession) -> DataFrame:
        """One row per feature: position, fill, center, scale, and the settings they came from."""
        if not self.fitted:
            raise RuntimeError("refusing to save an unfitted preprocessor")
        rows = [
            (PARAMS_VERSION, i, c, self.strategy, self.scaler, float(self.fills[c]), *map(float, self.scales[c]))
            for i, c in enumerate(self.features)
        ]
        return spark.createDataFrame(
            rows,
            "version int, position int, feature string, strategy string, scaler string, "
            "fill double, center double, scale double",
        )

    @classmethod
    def from_table(cls, table: DataFrame) -> Preprocessor:
        rows = table.orderBy("position").collect()
        versions = sorted({r["version"] for r in rows})
        if versions != [PARAMS_VERSION]:
            raise ValueError(f"parameter table has versions {versions}, expected [{PARAMS_VERSION}]")
        return cls(
            tuple(r["feature"] for r in rows),
            rows[0]["strategy"],
            rows[0]["scaler"],
            {r["feature"]: r["fill"] for r in rows},
            {r["feature"]: (r["center"], r["scale"]) for r in rows},
        )


def prevalence(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.avg(F.col(target).cast("double")).alias("prevalence"))


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Append N / (classes present * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__rows"))
    stats = counts.agg(F.sum("__rows").alias("n"), F.count(F.lit(1)).alias("k")).first()
    weights = counts.select(
        label, (F.lit(float(stats["n"] or 0)) / (F.lit(int(stats["k"])) * F.col("__rows"))).alias(out)
    )
    return attach(df, weights, [label], how="left")


def positive_weight(df: DataFrame, target: str) -> DataFrame:
    """Negatives per positive, at least one positive assumed."""
    positives = F.count_if(F.col(target) == 1)
    return df.agg(
        ((F.count(F.lit(1)) - positives) / F.greatest(positives, F.lit(1)).cast("double")).alias("pos_weight")
    )


def contamination(df: DataFrame, target: str, setting: float | str = "auto") -> DataFrame:
    """Expected share of anomalies: the prevalence held within [0.001, 0.5], or the given value."""
    if setting != "auto":
        value = F.lit(float(setting))
        return df.limit(1).agg(F.max(value).alias("contamination"))
    rate = F.avg(F.col(target).cast("double"))
    return df.agg(F.least(F.greatest(rate, F.lit(1e-3)), F.lit(0.5)).alias("contamination"))


def minmax_average(df: DataFrame, cols: Sequence[str], out: str = "average") -> DataFrame:
    """Append the row mean of the columns, each scaled to [0, 1] over the whole table."""
    bounds = df.agg(
        *[F.min(F.col(quoted(c))).alias(f"lo{i}") for i, c in enumerate(cols)],
        *[F.max(F.col(quoted(c))).alias(f"hi{i}") for i, c in enumerate(cols)],
    ).first()
    total = F.lit(0.0)
    for i, c in enumerate(cols):
        lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
        if lo is None:
            continue
        total = total + (F.col(quoted(c)) - F.lit(lo)) / F.lit(float(hi - lo) or 1.0)
    return df.withColumn(out, total / F.lit(float(len(cols))))
