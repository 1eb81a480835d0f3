"""Isolation forest (Liu, Ting and Zhou 2008) grown and scored on Spark."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.numeric import threshold_flag
from flowsift.operators.fitting import column_quantiles
from flowsift.operators.samples import key_samples
from flowsift.schema import quoted

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left_node int, right_node int, path double"
)
EULER = 0.5772156649015329
# Rows that are scored at once.
ROWS = 1 << 14
Levelled = tuple[list[np.ndarray], int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def expected_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes of one tree over a subsample, as (node, feature, threshold, left, right, path)."""
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        me = len(nodes)
        if parent >= 0:
            nodes[parent][3 + side] = me
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            nodes.append([me, -1, 0.0, -1, -1, depth + expected_path(len(rows))])
            continue
        f = int(rng.choice(usable))
        cut = float(rng.uniform(low[f], high[f]))
        goes = x[rows, f] <= cut
        nodes.append([me, f, cut, -1, -1, 0.0])
        todo.append((rows[~goes], depth + 1, me, 1))
        todo.append((rows[goes], depth + 1, me, 0))
    return [tuple(n) for n in nodes]


def _paths(values: np.ndarray, levelled: Levelled) -> np.ndarray:
    """Summed paths of the rows; every row goes down as many levels in every tree, without a search for leaves."""
    n, bounds, depth, trees = len(values), *levelled
    # a value is not above a cut if no more cuts lie below it than below the cut; NaN is above all
    ranks = np.empty((len(bounds), n), np.int16 if max(map(len, bounds)) < 1 << 15 else np.int32)
    for f, cuts in enumerate(bounds):
        ranks[f] = np.searchsorted(cuts, values[:, f])
    flat, rows = ranks.reshape(-1), np.arange(n)
    total = np.zeros(n)
    for feature, place, path in trees:
        place, begin = place.astype(ranks.dtype), feature * n
        at = np.ones(n, np.intp)
        for level in range(depth):
            if level:
                cell = begin.take(at)
                cell += rows
                below = flat.take(cell) <= place.take(at)
            else:
                below = ranks[feature[1]] <= place[1]
            at += at
            at += below
        at -= 1 << depth
        total += path.take(at)
    return total


@dataclass(frozen=True)
class IsolationForest:
    """Flat node arrays of all trees: at most trees * 2 * subsample entries."""

    features: tuple[str, ...]
    subsample: int
    nodes: pd.DataFrame
    offset: float = 0.0

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        features: Sequence[str],
        keys: Sequence[str],
        trees: int = 200,
        max_samples: int = 256,
        seed: int = 0,
    ) -> IsolationForest:
        """Grow every tree on the rows of smallest hash, which differ from tree to tree."""
        total = df.count()
        size = min(max_samples, total)
        limit = max(1, math.ceil(math.log2(max(size, 2))))
        values = F.array(*[F.col(quoted(c)).cast("double") for c in features])
        rows = key_samples(df, keys, values, trees, size, seed)

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["sample"].iloc[0])
            pdf = pdf.sort_values("h").drop_duplicates("h")
            x = np.stack(pdf["x"].to_numpy())
            nodes = _grow(x, np.random.default_rng([seed, tree]), limit)
            out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left_node", "right_node", "path"])
            out.insert(0, "tree", tree)
            return out

        grown = rows.groupBy("sample").applyInPandas(grow, NODE_SCHEMA)
        nodes = grown.limit(trees * 2 * size).toPandas().sort_values(["tree", "node"], ignore_index=True)
        return cls(tuple(features), size, nodes)

    def raw_score(self, spark: SparkSession) -> Column:
        """2 ** (-mean path / c(subsample)): near 1 for outliers. One Arrow call per batch."""
        shared = spark.sparkContext.broadcast(self._levelled())
        scale = expected_path(self.subsample) or 1.0
        names = [f"x{i}" for i in range(len(self.features))]

        @F.arrow_udf("double")
        def score(x: pa.Array) -> pa.Array:
            levelled = shared.value
            out = np.empty(len(x))
            for a in range(0, len(x), ROWS):
                part = x.slice(a, ROWS)
                # NULL is read as NaN, which is on the right side of every cut
                values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.flatten()] or [np.zeros(len(part))])
                out[a : a + ROWS] = np.power(2.0, -(_paths(values, levelled) / len(levelled[2])) / scale)
            return pa.array(out)

        return score(F.struct(*[F.col(quoted(c)).cast("double").alias(n) for c, n in zip(self.features, names)]))

    def _levelled(self) -> Levelled:
        """The sorted cuts of each feature, the depth, and every tree as a full one.

        The root has place 1; below place p are 2p, for values above its cut, and 2p + 1. A leaf above the
        last level hands its path to all places below it.
        """
        inner = self.nodes[self.nodes["feature"] >= 0]
        bounds = [np.unique(inner["threshold"][inner["feature"] == f].to_numpy(float)) for f in range(len(self.features))]
        grown, depth = [], 0
        for _, own in self.nodes.groupby("tree", sort=True):
            feature, threshold, left, right = (own[c].to_numpy() for c in ("feature", "threshold", "left_node", "right_node"))
            levels = [np.zeros(1, np.int64)]
            while (feature[levels[-1]] >= 0).any():
                at = levels[-1]
                levels.append(np.stack([np.where(feature[at] >= 0, side[at], at) for side in (right, left)], axis=1).reshape(-1))
            rank = np.zeros(len(feature), np.int64)
            for f, cuts in enumerate(bounds):
                rank[feature == f] = np.searchsorted(cuts, threshold[feature == f])
            grown.append((feature, rank, own["path"].to_numpy(float), levels))
            depth = max(depth, len(levels) - 1)
        trees = []
        for feature, rank, path, levels in grown:
            levels = levels + [np.repeat(levels[-1], 2 ** (i + 1)) for i in range(depth + 1 - len(levels))]
            above = np.concatenate([np.zeros(1, np.int64), *levels[:-1]])
            trees.append((np.maximum(feature[above], 0).astype(np.intp), rank[above], path[levels[-1]]))
        return bounds, depth, trees

    def with_offset(self, scores: DataFrame, score: str, contamination: float) -> IsolationForest:
        """Cut at the (1 - contamination) quantile of training scores."""
        return IsolationForest(
            self.features, self.subsample, self.nodes, anomaly_offset(scores, score, contamination)
        )

    def score(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        """Append the score, shifted so that 0 is the cut and higher is more anomalous."""
        return df.withColumn(out, self.raw_score(df.sparkSession) - F.lit(self.offset))

    def to_table(self, spark: SparkSession) -> DataFrame:
        table = spark.createDataFrame(self.nodes, NODE_SCHEMA)
        return table.withColumns(
            {
                "features": F.array(*[F.lit(f) for f in self.features]),
                "subsample": F.lit(self.subsample),
                "offset": F.lit(self.offset),
            }
        )

    @classmethod
    def from_table(cls, table: DataFrame) -> IsolationForest:
        pdf = table.toPandas().sort_values(["tree", "node"], ignore_index=True)
        first = pdf.iloc[0]
        nodes = pdf[["tree", "node", "feature", "threshold", "left_node", "right_node", "path"]]
        return cls(tuple(first["features"]), int(first["subsample"]), nodes, float(first["offset"]))


def anomaly_offset(scores: DataFrame, score: str, contamination: float) -> float:
    return column_quantiles(scores, [score], [1.0 - contamination])[score][0]


def anomaly_flag(score: Column, offset: float = 0.0) -> Column:
    """1 above the cut, 0 otherwise."""
    return threshold_flag(score, offset)
