"""Margins of boosted trees for whole batches of rows.

A node that a row passes on its right side rules out the leaves of its left side. So a tree is one
bit set of leaves for each feature and range between cuts; the sets of a row's ranges are
intersected, and the first leaf that remains is the one the row reaches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Leaves of one bit set.
WORD = 64
#: Rows whose ranges and bit sets are held at once.
ROWS = 8192


@dataclass(frozen=True)
class Word:
    """Up to 64 leaves of one tree: a bit set by feature and range, and the leaves' weighted values."""

    last: bool
    sets: tuple[tuple[int, np.ndarray], ...]
    values: np.ndarray


def _leaves(nodes: dict[int, tuple], at: int, cuts: list[tuple], values: list[float]) -> tuple[int, int]:
    """First leaf below a node and the one after its last, numbered from left to right."""
    prediction, left, right, feature, threshold = nodes[at]
    if left < 0:
        values.append(prediction)
        return len(values) - 1, len(values)
    first, middle = _leaves(nodes, left, cuts, values)
    cuts.append((feature, threshold, first, middle))
    return first, _leaves(nodes, right, cuts, values)[1]


def _words(cuts: list[tuple], values: list[float], weight: float, bounds: Sequence[np.ndarray]) -> list[Word]:
    out = []
    for base in range(0, len(values), WORD):
        own = np.asarray(values[base : base + WORD]) * weight
        everything = (1 << len(own)) - 1
        sets = []
        for f in sorted({c[0] for c in cuts}):
            table = [everything] * (len(bounds[f]) + 1)
            for _, threshold, first, end in (c for c in cuts if c[0] == f):
                a, b = max(first - base, 0), min(end - base, len(own))
                if a < b:
                    lost = ((1 << (b - a)) - 1) << a
                    for i in range(int(np.searchsorted(bounds[f], threshold)) + 1, len(table)):
                        table[i] &= ~lost
            if any(t != everything for t in table):
                sets.append((f, np.array(table, np.uint64)))
        out.append(Word(base + WORD >= len(values), tuple(sets), own))
    return out


@dataclass(frozen=True)
class Ensemble:
    """Trees of several models over the same features; ``bounds`` are the sorted cuts of each feature."""

    bounds: tuple[np.ndarray, ...]
    models: tuple[tuple[Word, ...], ...]

    @classmethod
    def read(cls, spark: SparkSession, folders: Sequence[str], weights: Sequence[Sequence[float]], features: int) -> Ensemble:
        """Stored boosted models, one a folder, and the weights of their trees; a few hundred trees of bounded depth each."""
        columns = ["treeID AS tree", "nodeData.id", "nodeData.prediction", "nodeData.leftChild AS l", "nodeData.rightChild AS r"]
        columns += ["nodeData.split.featureIndex AS f", "get(nodeData.split.leftCategoriesOrThreshold, 0) AS t"]
        tables = [spark.read.parquet(f"{p}/data").selectExpr(f"{i} AS model", *columns) for i, p in enumerate(folders)]
        rows = reduce(DataFrame.unionByName, tables).toPandas()
        inner = rows[rows.l >= 0]
        bounds = tuple(np.unique(inner.t[inner.f == f].to_numpy(float)) for f in range(features))
        models: list[list[Word]] = [[] for _ in folders]
        for (model, tree), own in rows.sort_values(["model", "tree"]).groupby(["model", "tree"]):
            nodes = {n.id: (n.prediction, n.l, n.r, n.f, n.t) for n in own.itertuples()}
            cuts: list[tuple] = []
            values: list[float] = []
            _leaves(nodes, 0, cuts, values)
            models[model] += _words(cuts, values, weights[model][tree], bounds)
        return cls(bounds, tuple(map(tuple, models)))

    def margins(self, x: np.ndarray) -> np.ndarray:
        """One margin a row and model. A value equal to a cut goes left, NaN right, as MLlib has it."""
        out = np.zeros((len(x), len(self.models)))
        for a in range(0, len(x), ROWS):
            part = x[a : a + ROWS]
            ranges = [np.searchsorted(b, part[:, f]) for f, b in enumerate(self.bounds)]
            for m, words in enumerate(self.models):
                free = None
                for word in words:
                    left = np.full(len(part), (1 << len(word.values)) - 1, np.uint64)
                    for f, table in word.sets:
                        left &= table.take(ranges[f])
                    # the lowest bit alone is a power of two, which a double holds exactly
                    lowest = (left & (~left + np.uint64(1))).astype(float)
                    leaf = np.frexp(lowest)[1] - 1
                    if free is None and word.last:
                        out[a : a + ROWS, m] += word.values.take(leaf)
                        continue
                    free = np.ones(len(part), bool) if free is None else free
                    hit = free & (left != 0)
                    out[a : a + ROWS, m] += np.where(hit, word.values.take(leaf, mode="clip"), 0.0)
                    free = None if word.last else free & ~hit
        return out


def probabilities(ensemble: Ensemble, spark: SparkSession):
    """Column function: from a struct of the features, a struct ``p0, p1, ..`` of MLlib's probabilities of label 1."""
    shared = spark.sparkContext.broadcast(ensemble)
    names = [f"p{i}" for i in range(len(ensemble.models))]

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def score(x: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(over="ignore"):
            p = 1.0 / (1.0 + np.exp(-2.0 * shared.value.margins(x.to_numpy(float))))
        return pd.DataFrame(p, columns=names)

    return score
