"""Boosted trees over every row of a table, the models of all classes side by side.

The method is that of MLlib's ``GBTClassifier``: the first tree fits the labels -1 and 1, the next ones
the gradient of the logistic loss; splits lower the variance most; validation rows stop the boosting.
MLlib fits one class at a time and takes one pass over the rows for each level of each tree. Here one
pass serves the trees of all classes. Rows are kept as one byte a feature, and of two sibling nodes
only the one of fewer rows is counted.

All sums are of whole multiples of ``UNIT``, so they do not depend on the order of rows or tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.schema import quoted
from flowsift.session import scratch_dir, stage

#: Rows of a block, and blocks of a task at most.
ROWS, BLOCKS = 1 << 16, 64
#: Ranges of a feature at most; a row's range is one byte.
BINS = 256
#: Sums are exact up to 2^53 of these.
UNIT = 2.0**-20
#: Low bits of a value that the first count of its cell leaves out, and bits that each further count adds.
SHIFT, FINER = 44, 8
#: Nodes of one class whose sums are held at once.
HELD = 64
#: Bytes of sums that the driver adds itself at most; beyond them tasks do.
ADDED = 1 << 26
#: Rounds after which the rows' margins are written, which cuts their lineage.
WRITTEN = 20
#: Relative gain on validation rows below which boosting stops, and the least error that counts (MLlib's).
TOLERANCE, LEAST_ERROR = 0.01, 0.01
#: Share of a node's own term that a split must gain; less is rounding.
ROUNDING = 1e-10
GOLDEN = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _order(x: np.ndarray) -> np.ndarray:
    """Integers in the order of the values; applied to its own result's bits it gives the values back."""
    bits = (x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _value(keys: np.ndarray) -> np.ndarray:
    return (keys ^ ((keys >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)


def _column(column: pa.Array) -> np.ndarray:
    x = column.to_numpy(zero_copy_only=False).astype(float)
    if np.isnan(x).any():
        raise ValueError("features of a boosted fit hold NULL or NaN")
    return x


def _merged(parts: Sequence[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Counts, smallest and largest key by cell."""
    cell, n, low, high = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(cell, kind="stable")
    cell, n, low, high = cell[order], n[order], low[order], high[order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
    if not len(first):
        return cell, n, low, high
    return cell[first], np.add.reduceat(n, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)


def _cells(shift: int, coarser: int, wide: Sequence[np.ndarray] | None):
    """(feature, cell, n, low, high) of a task's rows; with ``wide`` only of values in those coarser cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for f, column in enumerate(batch.columns):
                keys = _order(_column(column))
                if wide is not None:
                    keys = keys[np.isin(keys >> coarser, wide[f])]
                one = np.ones(len(keys), np.int64)
                parts = found.setdefault(f, [])
                parts.append(_merged([(keys >> shift, one, keys, keys)]))
                if len(parts) > 64:
                    found[f] = [_merged(parts)]
        for f, parts in found.items():
            columns = [pa.array(c) for c in _merged(parts)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), f, np.int32)), *columns], ["feature", "cell", "n", "low", "high"])

    return run


def cut_points(rows: DataFrame, features: Sequence[str], bins: int) -> tuple[np.ndarray, ...]:
    """Sorted cuts of each feature, at most ``bins - 1``, that part all its values into ranges of like numbers.

    A feature of no more distinct cells than ``bins`` is cut between all of them. Values are counted in cells of
    256 a power of two; cells of more than a quarter of a range are counted again in finer ones, down to
    single values.
    """
    bins = min(bins, BINS)
    columns = rows.select(*[F.col(quoted(c)).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    closed: list[list] = [[] for _ in features]
    shift, coarser, wide, limit = SHIFT, SHIFT, None, None
    while True:
        counted = columns.mapInArrow(_cells(shift, coarser, wide), "feature int, cell bigint, n bigint, low bigint, high bigint")
        counted = counted.groupBy("feature", "cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        feature, cell, n, low, high = (c.to_numpy() for c in counted.toArrow().columns)
        if limit is None:
            limit = max(int(n[feature == 0].sum()) // (4 * bins), 1)
        again = (n > limit) & (low < high)
        for f in range(len(features)):
            own = (feature == f) & ~again
            closed[f].append((low[own], high[own], n[own]))
        if not again.any():
            break
        wide = [np.unique(cell[again & (feature == f)]) for f in range(len(features))]
        # a cell without low bits is one value
        shift, coarser = max(shift - FINER, 0), shift
    return tuple(_cuts(*(np.concatenate(c) for c in zip(*parts)), bins) for parts in closed)


def _cuts(low: np.ndarray, high: np.ndarray, n: np.ndarray, bins: int) -> np.ndarray:
    """Cuts midway between the values on their sides."""
    order = np.argsort(low)
    low, high, upto = low[order], high[order], np.cumsum(n[order])
    if len(low) <= bins:
        at = np.arange(len(low) - 1)
    else:
        at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, bins) / bins))
        at = at[at < len(low) - 1]
    a, b = _value(high[at]), _value(low[at + 1])
    with np.errstate(over="ignore", invalid="ignore"):
        middle = a / 2 + b / 2
    return np.unique(np.where((middle >= a) & (middle < b), middle, a))


@dataclass(frozen=True)
class Block:
    """Rows by column: ranges of the features, class, whether they validate, weight, draw key; and margins by class."""

    bins: np.ndarray
    y: np.ndarray
    held: np.ndarray
    weight: np.ndarray
    key: np.ndarray
    margins: np.ndarray

    def drawn(self, turn: int, share: float) -> np.ndarray:
        """Training rows that a round takes."""
        chosen = ~self.held
        if share < 1.0:
            with np.errstate(over="ignore"):
                h = _mixed(self.key.astype(np.uint64) + np.uint64((turn + 1) * GOLDEN % (1 << 64)))
            chosen &= h < np.uint64(int(share * (1 << 63)) * 2)
        return np.flatnonzero(chosen)

    def gradient(self, model: int, rows: np.ndarray, first: bool) -> np.ndarray:
        """What the next tree fits, by weight in units."""
        side = np.where(self.y.take(rows) == model, np.float32(1), np.float32(-1))
        if first:
            g = side.astype(float)
        else:
            with np.errstate(over="ignore"):
                g = (4 * side / (1 + np.exp(2 * side * self.margins[model].take(rows)))).astype(float)
        return np.rint(g * self.weight.take(rows) / UNIT)

    def loss(self, model: int, rows: np.ndarray) -> float:
        side = np.where(self.y.take(rows) == model, 1.0, -1.0)
        each = 2 * np.logaddexp(0.0, -2 * side * self.margins[model].take(rows))
        return float(np.rint(each * self.weight.take(rows) / UNIT).sum())


def _blocks(cuts: Sequence[np.ndarray], classes: Sequence[int], seed: int):
    """Binary columns of blocks. A row's draw key is a hash of its values and, among equal rows, its number."""
    schema = pa.schema([("n", pa.int32()), *[(c, pa.binary()) for c in ("bins", "y", "held", "weight", "key")]])
    number = {c: i for i, c in enumerate(classes)}

    def block(columns: Sequence[np.ndarray]) -> pa.RecordBatch:
        *x, y, weight, held, key = columns
        bins = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x)]).astype(np.uint8)
        order = np.argsort(key, kind="stable")
        first = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        nth = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        copies = np.empty(len(key), np.uint64)
        copies[order] = nth.astype(np.uint64)
        with np.errstate(over="ignore"):
            key = _mixed(_mixed(key.view(np.uint64) + np.uint64(seed % (1 << 63))) + copies * np.uint64(GOLDEN))
        # a class that only validation rows have is none of the models'
        y = np.array([number.get(c, 255) for c in y.tolist()], np.uint8)
        arrays = [bins, y, held.astype(bool), weight.astype(np.float32), (key >> np.uint64(32)).astype(np.uint32)]
        return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                read = [_column(c) for c in batch.columns[: len(cuts)]]
                waiting.append(read + [c.to_numpy(zero_copy_only=False) for c in batch.columns[len(cuts) :]])
                rows += batch.num_rows
            if rows >= ROWS:
                yield block([np.concatenate(c) for c in zip(*waiting)])
                waiting, rows = [], 0
        if rows:
            yield block([np.concatenate(c) for c in zip(*waiting)])

    return run


def _read_block(row, features: int, classes: int) -> Block:
    y, held, weight, key = (np.frombuffer(row[c], t) for c, t in (("y", np.uint8), ("held", bool), ("weight", np.float32), ("key", np.uint32)))
    bins = np.frombuffer(row["bins"], np.uint8).reshape(features, row["n"])
    return Block(bins, y, held, weight, key, np.zeros((classes, row["n"]), np.float32))


@dataclass
class Tree:
    """Nodes in the order of their making, so children come after their parent; a leaf is its own child."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    sums: list[np.ndarray] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, sums: np.ndarray) -> int:
        """A leaf from its sums of gradients, weights and rows."""
        me = len(self.feature)
        for values, v in ((self.feature, 0), (self.cut, BINS), (self.left, me), (self.right, me), (self.sums, sums), (self.gain, -1.0)):
            values.append(v)
        return me

    def split(self, node: int, feature: int, cut: int, gain: float, left: np.ndarray) -> tuple[int, int]:
        a, b = self.add(left), self.add(self.sums[node] - left)
        self.feature[node], self.cut[node], self.gain[node], self.left[node], self.right[node] = feature, cut, gain, a, b
        return a, b

    def values(self) -> np.ndarray:
        return np.array([s[0] / s[1] if s[1] else 0.0 for s in self.sums])

    def paths(self) -> Paths:
        return Paths(np.array(self.feature), np.array(self.cut, np.int16), np.array([self.left, self.right]).T.reshape(-1))


@dataclass(frozen=True)
class Paths:
    """The nodes of a tree as arrays."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray

    def walk(self, bins: np.ndarray, rows: np.ndarray, levels: int) -> np.ndarray:
        """The nodes that the rows reach after some levels."""
        flat, begin = bins.reshape(-1), self.feature * bins.shape[1]
        at = np.zeros(len(rows), np.intp)
        for _ in range(levels):
            above = flat.take(begin.take(at) + rows) > self.cut.take(at)
            at += at
            at += above
            at = self.child.take(at)
        return at


#: Of a model, what its next sums are taken of: its tree so far, the levels to walk, and each node's place (-1: none).
Asked = tuple[Paths, int, np.ndarray]


def _sum_roots(blocks: Iterable[Block], turn: int, share: float, models: Sequence[int], first: bool) -> Iterator[tuple]:
    """By model, gradients at the root and the loss of validation rows; under -1 weights and rows, which all models share."""
    out: dict[int, list] = {}
    for block in blocks:
        rows, held = block.drawn(turn, share), np.flatnonzero(block.held)
        values = {m: block.gradient(m, rows, first) for m in models}
        weight = np.rint(block.weight.take(rows).astype(float) / UNIT)
        shared = out.setdefault(-1, [np.zeros((2, len(block.bins), BINS)), 0.0])
        for f, of_rows in enumerate(block.bins):
            at = of_rows.take(rows).astype(np.intp)
            shared[0][0, f] += np.bincount(at, weight, BINS)
            shared[0][1, f] += np.bincount(at, minlength=BINS)
            for m in models:
                own = out.setdefault(m, [np.zeros((len(block.bins), BINS)), 0.0])
                own[0][f] += np.bincount(at, values[m], BINS)
        shared[1] += float(np.rint(block.weight.take(held).astype(float) / UNIT).sum())
        for m in models if len(held) else ():
            out[m][1] += block.loss(m, held)
    return iter(out.items())


def _sum_nodes(blocks: Iterable[Block], turn: int, share: float, asked: dict[int, Asked], first: bool) -> Iterator[tuple]:
    """By model, gradients, weights and rows by feature, place and range."""
    out: dict[int, list] = {}
    for block in blocks:
        drawn = block.drawn(turn, share)
        for m, (paths, levels, places) in asked.items():
            place = places.take(paths.walk(block.bins, drawn, levels))
            found = np.flatnonzero(place >= 0)
            rows, begin = drawn.take(found), place.take(found) * BINS
            width = (int(places.max()) + 1) * BINS
            total = out.setdefault(m, [np.zeros((3, len(block.bins), width)), 0.0])[0]
            g, weight = block.gradient(m, rows, first), np.rint(block.weight.take(rows).astype(float) / UNIT)
            for f, of_rows in enumerate(block.bins):
                at = begin + of_rows.take(rows)
                total[0, f] += np.bincount(at, g, width)
                total[1, f] += np.bincount(at, weight, width)
                total[2, f] += np.bincount(at, minlength=width)
    return iter(out.items())


def _add(a: list, b: list) -> list:
    return [a[0] + b[0], a[1] + b[1]]


def _moved(block: Block, trees: dict[int, tuple[Paths, np.ndarray, int]]) -> Block:
    """The block after a round: margins moved by each model's tree."""
    margins, every = block.margins.copy(), np.arange(block.bins.shape[1])
    for m, (paths, values, levels) in trees.items():
        margins[m] += values.take(paths.walk(block.bins, every, levels)).astype(np.float32)
    return replace(block, margins=margins)


def _best(sums: np.ndarray, allowed: np.ndarray, ranges: np.ndarray, least: int) -> tuple[int, int, float, np.ndarray] | None:
    """Feature, cut, gain and left sums of the split of a node (gradients, weights, rows by feature and range)."""
    left = np.cumsum(sums, axis=2)
    whole = left[:, :1, -1:]
    right = whole - left
    usable = (left[2] >= least) & (right[2] >= least) & (left[1] > 0) & (right[1] > 0) & allowed[:, None] & (np.arange(BINS) < ranges[:, None] - 1)
    if not usable.any():
        return None
    own = float(whole[0, 0, 0] ** 2 / whole[1, 0, 0])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(usable, left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - own, -np.inf)
    f, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
    best = float(gain[f, cut])
    if not best > ROUNDING * own:
        return None
    return int(f), int(cut), best / float(whole[1, 0, 0]), left[:, f, cut].copy()


def _summed(state: RDD, take, models: int, width: int, places: int = 1) -> dict[int, list]:
    """Sums of all tasks by model. Those of few tasks are added by the driver, as a shuffle would cost more than the pass."""
    found = state.mapPartitions(take)
    if state.getNumPartitions() * models * places * 3 * width * BINS * 8 > ADDED:
        return dict(found.reduceByKey(_add, models).collect())
    out: dict[int, list] = {}
    for m, sums in found.collect():
        out[m] = _add(out[m], sums) if m in out else sums
    return out


def _grow(state: RDD, roots: dict[int, np.ndarray], turn: int, settings, ranges: np.ndarray, seed: int, first: bool) -> dict[int, Tree]:
    """One tree for each model, level by level; ``roots`` are the sums of its root."""
    width = len(ranges)
    share = max(1, int(np.ceil(settings.column_share * width)))
    trees, open_nodes = {m: Tree() for m in roots}, {}
    for m, sums in roots.items():
        open_nodes[m] = {trees[m].add(sums[:, 0].sum(axis=1)): sums}
    for level in range(1, settings.max_depth + 1):
        pairs = []
        for m, nodes in open_nodes.items():
            for node, sums in nodes.items():
                rng = np.random.default_rng([seed, turn, m, node])
                allowed = np.zeros(width, bool)
                allowed[rng.permutation(width)[:share]] = True
                best = _best(sums, allowed, ranges, settings.min_weight)
                if best:
                    a, b = trees[m].split(node, *best)
                    fewer, more = (a, b) if trees[m].sums[a][2] <= trees[m].sums[b][2] else (b, a)
                    pairs.append((m, fewer, more, sums))
        open_nodes = {}
        if level == settings.max_depth:
            break
        while pairs:
            # what is not held at once comes with the next pass
            now, later, count = [], [], dict.fromkeys(trees, 0)
            for pair in pairs:
                count[pair[0]] += 1
                (now if count[pair[0]] <= HELD else later).append(pair)
            asked: dict[int, Asked] = {}
            for m in sorted({p[0] for p in now}):
                places = np.full(len(trees[m].feature), -1)
                own = [p[1] for p in now if p[0] == m]
                places[own] = np.arange(len(own))
                asked[m] = (trees[m].paths(), level, places)
            found = _summed(state, lambda blocks, a=asked: _sum_nodes(blocks, turn, settings.subsample, a, first), len(asked), width, min(max(count.values()), HELD))
            for m, fewer, more, sums in now:
                at = int(asked[m][2][fewer]) * BINS
                mine = found[m][0][:, :, at : at + BINS]
                open_nodes.setdefault(m, {})[fewer] = mine
                open_nodes[m][more] = sums - mine
            pairs = later
    return trees


def boost(data: DataFrame, features: Sequence[str], classes: Sequence[int], settings, seed: int) -> tuple[tuple[np.ndarray, ...], list[list[Tree]]]:
    """Cuts of the features and the trees of every class against the rest.

    ``data`` has the features, ``__y`` (class id), ``weight`` and ``__val``. A round's trees see ``subsample`` of the
    training rows, drawn by a hash. Boosting of a class stops at the first round that gains less than MLlib's
    tolerance on the validation rows, and keeps the best rounds; without such rows it takes all rounds. Only
    sums by node, feature and range reach the driver, whatever the number of rows.
    """
    spark = data.sparkSession
    x = [F.col(quoted(c)).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    cuts = cut_points(data.where(~F.col("__val")), features, settings.bins)
    key = F.xxhash64(*x, "__y").alias("key")
    rows = data.select(*x, F.col("__y").cast("int").alias("y"), F.col("weight").cast("double").alias("w"), F.col("__val").alias("v"), key)
    kept = "n int, bins binary, y binary, held binary, weight binary, key binary"
    blocks = stage(rows.mapInArrow(_blocks(cuts, classes, seed), kept), "boosting-rows")
    parts = max(spark.sparkContext.defaultParallelism, -(-blocks.count() // BLOCKS))
    width, number = len(features), len(classes)
    state = blocks.repartition(parts).rdd.map(lambda r: _read_block(r, width, number)).persist(StorageLevel.MEMORY_AND_DISK)
    ranges = np.array([len(c) + 1 for c in cuts])
    trees: list[list[Tree]] = [[] for _ in classes]
    best: dict[int, tuple[float, int]] = {}
    models, validated, before = list(range(number)), True, None
    for turn in range(settings.rounds + 1):
        if turn == settings.rounds and not validated:
            break
        found = _summed(state, lambda b, t=turn, ms=tuple(models): _sum_roots(b, t, settings.subsample, ms, t == 0), len(models) + 1, width)
        if before is not None:
            before.unpersist()
        shared, held = found[-1]
        validated = held > 0
        for m in list(models) if validated and turn else ():
            error = found[m][1] / held
            if m in best and best[m][0] - error < TOLERANCE * max(error, LEAST_ERROR):
                models.remove(m)
                del trees[m][best[m][1] :]
            else:
                best[m] = (error, turn)
        if turn == settings.rounds or not models:
            break
        roots = {m: np.stack([found[m][0], *shared]) for m in models}
        grown = _grow(state, roots, turn, settings, ranges, seed, turn == 0)
        rate = settings.learning_rate if turn else 1.0
        moves = {m: (tree.paths(), rate * tree.values(), settings.max_depth) for m, tree in grown.items()}
        for m, tree in grown.items():
            trees[m].append(tree)
        before, state = state, state.map(lambda b, t=moves: _moved(b, t))
        if (turn + 1) % WRITTEN == 0:
            path = scratch_dir(spark, "boosting-margins")
            state.saveAsPickleFile(path)
            state = spark.sparkContext.pickleFile(path).coalesce(parts)
        state.persist(StorageLevel.MEMORY_AND_DISK)
    state.unpersist()
    return cuts, trees


def _stored_params(stage_, path: str, spark: SparkSession, name: str) -> dict:
    """What MLlib's writer keeps of an estimator's parameters, for the model of that name."""
    stage_.write().overwrite().save(path)
    return {**json.loads(spark.read.text(f"{path}/metadata").head()[0]), "class": name}


def as_models(
    spark: SparkSession, cuts: Sequence[np.ndarray], trees: Sequence[Sequence[Tree]], estimator: GBTClassifier
) -> tuple[GBTClassificationModel, ...]:
    """The trees as models of MLlib, read from its stored form. Impurities are not kept: NaN."""
    root = scratch_dir(spark, "boosted-models")
    rate = estimator.getStepSize()
    whole = _stored_params(estimator, f"{root}/params", spark, "org.apache.spark.ml.classification.GBTClassificationModel")
    single = _stored_params(DecisionTreeRegressor(), f"{root}/tree", spark, "org.apache.spark.ml.regression.DecisionTreeRegressionModel")
    node = (
        "id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, leftChild int, "
        "rightChild int, split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
    )

    def write(i: int) -> GBTClassificationModel:
        path, nan = f"{root}/{i}", float("nan")
        rows, heads = [], []
        for t, tree in enumerate(trees[i]):
            heads.append((t, json.dumps({**single, "uid": f"{single['uid']}_{i}_{t}"}), rate if t else 1.0))
            for n, value in enumerate(tree.values().tolist()):
                sums = [float(s) * UNIT for s in tree.sums[n][:2]]
                leaf = tree.left[n] == n
                f = -1 if leaf else tree.feature[n]
                split = (f, [] if leaf else [float(cuts[f][tree.cut[n]])], -1)
                below = (-1, -1) if leaf else (tree.left[n], tree.right[n])
                stats = [sums[1], sums[0], nan]
                rows.append((t, (n, value, nan, stats, int(tree.sums[n][2]), tree.gain[n], *below, split)))
        head = {**whole, "uid": f"{whole['uid']}_{i}", "numFeatures": len(cuts), "numTrees": len(trees[i])}
        spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame(heads, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame(rows, f"treeID int, nodeData struct<{node}>").coalesce(1).write.parquet(f"{path}/data")
        return GBTClassificationModel.load(path)

    with ThreadPool(min(8, len(trees))) as pool:
        return tuple(pool.map(inheritable_thread_target(spark)(write), range(len(trees))))

