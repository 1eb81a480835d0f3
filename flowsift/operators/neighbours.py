"""Exact nearest neighbours by pivots and bounds from the triangle inequality."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.draws import draw_key
from flowsift.session import stage

#: Points that space is divided by; a bounded sample by smallest hash, which only affects the cost.
PIVOTS = 32
#: Blocks wanted, the fewest points of one, and the most bytes of vectors a task holds for one.
BLOCKS, LEAST_ROWS, MOST_BYTES = 32, 32, 32 << 20
DISTANCE_DIGITS = 9
#: Relative and absolute room for rounding in bounds; what they let through is compared exactly.
ROOM, NEAR = 1e-9, 2 * 10.0**-DISTANCE_DIGITS
#: Queries compared with a block at once.
TOGETHER = 64

PLACED = "id bigint, v array<double>, g int, cell int, reach double"
FOUND = "id bigint, g int, neighbour bigint, ng int, distance double, bound double"


def _stack(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances of two small sets, difference by difference."""
    squares = np.zeros((len(x), len(y)))
    for d in range(x.shape[1]):
        squares += np.square(x[:, d, None] - y[None, :, d])
    return np.sqrt(squares)


@dataclass(frozen=True)
class Cells:
    """Pivots, their points' number and distances, and the blocks each cell is split into."""

    pivots: np.ndarray
    count: np.ndarray
    nearest: np.ndarray
    farthest: np.ndarray
    first: np.ndarray

    @property
    def blocks(self) -> int:
        return int(self.first[-1])

    def visits(self, v: np.ndarray, cell: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Which cells may hold a point within ``bound`` of each row, itself in ``cell``.

        A point of another cell lies beyond the plane between both pivots, and inside the shell that
        the distances of its cell span.
        """
        d = _distances(v, self.pivots)
        room = bound[:, None] + ROOM * (d + np.where(np.isfinite(bound), bound, 0.0)[:, None]) + NEAR
        may = (self.count > 0) & (d - self.farthest <= room) & (self.nearest - d <= room)
        own = d[np.arange(len(v)), cell]
        between = _distances(self.pivots, self.pivots)[cell]
        with np.errstate(divide="ignore", invalid="ignore"):
            beyond = np.where(between > 0, (d**2 - own[:, None] ** 2) / (2 * between), 0.0)
        return may & (beyond <= room)


def _place(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_stack(batch.column("v")), pivots) if len(batch) else np.zeros((0, 1))
            cell = d.argmin(axis=1)
            columns = [*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "g", "cell", "reach"])

    return run


def _visit(cells: Cells):
    """A copy of each point for every block it has to search besides its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            bound = batch.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
            bound = np.where(np.isnan(bound), np.inf, bound)
            cell, mine = batch.column("cell").to_numpy(), batch.column("block").to_numpy()
            may = cells.visits(_stack(batch.column("v")), cell, bound)
            size = np.diff(cells.first)
            rows, found = np.nonzero(may)
            rows = np.repeat(rows, size[found])
            starts = np.repeat(cells.first[found], size[found])
            inside = np.arange(len(rows)) - np.repeat(np.cumsum(size[found]) - size[found], size[found])
            block = starts + inside
            other = block != mine[rows]
            taken = pa.array(rows[other])
            columns = [pa.array(block[other], pa.int32()), *[batch.column(c).take(taken) for c in ("id", "v", "g", "bound")]]
            out = pa.RecordBatch.from_arrays(columns, ["block", "id", "v", "g", "bound"])
            for a in range(0, out.num_rows, 4096):
                yield out.slice(a, 4096)

    return run


class Block:
    """Points of one block in the order of their distance to its pivot."""

    def __init__(self, pivot: np.ndarray, ids: np.ndarray, v: np.ndarray, g: np.ndarray, reach: np.ndarray) -> None:
        order = np.argsort(reach, kind="stable")
        self.pivot, self.ids, self.v, self.g, self.reach = pivot, ids[order], v[order], g[order], reach[order]
        self.norms = np.square(self.v).sum(axis=1)

    def search(self, ids: np.ndarray, v: np.ndarray, bound: np.ndarray, k: int, groups: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(query, neighbour, its group, distance) of the neighbours to keep, and each query's new bound."""
        to_pivot = _distances(v, self.pivot[None])[:, 0]
        order = np.argsort(to_pivot, kind="stable")
        for a in range(0, len(order), TOGETHER):
            q = order[a : a + TOGETHER]
            room = bound[q] + ROOM * (to_pivot[q] + np.where(np.isfinite(bound[q]), bound[q], 0.0)) + NEAR
            low = np.searchsorted(self.reach, (to_pivot[q] - room).min(), "left")
            high = np.searchsorted(self.reach, (to_pivot[q] + room).max(), "right")
            if low < high:
                yield self._compare(q, ids[q], v[q], room, slice(low, high), k, groups)

    def _compare(self, q: np.ndarray, ids: np.ndarray, v: np.ndarray, room: np.ndarray, part: slice, k: int, groups: int) -> tuple[np.ndarray, ...]:
        theirs, g, y = self.ids[part], self.g[part], self.v[part]
        norms = np.square(v).sum(axis=1)
        scale = norms[:, None] + self.norms[part]
        squares = scale - 2.0 * (v @ y.T)  # near enough to leave points out, with room for its rounding
        other = ids[:, None] != theirs
        squares[~other] = np.inf
        slack = 1e-12 * scale.max(axis=1, initial=0.0)

        def kth(chosen: np.ndarray) -> np.ndarray:
            if chosen.sum() < k:
                return np.full(len(v), np.inf)
            return np.partition(squares[:, chosen], k - 1, axis=1)[:, k - 1]

        everyone = np.ones(len(theirs), bool)
        cut = kth(everyone)[:, None]
        if groups > 1:
            outside = np.max([kth(g != i) for i in range(groups)], axis=0)
            inside = np.stack([kth(g == i) for i in range(groups)], axis=1)
            cut = np.minimum(outside[:, None], inside[:, g])
        limit = np.sqrt(np.maximum(cut + 2 * slack[:, None], 0.0)) + NEAR
        limit = np.minimum(limit, room[:, None])
        rows, at = np.nonzero(other & (squares <= np.square(limit) + 2 * slack[:, None]))
        distance = np.zeros(len(rows))
        for d in range(v.shape[1]):
            distance += np.square(v[rows, d] - y[at, d])
        distance = np.round(np.sqrt(distance), DISTANCE_DIGITS)
        order = np.lexsort((theirs[at], distance, rows))
        rows, at, distance = rows[order], at[order], distance[order]
        keep, enough = _kept(rows, g[at], k, groups, len(v))
        rows, at, distance = rows[keep], at[keep], distance[keep]
        last = np.full(len(v), np.inf)
        last[rows] = distance  # rows ascend by distance: the last one stays
        return q[rows], theirs[at], g[at], distance, np.where(enough, last, np.inf)[rows]


def _kept(rows: np.ndarray, g: np.ndarray, k: int, groups: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which neighbours stay, sorted by row and distance; whether every row has enough.

    A row keeps neighbours until k of them lie outside each group, and at most k of one group.
    """
    first = np.searchsorted(rows, np.arange(n))

    def before(flags: np.ndarray) -> np.ndarray:
        run = np.cumsum(flags) - flags
        start = np.concatenate([[0], np.cumsum(flags)])[first]
        return run - start[rows]

    ones = np.ones(len(rows), np.int64)
    keep = np.ones(len(rows), bool)
    if groups > 1:
        for i in range(groups):
            mine = g == i
            keep &= ~mine | (before(mine.astype(np.int64)) < k)
    total = before(ones * keep)
    most = np.zeros(len(rows), np.int64)
    counts = []
    if groups > 1:
        for i in range(groups):
            mine = ((g == i) & keep).astype(np.int64)
            most = np.maximum(most, before(mine))
            counts.append(np.bincount(rows, mine, n))
    keep &= total - most < k
    everyone = np.bincount(rows, minlength=n)
    return keep, everyone - np.max(counts, axis=0, initial=0) >= k if counts else everyone >= k


def _search(cells: Cells, k: int, groups: int):
    """Blocks arrive one after another, the points of each before those that search it."""
    cell_of = np.repeat(np.arange(len(cells.pivots)), np.diff(cells.first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block, rows = None, None, []
        for batch in batches:
            blocks, asks = batch.column("block").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(batch)]):
                part = batch.slice(a, b - a)
                if blocks[a] != number:
                    number, block, rows = blocks[a], None, []
                ids, v = part.column("id").to_numpy(), _stack(part.column("v"))
                g = part.column("g").to_numpy()
                if not asks[a]:
                    rows.append((ids, v, g, part.column("reach").to_numpy()))
                    continue
                if block is None and rows:
                    block, rows = Block(cells.pivots[cell_of[number]], *map(np.concatenate, zip(*rows))), []
                if block is None:
                    continue
                bound = part.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
                for q, neighbour, ng, distance, new in block.search(ids, v, np.where(np.isnan(bound), np.inf, bound), k, groups):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[q]), pa.array(g[q], pa.int32()), pa.array(neighbour), pa.array(ng, pa.int32()), pa.array(distance), pa.array(new)],
                        ["id", "g", "neighbour", "ng", "distance", "bound"],
                    )

    return run


def _searched(points: DataFrame, asking: DataFrame, cells: Cells, k: int, groups: int) -> DataFrame:
    columns = ["block", "asks", "id", "v", "g", "reach", "bound"]
    rows = points.withColumns({"asks": F.lit(False), "bound": F.lit(None).cast("double")}).select(*columns)
    both = rows.unionByName(asking.withColumns({"asks": F.lit(True), "reach": F.lit(None).cast("double")}).select(*columns))
    dealt = both.repartition(cells.blocks, "block").sortWithinPartitions("block", "asks")
    return dealt.mapInArrow(_search(cells, k, groups), FOUND)


def place_points(points: DataFrame, key: str, vector: str, group: str | None = None, most_rows: int | None = None) -> tuple[DataFrame, Cells]:
    """Points with the block they lie in, written once, and the cells. Points without a vector are left out."""
    named = points.where(F.col(vector).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"),
        F.col(vector).cast("array<double>").alias("v"),
        (F.col(group).cast("int") if group else F.lit(0)).alias("g"),
    )
    drawn = named.select("v", draw_key(["id"], "pivot").alias("k")).orderBy("k").limit(PIVOTS).collect()
    if not drawn:
        return named.withColumn("block", F.lit(0)), Cells(np.zeros((0, 0)), *[np.zeros(0)] * 3, np.zeros(1, int))
    pivots = np.unique(np.array([r["v"] for r in drawn], np.float64), axis=0)
    placed = stage(named.mapInArrow(_place(pivots), PLACED), "neighbour-points")
    stats = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("reach").alias("low"), F.max("reach").alias("high"))
    count, low, high = np.zeros(len(pivots), np.int64), np.zeros(len(pivots)), np.zeros(len(pivots))
    for r in stats.collect():  # one row a pivot
        count[r["cell"]], low[r["cell"]], high[r["cell"]] = r["n"], r["low"], r["high"]
    fits = max(1, MOST_BYTES // (8 * max(1, pivots.shape[1])))
    per_block = min(max(LEAST_ROWS, -(-int(count.sum()) // BLOCKS)), fits, most_rows or fits)
    split = -(-count // per_block)
    first = np.concatenate([[0], np.cumsum(split)])
    cells = Cells(pivots, count, low, high, first)
    starts, sizes = (F.array(*[F.lit(int(x)) for x in xs]) for xs in (first[:-1], np.maximum(split, 1)))
    block = F.get(starts, "cell") + F.pmod(F.xxhash64("id"), F.get(sizes, "cell")).cast("int")
    return placed.withColumn("block", block), cells


def neighbour_graph(
    points: DataFrame, key: str, vector: str, k: int, group: str | None = None, groups: int = 1, most_rows: int | None = None
) -> DataFrame:
    """(key, neighbour, distance, key_group, neighbour_group): nearest other points, exact, ties by key.

    Every point keeps its k nearest. With ``group``, an integer below ``groups``, it keeps neighbours
    until k of them lie outside each group, so the k nearest among the points outside any one group can
    be read from the same graph.

    Points fall to their nearest pivot, and crowded cells (copies too) are cut into blocks by a hash. A
    point searches the block it lies in first. The distance reached there bounds which cells it must
    still visit and, inside them, which distances to the pivot; only those copies are shuffled. There
    are about as many blocks at any size until one would not fit a task, so shuffled rows grow with the
    points even where no bound prunes.
    """
    placed, cells = place_points(points, key, vector, group, most_rows)
    spark = points.sparkSession
    if not cells.blocks:
        return spark.createDataFrame([], f"`{key}` bigint, neighbour bigint, distance double, key_group int, neighbour_group int")
    unbounded = placed.select("block", "id", "v", "g", F.lit(None).cast("double").alias("bound"))
    near = stage(_searched(placed, unbounded, cells, k, groups), "neighbours-near")
    reached = near.groupBy("id").agg(F.min("bound").alias("bound"))
    asking = placed.join(reached, "id", "left").select("id", "v", "g", "cell", "block", "bound")
    visits = asking.mapInArrow(_visit(cells), "block int, id bigint, v array<double>, g int, bound double")
    found = near.unionByName(_searched(placed, visits, cells, k, groups)) if cells.blocks > 1 else near
    order = Window.partitionBy("id").orderBy("distance", "neighbour")
    if groups > 1:
        in_group = Window.partitionBy("id", "ng").orderBy("distance", "neighbour")
        found = found.withColumn("__turn", F.row_number().over(in_group)).where(F.col("__turn") <= k)
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        most = F.greatest(*[F.count_if(F.col("ng") == i).over(earlier) for i in range(groups)])
        kept = found.withColumn("__outside", F.row_number().over(order) - 1 - F.coalesce(most, F.lit(0)))
        kept = kept.where(F.col("__outside") < k)
    else:
        kept = found.withColumn("__turn", F.row_number().over(order)).where(F.col("__turn") <= k)
    return kept.select(
        F.col("id").alias(key), "neighbour", "distance", F.col("g").alias("key_group"), F.col("ng").alias("neighbour_group")
    )


def ranked_neighbours(graph: DataFrame, key: str, k: int, without: int | None = None) -> DataFrame:
    """(key, neighbour, rank, distance) of the k nearest, among points outside group ``without`` if given."""
    if without is not None:
        graph = graph.where((F.col("key_group") != without) & (F.col("neighbour_group") != without))
    order = Window.partitionBy(key).orderBy("distance", "neighbour")
    return graph.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(key, "neighbour", "rank", "distance")
