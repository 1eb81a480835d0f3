"""Exact top-k inner products by no-random-access aggregation of sorted component lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from flowsift.session import stage

#: Rows of one block: at least, at most (its lists must fit a task), and blocks wanted in between.
LEAST_ROWS, MOST_ROWS, BLOCKS = 4096, 1 << 16, 128
#: Bounds are looked at after these parts of all lists; the last look is at the whole.
READS = 8, 2
#: A query reads no further once this part of a block's rows is left.
FEW = 32
#: Bounds in memory at once.
TOGETHER = 1 << 20
#: Below this, sums of products are exact in double precision.
EXACT = 2.0**53
LONGEST = 2**63 - 1

FOUND = "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint"


class SortedLists:
    """The vectors of one block as one list a dimension, each in ascending order of its components."""

    def __init__(self, values: np.ndarray, ids: np.ndarray, has_id: np.ndarray, rows: np.ndarray) -> None:
        self.values, self.ids, self.has_id, self.rows = values, ids, has_id, rows
        self.order = np.argsort(values, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(values, self.order, axis=0)
        self.size = np.abs(values).max(axis=0, initial=0)
        self._read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def read(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """What is known of every row after the first ``depth`` entries from both ends of all lists.

        Least and greatest possible components, first for lists read from the top (positive weights), then
        from the bottom (negative ones). A row that a list has not shown yet lies between the entry read
        last and the far end of the list.
        """
        if depth not in self._read:
            n, width = self.values.shape
            near, far = np.empty((n, 2 * width)), np.empty((n, 2 * width))
            ends = (slice(n - depth, n), n - depth, 0), (slice(0, depth), depth - 1, n - 1)
            for half, (part, last, end) in enumerate(ends):
                columns = slice(half * width, (half + 1) * width)
                for out, unmet in ((near, last), (far, end)):
                    out[:, columns] = self.sorted[unmet]
                    np.put_along_axis(out[:, columns], self.order[part], self.sorted[part], axis=0)
            self._read[depth] = far, near
        return self._read[depth]

    def candidates(self, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, bool]]:
        """``(query, rows that may be among its k best, whether their scores need more than doubles)``.

        All queries read the lists together. One leaves as soon as rows outside a small set cannot
        qualify: their upper bounds stay below ``floors``, scores that the k-th best are known to reach,
        or below the k-th lower bound.
        """
        n = len(self.rows)
        reach = np.abs(queries) @ self.size
        slack = np.where(reach < EXACT, 0.0, reach * (queries.shape[1] * 2.0**-50))
        signed = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1)
        few = max(4 * k, n // FEW)
        for start in range(0, len(queries), max(1, TOGETHER // n)):
            left = np.arange(start, min(len(queries), start + max(1, TOGETHER // n)))
            for part in (*READS, 1):
                depth = max(1, n // part)
                far, near = self.read(depth) if depth < n else (None, self.values)
                asked = queries if depth == n else signed
                upper = asked[left] @ near.T + slack[left, None]
                bar = floors[left]
                many = np.flatnonzero((upper >= bar[:, None]).sum(axis=1) > few)
                if len(many) and n >= k:  # raise the bar by the k-th lower bound
                    lower = upper[many] - 2 * slack[left[many], None] if depth == n else asked[left[many]] @ far.T - slack[left[many], None]
                    bar[many] = np.maximum(bar[many], np.partition(lower, n - k, axis=1)[:, n - k])
                may = upper >= np.minimum(bar, float(LONGEST))[:, None]
                done = (may.sum(axis=1) <= few) | (depth == n)
                for i in np.flatnonzero(done):
                    yield int(left[i]), np.flatnonzero(may[i]), slack[left[i]] > 0
                left = left[~done]
                if not len(left):
                    break

    def best(self, queries: np.ndarray, floors: np.ndarray, k: int, own: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[int]]]:
        """Per query its rows and exact scores: the k best of this block that reach its floor.

        ``own`` are row numbers that the queries themselves have here, or -1.
        """
        for q, may, beyond in self.candidates(queries, floors, k + 1):
            may = may[self.rows[may] != own[q]]
            if beyond:
                exact = [int(x) for x in queries[q]]
                sums = [sum(int(c) * x for c, x in zip(self.values[i], exact)) for i in may]
                scores = np.array([max(-LONGEST, min(LONGEST, s)) for s in sums], np.int64)
            else:
                scores = (self.values[may] @ queries[q]).astype(np.int64)
            order = np.lexsort((self.rows[may], self.ids[may], ~self.has_id[may], -scores))[:k]
            order = order[scores[order] >= floors[q]]
            yield q, may[order], scores[order].tolist()


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Scaled integer components as doubles; shorter vectors end in zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64) * 256)
    out = np.zeros((len(vectors), width))
    out[np.repeat(np.arange(len(vectors)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _search(k: int, width: int):
    """Blocks arrive one after another, the rows of each before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, lists, rows = None, None, []
        for batch in batches:
            blocks, is_query = batch.column("block").to_numpy(), batch.column("is_query").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(is_query.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(batch)]):
                part = batch.slice(a, b - a)
                if blocks[a] != block:
                    block, lists, rows = blocks[a], None, []
                matrix = _matrix(part.column("vector"), width)
                ids, numbers = part.column("id"), part.column("row").to_numpy()
                if not is_query[a]:
                    rows.append((matrix, ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), numbers))
                    continue
                if lists is None and rows:
                    lists, rows = SortedLists(*map(np.concatenate, zip(*rows))), []
                if lists is None:
                    continue
                floors = part.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
                floors[np.isnan(floors) | (floors <= -LONGEST)] = -np.inf
                own = np.where(part.column("own").to_numpy(zero_copy_only=False), numbers, -1)
                names = ids.to_pylist()
                found = [
                    (int(numbers[q]), names[q], int(lists.ids[i]) if lists.has_id[i] else None, int(lists.rows[i]), score)
                    for q, at, scores in lists.best(matrix, floors, k, own)
                    for i, score in zip(at, scores)
                ]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["query_row", "query_id", "vec_id", "row", "score"])

    return run


def _searched(rows: DataFrame, queries: DataFrame, blocks: int, k: int, width: int) -> DataFrame:
    """The k best rows of its block for every query, found while the block's queries stream by."""
    columns = ["block", "is_query", "id", "row", "vector", "own", "floor"]
    both = rows.withColumns({"is_query": F.lit(False), "own": F.lit(False), "floor": F.lit(None).cast("bigint")}).select(*columns)
    both = both.unionByName(queries.withColumn("is_query", F.lit(True)).select(*columns))
    return both.repartition(blocks, "block").sortWithinPartitions("block", "is_query").mapInArrow(_search(k, width), FOUND)


def top_inner_products(
    vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """The k rows of highest integer inner product with every query: ``query_id, rank, vec_id, score``.

    Components count as ``floor(256 * x)``. Candidates of a query are all rows but its own; equal scores
    go to the smaller ``vec_id``, and where ids repeat or are NULL (last) to either row first, but the
    same one in every use of the result. Queries with fewer candidates get them all.

    Rows are dealt by a hash into blocks of bounded size, which hold one ascending list a dimension. A
    query reads the lists of a block from the better end and keeps bounds of every row's score; queries
    read together, the bounds of many are one matrix product. A query stops when no other row can reach
    the k-th lower bound; the scores of the rows left are then resolved.
    Every query first searches the block it lies in. The k-th score found there is a proven floor for
    all other blocks, most of which end after a first part of their lists.

    A NULL vector, or one with a NULL or non-finite component, takes no part. Shorter vectors count as
    zero beyond their end, an empty one scores 0 with all. Rows that repeat an id are rows of their own,
    queries too. A row of NULL id is never a query, unless ``is_query`` says so. Scores beyond a long count
    as its end. No rows or no queries give no result. Very long texts and
    other columns are not read.

    No pair of rows is shuffled: a block's task gets its rows once and every query once.
    """
    kind = vectors.schema[embedding].dataType.elementType
    vector = F.col(embedding) if isinstance(kind, (FloatType, DoubleType)) else F.col(embedding).cast(ArrayType(DoubleType()))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = vectors.select(F.col(vec_id).cast("bigint").alias("id"), vector.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = stage(named.where(F.col("vector").isNotNull() & ~odd).withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    per_block = min(max(LEAST_ROWS, -(-n // BLOCKS)), MOST_ROWS)
    blocks = max(1, -(-n // per_block))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    queries = rows.where("asks")
    near = _searched(rows, queries.withColumns({"own": F.lit(True), "floor": F.lit(None).cast("bigint")}), blocks, k, width)
    near = stage(near, "topk-near")
    floors = near.groupBy("query_row").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    others = (
        queries.join(floors, queries["row"] == floors["query_row"], "left")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .where("other <> block")
        .select(F.col("other").alias("block"), "id", "row", "vector", F.lit(False).alias("own"), "floor")
    )
    found = near.unionByName(_searched(rows, others, blocks, k, width)) if blocks > 1 else near
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
