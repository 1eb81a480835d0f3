"""Synthetic minority rows by interpolation towards near neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.functions.draws import draw_key, index_draw, unit_draw
from flowsift.operators.neighbours import neighbour_graph, ranked_neighbours
from flowsift.operators.ranking import ranked

MAX_NEIGHBOURS = 5


def near_neighbours(
    points: DataFrame, key: str, vector: str, k: int, block_rows: int | None = None
) -> DataFrame:
    """(key, neighbour, rank, distance): the k nearest other points, exact, ties by key."""
    return ranked_neighbours(neighbour_graph(points, key, vector, k, most_rows=block_rows), key, k)


def smote(
    df: DataFrame,
    key: str,
    vector: str,
    target: str,
    seed: int,
    max_neighbours: int = MAX_NEIGHBOURS,
    block_rows: int | None = None,
    graph: DataFrame | None = None,
    without: int | None = None,
) -> DataFrame:
    """Synthetic positive rows that make the classes equal in size.

    Columns: synthetic_id, base, neighbour, gap, vector. Every choice is a hash of the synthetic
    row's number. Base rows and neighbours are found by evenly spread equi-joins. A ``graph`` of the
    positive rows saves the search; ``without`` names the group of it that ``df`` leaves out.
    """
    sizes = df.agg(
        F.count_if(F.col(target) == 1).alias("p"), F.count_if(F.col(target) == 0).alias("n")
    ).first()
    positives, missing = sizes["p"], max(0, sizes["n"] - sizes["p"])
    minority = df.where(F.col(target) == 1).select(key, vector)
    if positives < 2 or not missing:
        missing = 0
    k = max(1, min(max_neighbours, positives - 1))
    if graph is None:
        near = near_neighbours(minority, key, vector, k, block_rows)
    else:
        near = ranked_neighbours(graph, key, k, without)
    numbered = ranked(
        minority.withColumn("__key", draw_key([key], seed)), [], "__key", "__number"
    ).select(F.col(key).alias("base"), F.col(vector).alias("__from"), "__number")
    drawn = df.sparkSession.range(missing).select(
        F.col("id").alias("synthetic_id"),
        (index_draw(["id"], F.lit(positives), seed, "base") + 1).alias("__number"),
        (index_draw(["id"], F.lit(k), seed, "neighbour") + 1).cast("int").alias("rank"),
        unit_draw(["id"], seed, "gap").alias("gap"),
    )
    ends = near.select(F.col(key).alias("base"), "rank", "neighbour").join(
        minority.select(F.col(key).alias("neighbour"), F.col(vector).alias("__to")), "neighbour"
    )
    return (
        drawn.join(numbered, "__number")
        .join(ends, ["base", "rank"])
        .select(
            "synthetic_id",
            "base",
            "neighbour",
            "gap",
            F.zip_with(
                F.col("__from").cast("array<double>"),
                F.col("__to").cast("array<double>"),
                lambda a, b: a + F.col("gap") * (b - a),
            ).alias(vector),
        )
    )
