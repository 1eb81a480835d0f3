import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.operators import neighbours
from flowsift.operators.neighbours import neighbour_graph, place_points, ranked_neighbours
from flowsift.operators.smote import smote
from flowsift.plans.leakage import compare_leakage


def points_of(spark, values, folds=None):
    rows = [(i, [float(c) for c in v], int(folds[i]) if folds is not None else 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id bigint, v array<double>, fold int").repartition(4)


def brute(values, k, allowed=None):
    out = set()
    ids = [i for i in range(len(values)) if allowed is None or allowed[i]]
    for i in ids:
        order = sorted((round(float(np.sqrt(((values[i] - values[j]) ** 2).sum())), 9), j) for j in ids if j != i)
        out |= {(i, j, r + 1, d) for r, (d, j) in enumerate(order[:k])}
    return out


def found(graph, k, without=None):
    return set(map(tuple, ranked_neighbours(graph, "id", k, without).collect()))


def shapes():
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(6, 3)) * 20
    return {
        "clusters": centers[rng.integers(0, 6, 500)] + rng.normal(size=(500, 3)),
        "noise": rng.normal(size=(400, 24)),
        "copies": np.concatenate([np.ones((150, 4)), rng.integers(0, 3, (250, 4)).astype(float)]),
        "line": np.arange(300.0)[:, None] ** 2 * 1e6,
    }


@pytest.mark.parametrize("shape", ["clusters", "noise", "copies", "line"])
@pytest.mark.parametrize("most_rows", [None, 9])
def test_equals_brute_force(spark, shape, most_rows):
    values = shapes()[shape]
    assert found(neighbour_graph(points_of(spark, values), "id", "v", 4, most_rows=most_rows), 4) == brute(values, 4)


@pytest.mark.parametrize("shape", ["clusters", "copies"])
def test_one_graph_serves_every_fold(spark, shape):
    values, rng = shapes()[shape], np.random.default_rng(2)
    folds = rng.integers(0, 4, len(values))
    folds[:120] = 3  # a crowd of neighbours in one fold
    graph = neighbour_graph(points_of(spark, values, folds), "id", "v", 3, "fold", 4, most_rows=40).cache()
    assert found(graph, 3) == brute(values, 3)
    for fold in range(4):
        assert found(graph, 3, fold) == brute(values, 3, folds != fold)
    kept = graph.groupBy("id", "neighbour_group").count().agg(F.max("count")).first()[0]
    assert kept <= 3


def test_few_points(spark):
    for values in ([[1.0, 2.0]], [[1.0], [1.0], [1.0]], [[0.0], [5.0]]):
        values = np.array(values)
        assert found(neighbour_graph(points_of(spark, values), "id", "v", 5), 5) == brute(values, 5)
    empty = points_of(spark, np.zeros((1, 1))).where("false")
    assert neighbour_graph(empty, "id", "v", 5).count() == 0
    with_null = spark.createDataFrame([(1, None), (2, [0.0]), (3, [1.0])], "id bigint, v array<double>")
    assert found(neighbour_graph(with_null, "id", "v", 2), 2) == {(2, 3, 1, 1.0), (3, 2, 1, 1.0)}


def visited(spark, values, monkeypatch):
    """Rows that the second phase shuffles."""
    seen = []
    search = neighbours._searched

    def counted(placed, asking, *more):
        seen.append(asking.count())
        return search(placed, asking, *more)

    monkeypatch.setattr(neighbours, "_searched", counted)
    neighbour_graph(points_of(spark, values), "id", "v", 5).count()
    monkeypatch.setattr(neighbours, "_searched", search)
    return sum(seen)


@pytest.mark.parametrize("width, spread", [(4, 12.0), (32, 0.0)])
def test_shuffled_rows_follow_the_points(spark, monkeypatch, width, spread):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, width)) * spread
    values = centers[rng.integers(0, 12, 6000)] + rng.normal(size=(6000, width))
    small, large = (visited(spark, values[:n], monkeypatch) for n in (1500, 6000))
    assert large < 6 * small
    if spread:  # most cells are ruled out
        assert large < 6000 * neighbours.BLOCKS / 4


def test_cells_are_bounded(spark):
    values = np.concatenate([np.zeros((400, 2)), np.random.default_rng(1).normal(size=(200, 2))])
    placed, cells = place_points(points_of(spark, values), "id", "v", most_rows=25)
    sizes = [r["count"] for r in placed.groupBy("block").count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 60 and len(sizes) <= cells.blocks


def test_smote_of_a_fold_equals_its_own_search(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=5)], int(i % 4 == 0), int(rng.integers(0, 3))) for i in range(400)]
    data = spark.createDataFrame(rows, "id bigint, v array<double>, y int, fold int").cache()
    graph = neighbour_graph(data.where("y = 1"), "id", "v", 5, "fold", 3)
    for fold in range(3):
        train = data.where(F.col("fold") != fold)
        want = smote(train, "id", "v", "y", 7).collect()
        got = smote(train, "id", "v", "y", 7, graph=graph, without=fold).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_leakage_searches_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)], int(i % 5 == 0)) for i in range(200)]
    data = spark.createDataFrame(rows, "id bigint, v array<double>, y int")
    calls = []
    place = neighbours.place_points
    monkeypatch.setattr(neighbours, "place_points", lambda *a: calls.append(1) or place(*a))
    compare_leakage(data, "id", "v", "y", k=2, iterations=3).collect()
    assert len(calls) == 1
