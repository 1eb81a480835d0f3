import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.llm import topk
from flowsift.llm.topk import SortedLists, top_inner_products

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, block string, score int, floor int, query_id int"


def brute(rows, k=5):
    """(query id, rank, id, score) by comparing every query with every row."""
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(ok):
        if q is None or q % 50:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i is None, i or 0) for b, (i, w) in enumerate(ok) if b != a)
        out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(scores[:k])]
    return Counter(out)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, v, 1, "r", "b", 2, 3, 4) for i, v in rows], SCHEMA).repartition(4)
    return Counter(map(tuple, top_inner_products(docs, F.col("vec_id") % 50 == 0, **options).collect()))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 60)


def clustered(rng, n, width):
    centers = rng.normal(size=(5, width))
    v = centers[rng.integers(0, 5, n)] + 0.7 * rng.normal(size=(n, width))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32).tolist()


@pytest.mark.parametrize("width", [1, 3, 24])
def test_equals_brute_force_over_blocks(spark, small_blocks, width):
    rng = np.random.default_rng(width)
    rows = list(zip(range(-100, 500), clustered(rng, 600, width)))
    assert found(spark, rows) == brute(rows)


def test_copies_ties_and_repeated_ids(spark, small_blocks):
    rng = np.random.default_rng(3)
    same = clustered(rng, 1, 8)[0]
    rows = [(i, same) for i in range(200)] + list(zip(range(200, 400), clustered(rng, 200, 8)))
    rows += [(50, same), (50, clustered(rng, 1, 8)[0]), (7, same), (None, same), (None, [0.5] * 8)]
    assert found(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    rows = [(0, [0.5, -0.25]), (1, None), (2, [None, 1.0]), (3, [math.nan, 1.0]), (4, [math.inf, 1.0]), (5, []), (6, [1.0]), (7, [-1.0, 2.0, 0.001]), (50, []), (100, None)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, [(0, [1.0])]) == Counter()
    assert found(spark, [(1, [1.0]), (2, [1.0])]) == Counter()
    assert found(spark, []) == Counter()


def test_scores_beyond_double_precision_and_beyond_a_long(spark, small_blocks):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0e6, float(x), 1.0]) for i, x in enumerate(rng.integers(-40, 40, 300) / 256)]
    assert found(spark, rows) == brute(rows)
    rows = [(0, [3.0e9, 1.0]), (1, [3.0e9, 0.5]), (2, [3.0e9, 1.0]), (3, [-3.0e9, 5.0])]
    assert found(spark, rows) == Counter({(0, 1, 1, topk.LONGEST): 1, (0, 2, 2, topk.LONGEST): 1, (0, 3, 3, -topk.LONGEST): 1})


def test_lists_are_left_early():
    """With a floor from elsewhere, a block far from the query is left after the first part of its lists."""
    rng = np.random.default_rng(5)
    values = np.floor(256 * np.abs(rng.normal(size=(4000, 16))) * 0.1)
    lists = SortedLists(values, np.arange(4000), np.ones(4000, bool), np.arange(4000))
    query = np.floor(256 * np.abs(rng.normal(size=16)))
    exact = np.sort(values @ query)[::-1]
    looked = []
    read = lists.read
    lists.read = lambda depth: looked.append(depth) or read(depth)
    floors = np.array([exact[4], exact[0] * 10])
    may = {q: len(rows) for q, rows, _ in lists.candidates(np.stack([query, query]), floors, 5)}
    assert 5 <= may[0] <= 4000 // topk.FEW and may[1] == 0
    assert max(looked) <= 4000 // topk.READS[-1]
    ((_, at, scores),) = lists.best(query[None], np.array([-math.inf]), 5, np.array([-1]))
    assert scores == exact[:5].astype(int).tolist()


def test_query_equals_sql(spark, sf, oracle):
    from flowsift.llm.catalog import ORACLES, QUERIES

    name = "op11_exact_top_k"
    got = QUERIES[name](spark, sf).toArrow()
    want = oracle.execute(ORACLES[name]).to_arrow_table()
    assert got.column_names == want.column_names
    assert sorted(zip(*got.to_pydict().values())) == sorted(zip(*want.to_pydict().values()))
