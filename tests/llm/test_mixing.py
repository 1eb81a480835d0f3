import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from brute import no_docs, odd_docs
from flowsift.llm import mixing
from flowsift.llm.mixing import mix_sources
from flowsift.llm.words import spaced_count


def targets(sizes, weights=(3, 1, 2), budget=1.5, cap=2.0):
    """Share by weight, stop at the cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = budget * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] >= cap * sizes[s]}
        if not over:
            out |= {s: unit * weight[s] for s in open_}
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def mixed(docs, **options):
    return mix_sources(docs, F.col("words"), F.col("quality"), **options).collect()


@pytest.mark.parametrize("range_rows", [3, 4096])
def test_targets_and_taken_words(spark, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    rng = random.Random(1)
    rows = [(i, rng.choice(["é", "b", "z", "Z", None, "hot", "hot", "hot"]), rng.choice([0, 1, 5, 40, 300]), rng.choice([None, 0.1, 0.5, 1.0, 7.0])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, words bigint, quality double").repartition(5)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, s, n, _ in rows:
        sizes[s] += n
    want = targets(sizes)
    got = mixed(docs)
    assert len(got) == len(rows)
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        # complete epochs come first
        assert r.taken >= r.size * math.floor(r.target / r.source_size + 1e-9) if r.source_size else r.taken == 0
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    again = mixed(docs.repartition(2))
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_good_documents_are_taken_more_often(spark):
    rows = [(i, "a" if i % 2 else "b", 10, 1.0 if i % 4 < 2 else 0.1) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, words bigint, quality double")
    got = mixed(docs, budget=0.6)
    quality = {i: q for i, _, _, q in rows}
    good = sum(r.taken for r in got if quality[r.doc_id] == 1.0)
    poor = sum(r.taken for r in got if quality[r.doc_id] == 0.1)
    assert good > 1.5 * poor


def test_odd_rows(spark):
    size = spaced_count(F.col("text"))
    got = mix_sources(odd_docs(spark), size, F.col("score")).collect()
    assert len(got) == odd_docs(spark).count()
    assert {r.taken for r in got if r.size == 0} == {0}
    assert mix_sources(no_docs(spark), spaced_count(F.col("text")), F.lit(1.0)).count() == 0
