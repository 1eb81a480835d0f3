from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.catalog.models import TREES
from flowsift.models import boosting
from flowsift.models.boosting import boost, cut_points
from flowsift.models.classifier import AttackClassifier, TreeSettings

WHOLE = TreeSettings(max_depth=3, rounds=3, subsample=1.0, column_share=1.0)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(700, 3)) * [1, 50, 1e6], 2)
    y = (x[:, 0] + x[:, 1] / 50 > 0).astype(int) + 2 * (x[:, 2] > 5e5)
    rows = [(*map(float, r), float(c), float(1 + c), bool(i % 7 == 0)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, `b c` double, d double, __y double, weight double, __val boolean").cache()


def fitted(df, settings, seed=5):
    cuts, trees = boost(df, ["a", "b c", "d"], [0, 1, 2, 3], settings, seed)
    return [c.tolist() for c in cuts], [[(t.feature, t.cut, t.left, t.right, np.array(t.sums).tolist(), t.gain) for t in own] for own in trees]


def test_queries_fit_on_all_rows(spark, tmp_path):
    """No registered query bounds the rows of its trees: the root of every class's first tree counts each."""
    rows = spark.range(24_000).select(F.when(F.col("id") % 3 == 0, "DoS").otherwise("BENIGN").alias("label"), F.sin("id").alias("x"))
    model = AttackClassifier.fit(rows, None, ["x"], "label", replace(TREES, rounds=1, subsample=1.0))
    for i, own in enumerate(model.models):
        own.write().save(f"{tmp_path}/{i}")
        root = spark.read.parquet(f"{tmp_path}/{i}/data").where("treeID = 0 AND nodeData.id = 0").first()
        assert root["nodeData"]["rawCount"] == 24_000


def test_first_split_lowers_the_variance_most(table):
    train = table.where("NOT __val").toPandas()
    cuts, trees = boost(table, ["a", "b c", "d"], [0, 1, 2, 3], WHOLE, 1)
    for c, own in enumerate(trees):
        y, w = np.where(train["__y"] == c, 1.0, -1.0), train["weight"].to_numpy()

        def term(rows):
            return (y[rows] * w[rows]).sum() ** 2 / w[rows].sum() if rows.any() else 0.0

        every = {(f, i): term(x <= cut) + term(x > cut) for f, x in enumerate(train[n].to_numpy() for n in ("a", "b c", "d")) for i, cut in enumerate(cuts[f])}
        first = own[0]
        assert every[first.feature[0], first.cut[0]] == pytest.approx(max(every.values()))
        chosen = train[["a", "b c", "d"][first.feature[0]]].to_numpy() <= cuts[first.feature[0]][first.cut[0]]
        assert first.sums[first.left[0]][2] == chosen.sum() and first.sums[0][2] == len(train)
        # the sums of siblings are those of their rows, whichever was counted
        leaves = [n for n in range(len(first.feature)) if first.left[n] == n]
        assert sum(first.sums[n] for n in leaves).tolist() == first.sums[0].tolist()
        assert first.sums[0][1] * boosting.UNIT == pytest.approx(w.sum())


def test_trees_do_not_depend_on_order_or_tasks(table, monkeypatch):
    drawn = replace(WHOLE, subsample=0.7, column_share=0.6)
    want = fitted(table.coalesce(1), drawn)
    assert any(len(own) > 1 for own in want[1])
    monkeypatch.setattr(boosting, "WRITTEN", 2)
    assert fitted(table.orderBy(F.rand(3)).repartition(5), drawn) == want
    monkeypatch.setattr(boosting, "ADDED", 0)
    assert fitted(table.repartition(4), drawn) == want
    monkeypatch.setattr(boosting, "HELD", 1)
    assert fitted(table.repartition(3), drawn) == want
    assert fitted(table, drawn, seed=6) != want


def test_copies_draw_for_themselves(spark):
    rows = spark.range(4000).select(F.lit(7.0).alias("x"), F.lit(0.0).alias("__y"), F.lit(1.0).alias("weight"), F.lit(False).alias("__val"))
    trees = boost(rows.coalesce(1), ["x"], [0], TreeSettings(rounds=2, subsample=0.8), 1)[1][0]
    assert all(3100 < t.sums[0][2] < 3300 for t in trees) and trees[0].sums[0][2] != trees[1].sums[0][2]


def test_boosting_stops_where_validation_rows_gain_nothing(table):
    noise = table.withColumn("__y", F.pmod(F.xxhash64("a"), F.lit(4)).cast("double"))
    assert all(len(own) < 30 for own in fitted(noise, replace(WHOLE, rounds=30))[1])
    alone = fitted(noise.where("NOT __val"), replace(WHOLE, rounds=3))
    assert [len(own) for own in alone[1]] == [3] * 4


def test_cut_points_part_all_values(spark):
    inf = float("inf")
    values = [(float(i % 5), 1e9 + i * 1e-3, [-inf, -0.0, 0.0, 2.5, inf][i % 5]) for i in range(5000)]
    few, many, odd = cut_points(spark.createDataFrame(values, "a double, b double, c double"), ["a", "b", "c"], 256)
    assert few.tolist() == [0.5, 1.5, 2.5, 3.5]
    share = np.diff(np.searchsorted(np.sort([v[1] for v in values]), [-inf, *many, inf]))
    assert len(many) == 255 and share.max() <= 2 * 5000 / 256
    got = np.searchsorted(odd, [-inf, -0.0, 0.0, 2.5, inf]).tolist()
    assert got[1] == got[2] and sorted(set(got)) == [0, 1, 2, 3]


def test_missing_values_are_refused(spark):
    rows = spark.createDataFrame([(None, 0.0, 1.0, False), (1.0, 1.0, 1.0, False)], "x double, __y double, weight double, __val boolean")
    with pytest.raises(Exception, match="hold NULL or NaN"):
        boost(rows, ["x"], [0, 1], TreeSettings(rounds=1), 1)


def test_sums_of_few_tasks_take_no_shuffle(table, monkeypatch):
    """Every pass is one stage: its sums are small and added by the driver."""

    def refuse(*_):
        raise AssertionError("shuffled")

    monkeypatch.setattr(boosting.RDD, "reduceByKey", refuse)
    assert all(len(own) == 3 for own in fitted(table.where("NOT __val"), WHOLE)[1])
