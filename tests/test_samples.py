import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.functions.draws import draw_key
from flowsift.models.classifier import AttackClassifier, TreeSettings, _weighted
from flowsift.models.forest import IsolationForest
from flowsift.operators import samples
from flowsift.operators.samples import Smallest, key_samples, sample_hashes, stratified_sample


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select(F.col("id"), (F.col("id") * 0.5).alias("x")).repartition(7).cache()


@pytest.mark.parametrize("size", [1, 40, 2500, 5000])
def test_every_sample_has_the_smallest_hashes(rows, size):
    got = {}
    for r in key_samples(rows, ["id"], F.array("x"), 6, size, 4).collect():
        got.setdefault(r["sample"], set()).add((r["h"], r["x"][0]))
    keys = rows.select("x", F.xxhash64(draw_key(["id"], 4)).alias("k")).collect()
    hashes = sample_hashes(np.array([r["k"] for r in keys]), 6)
    for t in range(6):
        order = np.argsort(hashes[:, t])[:size]
        assert got[t] == {(int(hashes[i, t]), keys[i]["x"]) for i in order}


def test_partitions_do_not_matter_and_copies_count_once(spark, rows):
    def ids(df):
        return sorted((r["sample"], r["h"]) for r in key_samples(df, ["id"], F.array("x"), 3, 50, 4).select("sample", "h").distinct().collect())

    copies = rows.unionByName(rows.where("id < 1000")).unionByName(spark.range(2000).select(F.lit(7).cast("bigint").alias("id"), F.lit(3.5).alias("x")))
    assert ids(rows) == ids(rows.repartition(2)) == ids(copies.repartition(5))
    assert key_samples(rows.where("false"), ["id"], F.array("x"), 3, 50, 4).count() == 0


def test_partial_samples_merge():
    keys = np.random.default_rng(1).integers(-(2**62), 2**62, 5000)
    whole, parts = Smallest(4, 30), [Smallest(4, 30) for _ in range(5)]
    whole.add_keys(keys)
    for part, piece in zip(parts, np.array_split(keys, 5)):
        part.add_keys(piece)
    for t in range(4):
        merged = Smallest(1, 30)
        for part in parts:
            merged.add(0, part.kept[t])
        assert merged.kept[0].tolist() == whole.kept[t].tolist()


def test_samples_of_trees_differ_and_are_even():
    hashes = sample_hashes(np.arange(20_000), 50)
    chosen = np.argsort(hashes, axis=0)[:256]
    assert len({tuple(sorted(c)) for c in chosen.T}) == 50
    assert abs(chosen.mean() - 10_000) < 300


def test_forest_has_no_rule_by_size(spark, rows):
    small = IsolationForest.fit(rows, ["x"], ["id"], trees=4, max_samples=64, seed=2)
    other = IsolationForest.fit(rows.repartition(3), ["x"], ["id"], trees=4, max_samples=64, seed=2)
    assert small.nodes.equals(other.nodes)
    leaves = small.nodes[small.nodes["feature"] < 0].groupby("tree").size()
    assert (leaves <= 64).all() and len(leaves) == 4


@pytest.fixture(scope="module")
def skewed(spark):
    """One class of 1 in 10,000 rows, one that is copies of a single row, one without a label."""
    label = F.when(F.col("id") % 10_000 == 0, "Botnet").when(F.col("id") % 3 == 0, "DDoS").when(F.col("id") % 1000 == 1, None).otherwise("BENIGN")
    x = F.when(label == "DDoS", 7.0).otherwise(F.col("id") % 977 / 10)
    return spark.range(120_000).select(label.alias("Label"), x.alias("x")).repartition(6).cache()


def test_classes_keep_their_floor(skewed):
    sample, counts = stratified_sample(skewed, "Label", 2000, 50, 3)
    size = {r["Label"]: (r["n"], r["w"]) for r in sample.groupBy("Label").agg(F.count("*").alias("n"), F.sum("represents").alias("w")).collect()}
    assert counts == {r["Label"]: r["count"] for r in skewed.groupBy("Label").count().collect()}
    assert size["Botnet"][0] == counts["Botnet"] == 12
    assert size[None][0] == 50
    assert size["DDoS"][0] == round(2000 * counts["DDoS"] / 120_000)  # copies are drawn one by one
    assert sum(n for n, _ in size.values()) <= 2000 + 4 * 50
    for c, (_, weight) in size.items():
        assert weight == pytest.approx(counts[c])
    mean = sample.where("Label = 'BENIGN'").agg(F.avg("x")).first()[0]
    assert mean == pytest.approx(skewed.where("Label = 'BENIGN'").agg(F.avg("x")).first()[0], rel=0.1)
    assert stratified_sample(skewed.where("false"), "Label", 10, 5, 3)[0].count() == 0


def test_weights_of_a_bounded_fit_equal_those_of_the_table(skewed):
    rows = skewed.where("Label IS NOT NULL")

    def totals(settings, balance):
        weighted = _weighted(rows, "Label", settings, 1, balance)
        return {r["Label"]: pytest.approx(r["w"]) for r in weighted.groupBy("Label").agg(F.sum("weight").alias("w")).collect()}

    for balance in (True, False):
        assert totals(TreeSettings(max_rows=1000, class_floor=10), balance) == totals(TreeSettings(), balance)


def test_rare_class_is_predicted(skewed):
    rows = skewed.where("Label IS NOT NULL").withColumn("x", F.when(F.col("Label") == "Botnet", -5.0).otherwise(F.col("x")))
    settings = TreeSettings(max_depth=2, rounds=2, trees=4, max_rows=800, class_floor=10)
    model = AttackClassifier.fit(rows, rows, ["x"], "Label", settings)
    assert len(model.classes) == 3
    found = model.score(rows.where("x = -5").limit(3)).select("predicted_class").distinct().collect()
    assert [r[0] for r in found] == ["Botnet"]
