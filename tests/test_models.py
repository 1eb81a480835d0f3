import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.models.classifier import AttackClassifier, TreeSettings
from flowsift.models.forest import IsolationForest, expected_path
from flowsift.models.fusion import fit_fusion, fusion_proba, weights_from_table, weights_table
from flowsift.models.textmodels import TextBaseline, TextSequence
from flowsift.operators.evaluate import average_precision
from flowsift.operators.fitting import minmax_average
from flowsift.operators.smote import near_neighbours, smote
from flowsift.plans.leakage import compare_leakage
from flowsift.plans.score import ScoringBundle


@pytest.fixture(scope="module")
def outliers(spark):
    """One row in fifty lies far out."""
    far = (F.col("id") % 50 == 0).cast("int")
    shift = far * 9
    return spark.range(2000).select(
        "id", far.alias("y"), (F.sin("id") + shift).alias("a b"), (F.cos(F.col("id") * 3) - shift).alias("c.d")
    )


@pytest.fixture(scope="module")
def forest(outliers):
    return IsolationForest.fit(outliers, ["a b", "c.d"], ["id"], trees=40, max_samples=128, seed=3)


def test_expected_path():
    assert expected_path(1) == 0 and expected_path(2) == 1
    assert expected_path(256) == pytest.approx(10.244, abs=1e-3)


def test_forest_scores_follow_its_nodes(spark):
    """Every row ends in the leaf that its nodes lead to; NULL and NaN go right, a value on a cut left."""
    x = [(i, float(i % 13), None if i % 9 == 0 else math.nan if i % 7 == 0 else i / 3) for i in range(300)]
    df = spark.createDataFrame(x, "id long, a double, b double")
    model = IsolationForest.fit(df.fillna(0.0), ["a", "b"], ["id"], trees=5, max_samples=32, seed=1)
    nodes = {(n.tree, n.node): n for n in model.nodes.itertuples()}
    cut = next(n for n in nodes.values() if n.feature == 0)
    df = df.unionByName(spark.createDataFrame([(300, cut.threshold, 1.0)], df.schema))

    def by_hand(row):
        total = 0.0
        for tree in range(5):
            n = nodes[tree, 0]
            while n.feature >= 0:
                v = row[1 + n.feature]
                n = nodes[tree, n.left_node if v is not None and v <= n.threshold else n.right_node]
            total += n.path
        return 2.0 ** -(total / 5 / expected_path(32))

    got = {r["id"]: r["s"] for r in df.withColumn("s", model.raw_score(spark)).collect()}
    assert got == {r["id"]: pytest.approx(by_hand(r), rel=1e-12) for r in df.collect()}
    levelled = model._levelled()
    assert levelled[1] <= 5 and len(levelled[2]) == 5


def test_forest_scores_a_batch_at_once(spark):
    """A batch is not cut into short runs, whose calls cost more than their rows; trees may be single leaves."""
    from flowsift.models import forest as forests

    assert forests.ROWS >= int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    same = spark.range(50).selectExpr("id", "1.0D AS x")
    model = IsolationForest.fit(same, ["x"], ["id"], trees=3, seed=1)
    assert model._levelled()[1] == 0
    assert model.score(same).select("anomaly_score").distinct().count() == 1


def test_forest_finds_planted_outliers(spark, outliers, forest):
    scored = outliers.withColumn("s", forest.raw_score(spark))
    low, high = scored.agg(F.min("s"), F.max("s")).first()
    assert 0 < low < high < 1
    assert average_precision(scored, "y", "s").first()[0] > 0.95
    assert forest.nodes["tree"].nunique() == 40 and forest.subsample == 128
    leaves = forest.nodes["feature"] < 0
    assert leaves.sum() == (~leaves).sum() + 40


def test_forest_is_deterministic_and_saved_whole(spark, outliers, forest, tmp_path):
    again = IsolationForest.fit(outliers.repartition(5), ["a b", "c.d"], ["id"], trees=40, max_samples=128, seed=3)
    cut = forest.with_offset(outliers.withColumn("s", forest.raw_score(spark)), "s", 0.02)
    path = str(tmp_path / "forest")
    cut.to_table(spark).write.parquet(path)
    loaded = IsolationForest.from_table(spark.read.parquet(path))
    assert loaded.offset == cut.offset and loaded.features == cut.features

    def scores(model, offset=0.0):
        rows = model.score(outliers).select("id", "anomaly_score").collect()
        return {r["id"]: round(r["anomaly_score"] + offset, 9) for r in rows}

    assert scores(loaded) == scores(cut)
    assert len(again.nodes) > 0 and set(again.nodes["tree"]) == set(forest.nodes["tree"])
    flagged = cut.score(outliers).where("anomaly_score >= 0").count()
    assert abs(flagged - 40) <= 2


def test_forest_on_fewer_rows_than_a_sample(spark, outliers):
    tiny = outliers.limit(20)
    model = IsolationForest.fit(tiny, ["a b", "c.d"], ["id"], trees=5, seed=1)
    assert model.subsample == 20 and model.score(tiny).where("anomaly_score is null").count() == 0


@pytest.fixture(scope="module")
def classes(spark):
    label = F.when(F.col("id") % 10 < 7, "BENIGN").when(F.col("id") % 10 < 9, "DoS").otherwise("Botnet")
    base = spark.range(1500).withColumn("label", label)
    centre = F.when(F.col("label") == "BENIGN", 0.0).when(F.col("label") == "DoS", 4.0).otherwise(-4.0)
    return base.select("id", "label", (centre + F.sin("id")).alias("x"), F.cos("id").alias("z"))


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_classifier(spark, classes, tmp_path, kind):
    settings = TreeSettings(max_depth=3, rounds=4, trees=8)
    train, val = classes.where("id % 5 != 0"), classes.where("id % 5 = 0")
    model = AttackClassifier.fit(train, val if kind == "boosted" else None, ["x", "z"], "label", settings, kind, 1)
    assert model.classes == (0, 1, 6)
    scored = model.score(val)
    assert scored.where(F.abs(F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p) - 1) > 1e-9).count() == 0
    assert scored.where("label = predicted_class").count() / scored.count() > 0.97
    assert scored.where("attack_proba < 0 or attack_proba > 1").count() == 0
    weights = model.importances()
    assert weights["x"] > weights["z"] and sum(weights.values()) == pytest.approx(1.0, abs=0.35)

    loaded = AttackClassifier.load(spark, model.save(spark, str(tmp_path / kind)))
    a, b = ({r["id"]: r["attack_proba"] for r in m.score(val).collect()} for m in (model, loaded))
    assert a == b


def test_classifier_without_benign(classes):
    attacks = classes.where("label != 'BENIGN'")
    model = AttackClassifier.fit(attacks, None, ["x"], "label", TreeSettings(max_depth=2, trees=3), "forest")
    assert {r[0] for r in model.score(classes).select("attack_proba").distinct().collect()} == {1.0}


@pytest.fixture(scope="module")
def commands(spark):
    bad = ["rm -rf / ; nc evil 1", "cat /etc/shadow", "<script>x</script>", "union select pass"]
    good = ["ls -la home", "git status", "df -h", "make all test"]
    rows = [(i, f"{(bad if i % 3 == 0 else good)[i % 4]} {i}", int(i % 3 == 0)) for i in range(240)]
    return spark.createDataFrame(rows, "id int, payload string, label int")


def test_text_models(commands):
    train, test = commands.where("id < 160"), commands.where("id >= 160")
    sequence = TextSequence.fit(train, "payload", "label", rounds=2)
    sequence = sequence.with_threshold(test, "label", 0.8)
    baseline = TextBaseline.fit(train, "payload", "label", iterations=15)
    scored = baseline.score(sequence.score(test))
    row = scored.agg(
        *[
            F.avg(F.when(F.col("label") == y, F.col(c))).alias(f"{c}_{y}")
            for c in ("text_proba", "baseline_proba")
            for y in (0, 1)
        ]
    ).first()
    assert row["text_proba_1"] > row["text_proba_0"] + 0.3
    assert row["baseline_proba_1"] > row["baseline_proba_0"] + 0.3
    assert 0 < sequence.threshold < 1
    whole = sequence.score(test.limit(1).withColumn("payload", F.concat(F.repeat(F.lit("git status "), 900), F.lit("cat /etc/shadow"))))
    assert whole.first()["text_proba"] is not None


def test_fusion_beats_averaging(spark):
    y = (F.col("id") % 3 == 0).cast("int")
    df = spark.range(900).select(
        "id",
        y.alias("y"),
        (F.sin("id") * 400 + y * 900).alias("anomaly_score"),
        (F.abs(F.sin(F.col("id") * 5)) * 0.6 + y * 0.4).alias("attack_proba"),
        F.abs(F.cos(F.col("id") * 11)).alias("text_proba"),
    )
    weights = fit_fusion(df, "y")
    scored = minmax_average(df.withColumn("fused", fusion_proba(weights)), ("anomaly_score", "attack_proba", "text_proba"))
    fused = average_precision(scored, "y", "fused").first()[0]
    plain = average_precision(scored, "y", "average").first()[0]
    assert fused >= plain
    assert weights_from_table(weights_table(weights, spark)) == weights


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=6)], int(i % 6 == 0)) for i in range(420)]
    rows += [(1000 + i, [0.5] * 6, 1) for i in range(40)]
    return spark.createDataFrame(rows, "id bigint, v array<double>, y int")


@pytest.mark.parametrize("block_rows", [17, 4096])
def test_neighbours_equal_brute_force(points, block_rows):
    minority = points.where("y = 1")
    got = {}
    for r in near_neighbours(minority, "id", "v", 4, block_rows).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["neighbour"]
    data = {r["id"]: np.array(r["v"]) for r in minority.collect()}
    for i, v in data.items():
        order = sorted((round(float(np.sqrt(((v - w) ** 2).sum())), 9), j) for j, w in data.items() if j != i)
        assert [got[i][r] for r in range(1, 5)] == [j for _, j in order[:4]]


def test_smote_balances_and_interpolates(points):
    made = smote(points, "id", "v", "y", 9, block_rows=50)
    p, n = points.where("y = 1").count(), points.where("y = 0").count()
    assert made.count() == n - p
    joined = made.join(points.select(F.col("id").alias("base"), F.col("v").alias("a")), "base").join(
        points.select(F.col("id").alias("neighbour"), F.col("v").alias("b")), "neighbour"
    )
    assert joined.count() == n - p
    for r in joined.limit(50).collect():
        a, b = np.array(r["a"]), np.array(r["b"])
        assert np.allclose(r["v"], a + r["gap"] * (b - a))
        assert 0 <= r["gap"] < 1


def test_smote_with_nothing_to_do(points):
    assert smote(points.where("y = 1"), "id", "v", "y", 9).count() == 0


def test_leakage(points):
    row = compare_leakage(points, "id", "v", "y", k=2, iterations=10).first()
    assert row["leaked_pr_auc"] >= row["leak_free_pr_auc"] - 0.02
    assert row["gap"] == pytest.approx(row["leaked_pr_auc"] - row["leak_free_pr_auc"])


@pytest.fixture(scope="module")
def bundle(spark, sf):
    from flowsift.catalog.models import fitted

    return fitted(spark, sf).bundle


def test_bundle_routes_and_explains(spark, bundle):
    events = spark.createDataFrame(
        [
            (1, {"duration": 30.0, "bytes": 5.0, "unlisted": 1.0}, "ls"),
            (2, None, "cat /etc/shadow"),
            (3, {"duration": float("inf")}, None),
            (4, {}, ""),
        ],
        "id int, features map<string,double>, payload string",
    )
    rows = {r["id"]: r for r in bundle.score(events).collect()}
    assert [rows[i]["decision_source"] for i in (1, 2, 3, 4)] == ["fusion", "text-only", "tabular-only", "text-only"]
    assert rows[2]["predicted_class"] == "UNKNOWN" and rows[2]["component_scores"]["anomaly_score"] == 0
    assert rows[2]["explanation"]["triggering_indicators"] == ["credential_access"]
    assert rows[2]["explanation"]["top_features"] == [] and len(rows[1]["explanation"]["top_features"]) == 5
    assert rows[3]["component_scores"]["text_proba"] == 0.5
    assert rows[4]["explanation"]["triggering_indicators"] == []
    assert all(0 <= r["threat_probability"] <= 1 for r in rows.values())


def test_bundle_save_and_load(spark, sf, bundle, tmp_path):
    from flowsift.catalog.models import flat_result
    from flowsift.sources import views

    loaded = ScoringBundle.load(spark, bundle.save(spark, str(tmp_path / "bundle")))
    events = views.events_in(spark, sf).drop("ts")
    a, b = (sorted(flat_result(m.score(events)).collect()) for m in (bundle, loaded))
    assert a == b


def test_stream_score_equals_batch(spark, sf):
    from flowsift.catalog import load

    queries = load()[0]
    assert sorted(queries["stream_score"](spark, sf).collect()) == sorted(queries["score_batch"](spark, sf).collect())


@pytest.mark.parametrize(
    "name",
    [
        "anomaly_fit",
        "anomaly_score",
        "classifier_fit",
        "classifier_proba",
        "feature_importance",
        "text_baseline",
        "text_sequence",
        "score_matrix",
        "fusion_fit",
        "fusion_bakeoff",
        "text_bakeoff",
        "gate_recheck",
        "serve_transform",
    ],
)
def test_model_queries_have_rows(spark, sf, name):
    from flowsift.catalog import load

    assert load()[0][name](spark, sf).count() > 0


def test_every_flow_is_scored_and_fused(spark, sf, monkeypatch):
    from flowsift.catalog import models

    flows = spark.createDataFrame([(i, s, 0.5) for i, s in enumerate(["train", "val", "test"] * 4)], "k int, split string, s double")
    flows = flows.withColumns({c: F.col("k") for c in models.FLOW_KEYS}).withColumn(models.IS_ATTACK, F.col("k") % 2)
    scored = flows.withColumns({c: F.col("s") for c in ("anomaly_score", "attack_proba", "text_proba")})
    fitted = models.Fitted(spark, sf)
    fitted.__dict__.update(_processed=(scored, None), tabular=None, texts=(None, None), payloads=flows, fusion=None)
    monkeypatch.setattr(models, "fitted", lambda *_: fitted)
    monkeypatch.setattr(models.train, "pool_scores", lambda *_: None)
    monkeypatch.setattr(models.train, "joint_scores", lambda flows, *_: flows)
    monkeypatch.setattr(models, "fusion_proba", lambda _: F.lit(0.5))
    matrix = models.score_matrix(spark, sf).collect()
    assert len(matrix) == 12 and {r["split"] for r in matrix} == {"train", "val", "test"}
    assert models.fusion_fit(spark, sf).count() == 12


def test_gate_failure_raises(spark):
    from flowsift.plans.train import require_gate

    table = spark.createDataFrame([("r", False, ["FAIL x"])], "run_id string, passed boolean, reasons array<string>")
    with pytest.raises(SystemExit, match="FAIL x"):
        require_gate(table)
    require_gate(table.withColumn("passed", F.lit(True)))


def test_training_is_recorded(spark, tmp_path):
    from flowsift.models.classifier import TreeSettings
    from flowsift.plans.train import record_training
    from flowsift.sources.tables import read_runs

    metrics = spark.createDataFrame([("pr_auc", 0.9), ("mcc", None)], "metric string, value double")
    decision = spark.createDataFrame([("r1", False, ["low"])], "run_id string, passed boolean, reasons array<string>")
    path = record_training(str(tmp_path / "runs"), "r1", TreeSettings(), metrics, decision)
    rows = {(r["kind"], r["name"]): r["value"] for r in read_runs(spark, path).collect()}
    assert rows["param", "rounds"] == "200" and rows["metric", "pr_auc"] == "0.9" and rows["tag", "passed"] == "False"
    assert ("metric", "mcc") not in rows


def test_batch_margins_equal_mllib(spark):
    """Trees of more than 64 leaves, values that equal a cut, and NaN."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from flowsift.models.classifier import AttackClassifier, TreeSettings

    rng = np.random.default_rng(3)
    x = rng.integers(0, 400, (3000, 3)).astype(float)
    kinds = np.array(["BENIGN", "DoS", "PortScan"])[((x[:, 0] * 7 + x[:, 1] * x[:, 2]) % 97 // 33).astype(int)]
    rows = spark.createDataFrame([(*map(float, r), str(k)) for r, k in zip(x, kinds)], "a double, b double, c double, label string")
    settings = TreeSettings(rounds=4, max_depth=9)
    model = AttackClassifier.fit(rows, None, ["a", "b", "c"], "label", settings)
    assert any(len(w) > 4 for w in model._ensemble.models)
    odd = spark.createDataFrame([(float("nan"), 1.0, 2.0, None), (0.0, float("inf"), float("nan"), None)], rows.schema)
    data = rows.unionByName(odd)
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v", handleInvalid="keep").transform(data)
    parts = []
    for m in model.models:
        scored = m.copy({m.featuresCol: "v"}).transform(vectors).select(vector_to_array("probability")[1].alias("p"))
        parts.append([r["p"] for r in scored.collect()])
    want = np.array(parts).T
    got = np.array([r["probabilities"] for r in model.proba(data).collect()])
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), rtol=0, atol=1e-12)


def test_queries_fit_only_the_models_they_use(spark, sf, monkeypatch):
    from flowsift.catalog import models
    from flowsift.plans import train

    def refuse(*args, **kwargs):
        raise AssertionError("fitted for nothing")

    fresh = models.Fitted(spark, sf)
    for name in ("train_baseline", "train_forest", "train_classifier"):
        monkeypatch.setattr(train, name, refuse)
    monkeypatch.setattr(models, "fitted", lambda *_: fresh)
    assert models.text_threshold(spark, sf).count() == 1
    monkeypatch.undo()
    monkeypatch.setattr(models, "fitted", lambda *_: fresh)
    monkeypatch.setattr(train, "train_classifier", refuse)
    assert models.anomaly_score(spark, sf).count() > 0
