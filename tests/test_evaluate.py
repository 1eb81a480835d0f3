import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.operators import decide, evaluate, monitor, versions
from flowsift.operators.evaluate import GateLimits


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, s double")


@pytest.fixture(scope="module")
def big(spark):
    """A third of the rows share one score."""
    s = F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.abs(F.sin("id")))
    y = (F.abs(F.sin(F.col("id") * 7)) < F.when(F.col("id") % 3 == 0, 0.2).otherwise(F.abs(F.sin("id")))).cast("int")
    return spark.range(6000).select("id", s.alias("s"), y.alias("y"), (F.col("id") % 2).alias("g"))


def curve_by_hand(y, s):
    out, total = [], sum(y)
    for t in sorted(set(s), reverse=True):
        tp = sum(a for a, b in zip(y, s) if b >= t)
        n = sum(1 for b in s if b >= t)
        out.append((t, tp, n - tp, tp / n, tp / total))
    return out


def test_curve_small(small):
    rows = evaluate.pr_curve(small, "y", "s").orderBy(F.desc("score")).collect()
    assert [(r["score"], r["tp"], r["fp"], r["precision"], r["recall"]) for r in rows] == curve_by_hand(
        [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8]
    )
    assert evaluate.average_precision(small, "y", "s").first()[0] == pytest.approx(0.8333333333)


@pytest.mark.parametrize("range_rows", [1, 100, 1 << 22])
def test_curve_does_not_depend_on_ranges(big, range_rows):
    rows = evaluate.pr_curve(big, "y", "s", range_rows=range_rows).orderBy(F.desc("score")).collect()
    data = big.collect()
    y, s = np.array([r["y"] for r in data]), np.array([r["s"] for r in data])
    order = np.argsort(-s, kind="stable")
    tp, last = np.cumsum(y[order]), np.append(np.diff(s[order]) != 0, True)
    assert [r["tp"] for r in rows] == list(tp[last])
    assert [r["tp"] + r["fp"] for r in rows] == list(np.arange(1, len(s) + 1)[last])


def test_average_precision_by_group(big):
    grouped = {r["g"]: r["average_precision"] for r in evaluate.average_precision(big, "y", "s", ["g"]).collect()}
    for g, value in grouped.items():
        alone = evaluate.average_precision(big.where(F.col("g") == g), "y", "s").first()[0]
        assert value == pytest.approx(alone, rel=1e-12)


def test_no_positives(small):
    none = small.withColumn("y", F.lit(0))
    assert evaluate.average_precision(none, "y", "s").first()[0] == 0.0
    assert {r["recall"] for r in evaluate.pr_curve(none, "y", "s").collect()} == {1.0}


def test_threshold(small, spark):
    best = evaluate.threshold_at_recall(small, "y", "s", 0.5).first()
    assert tuple(best) == (0.8, 1.0, 0.5)
    best = evaluate.threshold_at_recall(small, "y", "s", 0.9).first()
    assert best["threshold"] == 0.35 and best["recall"] == 1.0
    tied = spark.createDataFrame([(1, 0.9), (1, 0.7), (0, 0.1)], "y int, s double")
    assert evaluate.threshold_at_recall(tied, "y", "s", 0.5).first()["threshold"] == 0.7
    assert evaluate.threshold_at_recall(small, "y", "s", 1.5).first()["threshold"] == 0.1


def counts(spark, tp, fp, fn, tn):
    return spark.createDataFrame([(tp, fp, fn, tn)], "tp bigint, fp bigint, fn bigint, tn bigint")


def test_confusion_metrics(small, spark):
    c = evaluate.confusion(small, "y", "s", 0.35)
    assert tuple(c.first()) == (2, 1, 0, 1)
    row = c.select(evaluate.precision_of(), evaluate.recall_of(), evaluate.f1_of(), evaluate.mcc_of()).first()
    assert tuple(row) == pytest.approx((2 / 3, 1.0, 0.8, 0.5773502692))
    empty = counts(spark, 0, 0, 0, 7)
    assert tuple(
        empty.select(evaluate.precision_of(), evaluate.recall_of(), evaluate.f1_of(), evaluate.mcc_of()).first()
    ) == (0, 0, 0, 0)
    huge = counts(spark, 4 * 10**10, 10**10, 10**10, 4 * 10**10)
    assert huge.select(evaluate.mcc_of()).first()[0] == pytest.approx(0.6)


def test_class_recall(spark):
    df = spark.createDataFrame(
        [("DoS", "DoS"), ("DoS", "BENIGN"), ("BENIGN", "BENIGN"), ("Odd", "Odd")], "t string, p string"
    )
    rows = {r["class"]: r["recall"] for r in evaluate.per_class_recall(df, "t", "p").collect()}
    assert rows == {"DoS": 0.5, "BENIGN": 1.0}
    assert evaluate.min_class_recall(df, "t", "p").first()[0] == 0.5


def test_metric_table(spark):
    df = spark.createDataFrame(
        [("Web Attack", "Web Attack", 1, 0.9), ("BENIGN", "DoS", 0, 0.8), ("BENIGN", "BENIGN", 0, 0.1)],
        "t string, p string, y int, s double",
    )
    got = {r["metric"]: r["value"] for r in evaluate.metric_table(df, "t", "p", "y", "s", 0.8).collect()}
    assert got == {
        "pr_auc": 1.0,
        "threshold": 0.9,
        "mcc": 1.0,
        "recall_at_threshold": 1.0,
        "precision_at_threshold": 1.0,
        "recall_Web_Attack": 1.0,
        "recall_BENIGN": 0.5,
        "min_per_class_recall": 0.5,
    }


def gate(spark, metrics, **kw):
    rows = [("r", k, float(v)) for k, v in metrics.items()]
    checks = evaluate.evaluate_gate(spark.createDataFrame(rows, "run_id string, metric string, value double"), **kw)
    return evaluate.gate_decision(checks).first()


def test_gate_rules(spark):
    good = {"pr_auc": 0.9, "min_per_class_recall": 0.6}
    assert gate(spark, good)["passed"]
    assert not gate(spark, {**good, "pr_auc": 0.7})["passed"]
    assert not gate(spark, {**good, "min_per_class_recall": 0.4})["passed"]
    assert not gate(spark, {"other": 1.0})["passed"]
    assert gate(spark, {"pr_auc": 0.9})["reasons"] == ["PASS pr_auc 0.900 >= 0.8"]
    assert not gate(spark, good, incumbent_pr_auc=0.95)["passed"]
    assert gate(spark, good, incumbent_pr_auc=0.9)["passed"]
    assert not gate(spark, good, p99_latency_ms=51.0)["passed"]
    assert gate(spark, good, p99_latency_ms=50.0)["passed"]
    assert gate(spark, good, limits=GateLimits(0.95, 0.5))["reasons"][0] == "FAIL pr_auc 0.900 < 0.95"


def test_top_features(spark):
    names = ["a", "b", "c"]
    df = spark.createDataFrame([(1.0, -2.0, 1.0)], "a double, b double, c double")
    top = df.select(decide.top_features([F.col(n) for n in names], names, {"a": 0.3, "b": 0.1, "c": 0.3}, 2).alias("t")).first()["t"]
    assert [r["feature"] for r in top] == ["c", "a"]
    assert top[0].asDict() == {"feature": "c", "scaled_value": 1.0, "importance": 0.3}


def test_routing(spark):
    df = spark.createDataFrame(
        [(True, True, 0.9), (False, True, 0.9), (True, False, 0.9)], "f boolean, p boolean, text_proba double"
    ).withColumns({"anomaly_score": F.lit(0.1), "attack_proba": F.lit(0.2), "predicted_class": F.lit("DoS")})
    weights = decide.FusionWeights((0, 0, 0), (1, 1, 1), (0, 0, 1), 0.0)
    settings = decide.RouteSettings(0.65, 0.95)
    f, p = F.col("f"), F.col("p")
    rows = decide.route(decide.fill_modalities(df, f, p, settings), f, p, weights, settings).collect()
    assert [r["decision_source"] for r in rows] == ["fusion", "text-only", "tabular-only"]
    assert [r["is_threat"] for r in rows] == [True, False, False]
    assert rows[1]["threat_proba"] == 0.9 and rows[1]["predicted_class"] == "UNKNOWN"
    assert rows[2]["text_proba"] == 0.5


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.15,), (2.0,), (None,)], "v double")
    rows = monitor.cumulative_histogram(df, "v", (0.0, 0.1, 1.0)).collect()
    assert [(r["le"], r["cumulative"]) for r in rows] == [(0.0, 1), (0.1, 2), (1.0, 3), (float("inf"), 4)]
    assert rows[0]["total"] == pytest.approx(2.25) and rows[0]["observations"] == 4


def test_versions(spark):
    known = spark.createDataFrame([("a", "1"), ("a", "10"), ("a", "9"), ("b", "2")], "name string, version string")
    assert {r["name"]: r["latest"] for r in versions.latest_version(known).collect()} == {"a": 10, "b": 2}
    empty = spark.createDataFrame([], "name string, alias string, version bigint")
    first = versions.promote(empty, known, "a")
    second = versions.promote(first, known, "a", 9)
    assert [tuple(r) for r in second.collect()] == [("a", "production", 9)]
    assert {r["name"]: r["version"] for r in versions.resolve(known, second).collect()} == {"a": 9, "b": None}
    with pytest.raises(ValueError):
        versions.promote(empty, known, "missing")
