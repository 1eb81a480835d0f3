"""Curves, thresholds, confusion metrics, the gate and model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.catalog import query
from flowsift.catalog.sql import with_views
from flowsift.operators import evaluate
from flowsift.operators.monitor import latency_check
from flowsift.plans.train import long_scores
from flowsift.sources import views

LIMIT = 0.3
TARGET = 0.8


def curve_sql(source: str = "scored", by: str = "") -> dict[str, str]:
    """Precision-recall points by plain running sums."""
    over = f"OVER ({f'PARTITION BY {by}' if by else ''} ORDER BY score DESC)"
    part = f"OVER ({f'PARTITION BY {by}' if by else ''})"
    lead = f"{by}, " if by else ""
    return {
        "ties": f"SELECT {lead}score, sum(y) AS p, count(*) AS n FROM {source} GROUP BY {lead}score",
        "run": f"SELECT {lead}score, p, sum(p) {over} AS tp, sum(n) {over} AS seen, sum(p) {part} AS total FROM ties",
        "curve": f"""SELECT {lead}score, CAST(p AS BIGINT) AS positives, CAST(tp AS BIGINT) AS tp,
                            CAST(seen - tp AS BIGINT) AS fp, tp::DOUBLE / seen::DOUBLE AS precision,
                            CASE WHEN total = 0 THEN 1::DOUBLE ELSE tp::DOUBLE / total::DOUBLE END AS recall FROM run""",
    }


CURVE = curve_sql()
AP = "coalesce(sum(positives * precision) / nullif(sum(positives), 0), 0)"
BEST = f"""SELECT score AS threshold, precision, recall FROM curve
           ORDER BY recall >= {TARGET}::DOUBLE DESC,
                    CASE WHEN recall >= {TARGET}::DOUBLE THEN precision ELSE recall END DESC, score LIMIT 1"""
COUNTS = f"""SELECT count(*) FILTER (y = 1 AND score >= {LIMIT}::DOUBLE) AS tp,
                    count(*) FILTER (y = 0 AND score >= {LIMIT}::DOUBLE) AS fp,
                    count(*) FILTER (y = 1 AND score < {LIMIT}::DOUBLE) AS fn,
                    count(*) FILTER (y = 0 AND score < {LIMIT}::DOUBLE) AS tn FROM scored"""
MCC = """coalesce((tp::DOUBLE * tn - fp::DOUBLE * fn) / nullif(sqrt((tp + fp)::DOUBLE) * sqrt((tp + fn)::DOUBLE)
         * sqrt((tn + fp)::DOUBLE) * sqrt((tn + fn)::DOUBLE), 0), 0)"""
PRECISION = "coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0)"
RECALL = "coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)"
F1 = "coalesce((2 * tp)::DOUBLE / nullif(2 * tp + fp + fn, 0), 0)"
CLASS_RECALL = """SELECT truth AS class, count(*) FILTER (predicted = truth)::DOUBLE / count(*) AS recall
                  FROM scored GROUP BY truth"""


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion(views.scored(spark, sf), "y", "score", LIMIT)


@query("pr_curve", with_views("SELECT * FROM curve", "scored", **CURVE))
def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.pr_curve(views.scored(spark, sf), "y", "score")


@query(
    "average_precision",
    with_views(f"SELECT round({AP}, 9) AS average_precision FROM curve", "scored", **CURVE),
)
def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    area = evaluate.average_precision(views.scored(spark, sf), "y", "score")
    return area.select(F.round("average_precision", 9).alias("average_precision"))


@query(
    "average_precision_by_class",
    with_views(
        f"SELECT predicted, round({AP}, 9) AS average_precision FROM curve GROUP BY predicted",
        "scored",
        **curve_sql(by="predicted"),
    ),
)
def average_precision_by_class(spark: SparkSession, sf: str) -> DataFrame:
    area = evaluate.average_precision(views.scored(spark, sf), "y", "score", ["predicted"])
    return area.select("predicted", F.round("average_precision", 9).alias("average_precision"))


@query("threshold_at_recall", with_views(BEST, "scored", **CURVE))
def threshold_at_recall(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.threshold_at_recall(views.scored(spark, sf), "y", "score", TARGET)


@query("confusion", with_views(COUNTS, "scored"))
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return counts(spark, sf)


@query(
    "precision_recall_at",
    with_views(f"SELECT {PRECISION} AS precision, {RECALL} AS recall FROM counts", "scored", counts=COUNTS),
)
def precision_recall_at(spark: SparkSession, sf: str) -> DataFrame:
    return counts(spark, sf).select(
        evaluate.precision_of().alias("precision"), evaluate.recall_of().alias("recall")
    )


@query("mcc", with_views(f"SELECT round({MCC}, 9) AS mcc FROM counts", "scored", counts=COUNTS))
def mcc(spark: SparkSession, sf: str) -> DataFrame:
    return counts(spark, sf).select(F.round(evaluate.mcc_of(), 9).alias("mcc"))


@query("f1", with_views(f"SELECT {F1} AS f1 FROM counts", "scored", counts=COUNTS))
def f1(spark: SparkSession, sf: str) -> DataFrame:
    return counts(spark, sf).select(evaluate.f1_of().alias("f1"))


@query("per_class_recall", with_views(CLASS_RECALL, "scored"))
def per_class_recall(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.per_class_recall(views.scored(spark, sf), "truth", "predicted")


@query(
    "min_class_recall",
    with_views("SELECT min(recall) AS min_per_class_recall FROM recalls", "scored", recalls=CLASS_RECALL),
)
def min_class_recall(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.min_class_recall(views.scored(spark, sf), "truth", "predicted")


@query(
    "metric_table",
    with_views(
        f"""SELECT metric, round(value, 9) AS value FROM (
            SELECT 'pr_auc' AS metric, {AP} AS value FROM curve
            UNION ALL SELECT 'mcc', {MCC} FROM counts
            UNION ALL SELECT 'recall_at_threshold', {RECALL} FROM counts
            UNION ALL SELECT 'precision_at_threshold', {PRECISION} FROM counts
            UNION ALL SELECT 'threshold', threshold FROM best
            UNION ALL SELECT 'recall_' || replace(class, ' ', '_'), recall FROM recalls
            UNION ALL SELECT 'min_per_class_recall', min(recall) FROM recalls)""",
        "scored",
        **CURVE,
        best=BEST,
        counts=COUNTS.replace(f"{LIMIT}::DOUBLE", "(SELECT threshold FROM best)"),
        recalls=CLASS_RECALL,
    ),
)
def metric_table(spark: SparkSession, sf: str) -> DataFrame:
    table = evaluate.metric_table(views.scored(spark, sf), "truth", "predicted", "y", "score", TARGET)
    return table.select("metric", F.round("value", 9).alias("value"))


def segment_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """One run per event type, from its own numbers; two of the runs have no recall metric."""
    scored = views.scored(spark, sf)
    area = scored.groupBy(F.col("event_type").alias("run_id")).agg(F.max("score").alias("value"))
    recall = scored.where(~F.col("event_type").isin("view", "click")).groupBy(
        F.col("event_type").alias("run_id")
    ).agg((F.avg("score") * 2).alias("value"))
    return area.withColumn("metric", F.lit("pr_auc")).unionByName(
        recall.withColumn("metric", F.lit("min_per_class_recall"))
    )


GATE = {
    "runs": """SELECT event_type AS run_id, max(score) AS area,
                      CASE WHEN event_type NOT IN ('view', 'click') THEN avg(score) * 2 END AS worst
               FROM scored GROUP BY event_type""",
    "checks": """
        SELECT run_id, 'pr_auc' AS "check", area >= 0.8::DOUBLE AS passed,
               CASE WHEN area >= 0.8::DOUBLE THEN printf('PASS pr_auc %.3f >= 0.8', area)
                    ELSE printf('FAIL pr_auc %.3f < 0.8', area) END AS reason FROM runs
        UNION ALL
        SELECT run_id, 'min_per_class_recall', worst >= 0.5::DOUBLE,
               CASE WHEN worst >= 0.5::DOUBLE THEN printf('PASS min_per_class_recall %.3f >= 0.5', worst)
                    ELSE printf('FAIL min_per_class_recall %.3f < 0.5', worst) END FROM runs WHERE worst IS NOT NULL
        UNION ALL
        SELECT run_id, 'pr_auc_regression', area >= 0.88::DOUBLE,
               CASE WHEN area >= 0.88::DOUBLE THEN printf('PASS no PR-AUC regression (%.3f >= incumbent 0.880)', area)
                    ELSE printf('FAIL PR-AUC regression (%.3f < incumbent 0.880)', area) END FROM runs
        UNION ALL
        SELECT run_id, 'p99_latency', FALSE, 'FAIL p99 61.5ms > 50ms' FROM runs""",
}


def gate_checks(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.evaluate_gate(
        segment_metrics(spark, sf), incumbent_pr_auc=0.88, p99_latency_ms=61.5
    )


@query("gate", with_views("SELECT * FROM checks", "scored", **GATE))
def gate(spark: SparkSession, sf: str) -> DataFrame:
    return gate_checks(spark, sf)


@query(
    "gate_decision",
    with_views(
        """SELECT run_id, bool_and(passed) AS passed, string_agg(reason, '; ' ORDER BY reason) AS reasons
           FROM checks GROUP BY run_id""",
        "scored",
        **GATE,
    ),
)
def gate_decision(spark: SparkSession, sf: str) -> DataFrame:
    decided = evaluate.gate_decision(gate_checks(spark, sf))
    return decided.select("run_id", "passed", F.array_join("reasons", "; ").alias("reasons"))


_models = {
    "long": """SELECT 'attack' AS model, y, attack_proba AS score, CAST(attack_proba >= 0.4::DOUBLE AS INTEGER) AS flag FROM scores3
               UNION ALL SELECT 'text', y, text_proba, CAST(text_proba >= 0.5::DOUBLE AS INTEGER) FROM scores3""",
    **curve_sql("long", "model"),
    "areas": f"SELECT model, {AP} AS area FROM curve GROUP BY model",
    "f": f"""SELECT model, {F1} AS f1 FROM (
               SELECT model, count(*) FILTER (y = 1 AND flag = 1) AS tp, count(*) FILTER (y = 0 AND flag = 1) AS fp,
                      count(*) FILTER (y = 1 AND flag = 0) AS fn FROM long GROUP BY model)""",
    "pair": """SELECT max(area) FILTER (model = 'attack') AS ca, max(area) FILTER (model = 'text') AS ba,
                      max(f1) FILTER (model = 'attack') AS cf, max(f1) FILTER (model = 'text') AS bf
               FROM areas JOIN f USING (model)""",
}


@query(
    "bakeoff",
    with_views(
        """SELECT round(ca, 9) AS candidate_pr_auc, round(ba, 9) AS baseline_pr_auc, round(cf, 9) AS candidate_f1,
                  round(bf, 9) AS baseline_f1, round(ca - ba, 9) AS pr_auc_uplift, round(cf - bf, 9) AS f1_uplift,
                  ca >= ba AS beats_on_pr_auc, cf >= bf AS beats_on_f1 FROM pair""",
        "scores3",
        **_models,
    ),
)
def bakeoff(spark: SparkSession, sf: str) -> DataFrame:
    long = long_scores(
        views.scores3(spark, sf), "y", {"attack": ("attack_proba", 0.4), "text": ("text_proba", 0.5)}
    )
    row = evaluate.bakeoff(long, "model", "y", "score", "flag", "attack", "text")
    return row.select(*[c if c.startswith("beats") else F.round(c, 9).alias(c) for c in row.columns])


@query(
    "latency_p99",
    """SELECT round(quantile_cont(value, 0.99), 6) AS p99, 50::DOUBLE AS budget,
              quantile_cont(value, 0.99) <= 50 AS within_budget FROM events""",
)
def latency_p99(spark: SparkSession, sf: str) -> DataFrame:
    row = latency_check(views.latency(spark, sf), "millis", 50.0)
    return row.withColumn("p99", F.round("p99", 6))
