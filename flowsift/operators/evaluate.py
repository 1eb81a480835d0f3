"""Imbalance-aware evaluation, the promotion gate and model comparison."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.numeric import range_number, ratio, threshold_flag
from flowsift.operators.ranking import solid_strata
from flowsift.schema import LABELS

# Score ranges per power of two, for every so many rows.
OCTAVE_RANGES, RANGE_ROWS = 256, 1 << 22


def pr_curve(
    df: DataFrame, y: str, score: str, by: Sequence[str] = (), range_rows: int = RANGE_ROWS
) -> DataFrame:
    """(by, score, positives, tp, fp, precision, recall) at every distinct score, highest first.

    Rows without a score are left out. Tied scores are merged before the shuffle. The running sums
    are taken inside score ranges of each group, and each range adds the totals of the ranges above
    it, so no task orders all scores. Ranges get finer as the table grows.
    """
    by = list(by)
    keyed, keys = solid_strata(df.where(F.col(score).isNotNull()), by)
    ties = keyed.groupBy(*by, *keys, F.col(score).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("positives"), F.count(F.lit(1)).alias("__rows")
    )
    finer = OCTAVE_RANGES * (1 + df.count() // range_rows)
    ties = ties.withColumn("__range", range_number(F.col("score").cast("double"), finer))

    group = Window.partitionBy(*keys)
    above = group.orderBy(F.col("__range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ties.groupBy(*keys, "__range")
        .agg(F.sum("positives").alias("__p"), F.sum("__rows").alias("__n"))
        .select(
            *keys,
            "__range",
            F.coalesce(F.sum("__p").over(above), F.lit(0)).alias("__p0"),
            F.coalesce(F.sum("__n").over(above), F.lit(0)).alias("__n0"),
            F.sum("__p").over(group).alias("__total"),
        )
    )
    run = (
        Window.partitionBy(*keys, "__range")
        .orderBy(F.col("score").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    tp = F.col("__p0") + F.sum("positives").over(run)
    seen = F.col("__n0") + F.sum("__rows").over(run)
    return (
        ties.join(offsets, [*keys, "__range"])
        .select(*by, "score", "positives", tp.alias("tp"), (seen - tp).alias("fp"), "__total")
        .select(
            *by,
            "score",
            "positives",
            "tp",
            "fp",
            ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
            ratio(F.col("tp"), F.col("__total"), empty=1.0).alias("recall"),
        )
    )


def average_precision(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum over distinct scores of recall gain times precision; 0 without positives."""
    return pr_curve(df, y, score, by).groupBy(*by).agg(_area().alias("average_precision"))


def _area() -> Column:
    return ratio(F.sum(F.col("positives") * F.col("precision")), F.sum("positives"))


def _best_point(target: float) -> Column:
    reached = F.col("recall") >= F.lit(float(target))
    worth = F.struct(
        reached.cast("int").alias("reached"),
        F.when(reached, F.col("precision")).otherwise(F.col("recall")).alias("value"),
        (-F.col("score")).alias("lowest"),
    )
    return F.max_by(F.struct(F.col("score").alias("threshold"), "precision", "recall"), worth)


def threshold_at_recall(
    df: DataFrame, y: str, score: str, target: float, by: Sequence[str] = ()
) -> DataFrame:
    """The most precise threshold with recall >= target, the lowest on ties.

    If no threshold reaches the target, the one with the highest recall.
    """
    best = pr_curve(df, y, score, by).groupBy(*by).agg(_best_point(target).alias("b"))
    return best.select(*by, "b.threshold", "b.precision", "b.recall")


def confusion(
    df: DataFrame, y: str, score: str, threshold: float | Column, by: Sequence[str] = ()
) -> DataFrame:
    """tp, fp, fn, tn in one pass."""
    flag = threshold_flag(F.col(score), threshold)
    truth = F.col(y)
    return df.groupBy(*by).agg(
        F.count_if((truth == 1) & (flag == 1)).alias("tp"),
        F.count_if((truth == 0) & (flag == 1)).alias("fp"),
        F.count_if((truth == 1) & (flag == 0)).alias("fn"),
        F.count_if((truth == 0) & (flag == 0)).alias("tn"),
    )


def precision_of() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def recall_of() -> Column:
    return ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def f1_of() -> Column:
    return ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def mcc_of() -> Column:
    """Matthews correlation in doubles (the products leave the bigint range); 0 if a margin is empty."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    margins = F.sqrt((tp + fp) * (tp + fn)) * F.sqrt((tn + fp) * (tn + fn))
    return ratio(tp * tn - fp * fn, margins)


def per_class_recall(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Recall per true class; classes without rows do not appear."""
    hit = F.coalesce(F.col(truth) == F.col(predicted), F.lit(False))
    return (
        df.where(F.col(truth).isin(*LABELS))
        .groupBy(*by, F.col(truth).alias("class"))
        .agg((F.count_if(hit) / F.count(F.lit(1))).alias("recall"))
    )


def min_class_recall(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return per_class_recall(df, truth, predicted, by).groupBy(*by).agg(
        F.min("recall").alias("min_per_class_recall")
    )


def metric_table(
    df: DataFrame, truth: str, predicted: str, y: str, score: str, target: float
) -> DataFrame:
    """(metric, value): the headline metrics at the threshold chosen for the target recall.

    One pass over the curve yields area and threshold, a second the counts, a third the class
    recalls; only single rows travel between them.
    """
    point = pr_curve(df, y, score).agg(_area().alias("area"), _best_point(target).alias("best")).first()
    if point["best"] is None:
        raise ValueError("no scores to evaluate")
    limit = point["best"]["threshold"]
    values = {
        "pr_auc": F.lit(point["area"]),
        "threshold": F.lit(limit),
        "mcc": mcc_of(),
        "recall_at_threshold": recall_of(),
        "precision_at_threshold": precision_of(),
    }
    rows = [F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in values.items()]
    headline = confusion(df, y, score, limit).select(F.inline(F.array(*rows)))
    recalls = per_class_recall(df, truth, predicted)
    named = F.struct(
        F.concat(F.lit("recall_"), F.replace(F.col("class"), F.lit(" "), F.lit("_"))).alias("metric"),
        F.col("recall").alias("value"),
    )
    # At most one row per class reaches the single task that adds the minimum.
    worst = F.struct(F.lit("min_per_class_recall").alias("metric"), F.min("recall").alias("value"))
    table = recalls.agg(F.collect_list(named).alias("all"), worst.alias("worst")).where("size(all) > 0")
    return headline.unionByName(table.select(F.inline(F.concat("all", F.array("worst")))))


@dataclass(frozen=True)
class GateLimits:
    """Default promotion limits."""

    min_pr_auc: float = 0.80
    min_per_class_recall: float = 0.50
    max_p99_latency_ms: float = 50.0


def evaluate_gate(
    metrics: DataFrame,
    limits: GateLimits = GateLimits(),
    run: str = "run_id",
    incumbent_pr_auc: float | None = None,
    p99_latency_ms: float | None = None,
) -> DataFrame:
    """(run, check, passed, reason): the promotion checks that apply to each run.

    ``metrics`` is the tall table (run, metric, value). The PR-AUC floor always applies and a
    missing value counts as 0; the recall floor applies where the metric is present; the other two
    when an incumbent or a latency is given.
    """

    def metric(name: str) -> Column:
        return F.max(F.when(F.col("metric") == name, F.col("value"))).alias(name)

    wide = metrics.groupBy(run).agg(metric("pr_auc"), metric("min_per_class_recall"))
    area = F.coalesce(F.col("pr_auc"), F.lit(0.0))
    worst = F.col("min_per_class_recall")

    def check(name: str, ok: Column, good: Column, bad: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            ok.alias("passed"),
            F.when(ok, F.concat(F.lit("PASS "), good)).otherwise(F.concat(F.lit("FAIL "), bad)).alias("reason"),
        )

    def floor(name: str, value: Column, limit: float) -> Column:
        return check(
            name,
            value >= F.lit(limit),
            F.format_string(f"{name} %.3f >= {limit}", value),
            F.format_string(f"{name} %.3f < {limit}", value),
        )

    checks = [
        floor("pr_auc", area, limits.min_pr_auc),
        F.when(worst.isNotNull(), floor("min_per_class_recall", worst, limits.min_per_class_recall)),
    ]
    if incumbent_pr_auc is not None:
        old = F.lit(float(incumbent_pr_auc))
        checks.append(
            check(
                "pr_auc_regression",
                area >= old,
                F.format_string("no PR-AUC regression (%.3f >= incumbent %.3f)", area, old),
                F.format_string("PR-AUC regression (%.3f < incumbent %.3f)", area, old),
            )
        )
    if p99_latency_ms is not None:
        p99, budget = F.lit(float(p99_latency_ms)), f"{limits.max_p99_latency_ms:g}"
        checks.append(
            check(
                "p99_latency",
                p99 <= F.lit(limits.max_p99_latency_ms),
                F.format_string(f"p99 %.1fms <= {budget}ms", p99),
                F.format_string(f"p99 %.1fms > {budget}ms", p99),
            )
        )
    return wide.select(run, F.inline(F.array_compact(F.array(*checks))))


def gate_decision(checks: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, passed, reasons): a run passes when all its checks pass."""
    return checks.groupBy(run).agg(
        F.bool_and("passed").alias("passed"), F.array_sort(F.collect_list("reason")).alias("reasons")
    )


def bakeoff(
    scored: DataFrame, model: str, y: str, score: str, flag: str, candidate: str, baseline: str
) -> DataFrame:
    """One row comparing two models of a long score table on average precision and F1."""
    both = scored.where(F.col(model).isin(candidate, baseline))
    truth, said = F.col(y), F.col(flag)
    f1 = (
        both.groupBy(model)
        .agg(
            F.count_if((truth == 1) & (said == 1)).alias("tp"),
            F.count_if((truth == 0) & (said == 1)).alias("fp"),
            F.count_if((truth == 1) & (said == 0)).alias("fn"),
        )
        .select(model, f1_of().alias("f1"))
    )
    table = average_precision(both, y, score, [model]).join(f1, model)

    def of(name: str, value: str) -> Column:
        return F.max(F.when(F.col(model) == name, F.col(value)))

    return table.agg(
        of(candidate, "average_precision").alias("candidate_pr_auc"),
        of(baseline, "average_precision").alias("baseline_pr_auc"),
        of(candidate, "f1").alias("candidate_f1"),
        of(baseline, "f1").alias("baseline_f1"),
    ).select(
        "*",
        (F.col("candidate_pr_auc") - F.col("baseline_pr_auc")).alias("pr_auc_uplift"),
        (F.col("candidate_f1") - F.col("baseline_f1")).alias("f1_uplift"),
        (F.col("candidate_pr_auc") >= F.col("baseline_pr_auc")).alias("beats_on_pr_auc"),
        (F.col("candidate_f1") >= F.col("baseline_f1")).alias("beats_on_f1"),
    )
