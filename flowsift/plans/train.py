"""Training jobs: tabular, text, fusion; and the gate re-check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.models.classifier import AttackClassifier, TreeSettings
from flowsift.models.forest import IsolationForest
from flowsift.models.fusion import SCORES, fit_fusion, fusion_proba
from flowsift.models.textmodels import TextBaseline, TextSequence
from flowsift.operators.decide import FusionWeights
from flowsift.operators.evaluate import GateLimits, bakeoff, evaluate_gate, gate_decision, metric_table
from flowsift.operators.fitting import contamination, minmax_average
from flowsift.operators.joins import spread
from flowsift.operators.sampling import pair_payloads
from flowsift.schema import IS_ATTACK
from flowsift.session import stage
from flowsift.sources.tables import append_run


def part(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


@dataclass(frozen=True)
class TabularModels:
    forest: IsolationForest
    classifier: AttackClassifier

    def save(self, spark: SparkSession, path: str) -> str:
        self.forest.to_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/forest")
        self.classifier.save(spark, f"{path}/classifier")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TabularModels:
        forest = IsolationForest.from_table(spark.read.parquet(f"{path}/forest"))
        return cls(forest, AttackClassifier.load(spark, f"{path}/classifier"))


def train_tabular(
    processed: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    label: str,
    settings: TreeSettings = TreeSettings(),
    kind: str = "boosted",
    forest_trees: int = 200,
    rate: float | str = "auto",
    seed: int = 42,
) -> TabularModels:
    """Forest cut at the training prevalence, classifier stopped on validation rows."""
    forest = train_forest(processed, features, keys, forest_trees, rate, seed)
    return TabularModels(forest, train_classifier(processed, features, label, settings, kind, seed))


def train_forest(
    processed: DataFrame, features: Sequence[str], keys: Sequence[str], trees: int = 200, rate: float | str = "auto", seed: int = 42
) -> IsolationForest:
    train = part(processed, "train")
    share = contamination(train, IS_ATTACK, rate).first()["contamination"]
    forest = IsolationForest.fit(train, features, keys, trees, seed=seed)
    scores = train.select(forest.raw_score(train.sparkSession).alias("s"))
    return forest.with_offset(stage(scores, "forest-scores"), "s", share)


def train_classifier(
    processed: DataFrame,
    features: Sequence[str],
    label: str,
    settings: TreeSettings = TreeSettings(),
    kind: str = "boosted",
    seed: int = 42,
) -> AttackClassifier:
    return AttackClassifier.fit(part(processed, "train"), part(processed, "val"), features, label, settings, kind, seed)


def tabular_metrics(
    models: TabularModels, test: DataFrame, label: str, target_recall: float = 0.80
) -> DataFrame:
    """(metric, value) of the classifier on held-out rows."""
    scored = models.classifier.score(test).select(
        F.col(label).alias("truth"), "predicted_class", F.col(IS_ATTACK).alias("y"), "attack_proba"
    )
    return metric_table(stage(scored, "test-scores"), "truth", "predicted_class", "y", "attack_proba", target_recall)


def gate_check(
    models: TabularModels,
    test: DataFrame,
    label: str,
    limits: GateLimits = GateLimits(),
    run_id: str = "candidate",
    target_recall: float = 0.80,
    incumbent_pr_auc: float | None = None,
    p99_latency_ms: float | None = None,
) -> DataFrame:
    """(run_id, passed, reasons) of the models re-scored on the test split."""
    metrics = tabular_metrics(models, test, label, target_recall).withColumn("run_id", F.lit(run_id))
    checks = evaluate_gate(
        metrics, limits, incumbent_pr_auc=incumbent_pr_auc, p99_latency_ms=p99_latency_ms
    )
    return gate_decision(checks)


def require_gate(decision: DataFrame) -> None:
    """Raise unless every run passes, so that a submitted job exits with an error."""
    failed = decision.where(~F.col("passed")).select("run_id", "reasons")
    number = failed.count()
    if number:
        first = "; ".join(f"{r['run_id']}: {', '.join(r['reasons'])}" for r in failed.orderBy("run_id").take(20))
        raise SystemExit(first if number <= 20 else f"{number} runs fail, the first by id: {first}")


def record_training(
    runs: str,
    run_id: str,
    settings: object,
    metrics: DataFrame,
    decision: DataFrame | None = None,
) -> str:
    """Append a training job to the run table: its settings, its metrics, and whether it passed the gate.

    ``metrics`` has rows of (metric, value), ``decision`` the run's row of ``gate_check``.
    """
    spark = metrics.sparkSession
    found = {r["metric"]: r["value"] for r in metrics.collect() if r["value"] is not None}
    tags: dict[str, object] = {}
    if decision is not None:
        row = decision.where(F.col("run_id") == run_id).head()
        tags = {"passed": row["passed"], "reasons": ", ".join(row["reasons"] or [])}
    return append_run(spark, runs, run_id, asdict(settings), found, tags=tags)


def train_text(
    payloads: DataFrame, text: str, label: str, target_recall: float = 0.80, iterations: int = 50
) -> tuple[TextSequence, TextBaseline]:
    """Both payload models; each can also be fitted alone."""
    return train_sequence(payloads, text, label, target_recall), train_baseline(payloads, text, label, iterations)


def train_sequence(payloads: DataFrame, text: str, label: str, target_recall: float = 0.80) -> TextSequence:
    train, val = (spread(part(payloads, p).select(text, label), text) for p in ("train", "val"))
    return TextSequence.fit(train, text, label).with_threshold(val, label, target_recall)


def train_baseline(payloads: DataFrame, text: str, label: str, iterations: int = 50) -> TextBaseline:
    return TextBaseline.fit(spread(part(payloads, "train").select(text, label), text), text, label, iterations=iterations)


def long_scores(df: DataFrame, y: str, models: Mapping[str, tuple[str, float]]) -> DataFrame:
    """(model, y, score, flag): one row per model and input row."""
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(y).cast("int").alias("y"),
            F.col(score).alias("score"),
            (F.col(score) >= F.lit(limit)).cast("int").alias("flag"),
        )
        for name, (score, limit) in models.items()
    ]
    return df.select(F.inline(F.array(*rows)))


def text_bakeoff(sequence: TextSequence, baseline: TextBaseline, test: DataFrame, label: str) -> DataFrame:
    texts = spread(test.select(label, sequence.text), sequence.text)
    scored = baseline.score(sequence.score(texts)).select(label, "text_proba", "baseline_proba")
    long = long_scores(
        stage(scored, "text-scores"),
        label,
        {"sequence": ("text_proba", sequence.threshold), "baseline": ("baseline_proba", 0.5)},
    )
    return bakeoff(long, "model", "y", "score", "flag", "sequence", "baseline")


def pool_scores(payloads: DataFrame, keys: Sequence[str], label: str, text: TextSequence) -> DataFrame:
    """Payloads scored once, before any pairing: only their score travels through the join."""
    spread_out = spread(payloads.select(*keys, label, text.text), *keys)
    return stage(text.score(spread_out).select(*keys, label, "text_proba"), "pool-scores")


def joint_scores(
    flows: DataFrame,
    keys: Sequence[str],
    pool: DataFrame,
    text_keys: Sequence[str],
    text_label: str,
    models: TabularModels,
    seed: int = 42,
    p_attack: float = 0.7,
    p_benign: float = 0.03,
) -> DataFrame:
    """The three scores of every flow, each paired with a scored payload that fits its label."""
    scored = models.classifier.score(models.forest.score(flows)).select(
        *keys, IS_ATTACK, "anomaly_score", "attack_proba", "predicted_class"
    )
    return pair_payloads(scored, keys, IS_ATTACK, pool, text_keys, text_label, p_attack, p_benign, seed)


def train_fusion(train: DataFrame) -> FusionWeights:
    return fit_fusion(train, IS_ATTACK)


def fusion_bakeoff(weights: FusionWeights, test: DataFrame) -> DataFrame:
    """The fused model against plain min-max averaging."""
    scored = minmax_average(test.withColumn("fused", fusion_proba(weights)), SCORES, "average")
    long = long_scores(scored, IS_ATTACK, {"fusion": ("fused", 0.5), "averaging": ("average", 0.5)})
    return bakeoff(long, "model", "y", "score", "flag", "fusion", "averaging")
