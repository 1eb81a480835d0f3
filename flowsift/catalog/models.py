"""Model fitting and scoring."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.catalog import query
from flowsift.catalog.sql import commas, draw_key, index_draw, unit_draw, with_views
from flowsift.functions.labels import attack_score, predicted_class
from flowsift.models import forest as forests
from flowsift.models.classifier import AttackClassifier, TreeSettings
from flowsift.models.fusion import fusion_proba
from flowsift.models.textmodels import TextBaseline, TextSequence
from flowsift.operators.clean import inf_to_null
from flowsift.operators.evaluate import threshold_at_recall
from flowsift.operators.fitting import Preprocessor, apply_imputer, contamination
from flowsift.operators.joins import spread
from flowsift.operators.neighbours import neighbour_graph, ranked_neighbours
from flowsift.operators.sampling import kfold
from flowsift.operators.smote import smote
from flowsift.plans import train
from flowsift.plans.leakage import compare_leakage
from flowsift.plans.preprocess import preprocess_flows, preprocess_payloads
from flowsift.plans.score import ScoringBundle
from flowsift.schema import IS_ATTACK
from flowsift.session import scratch_dir, stage
from flowsift.sources import views
from flowsift.sources.views import FLOW_COLS, FLOW_KEYS

SEED = 42
# Default settings: the trees are fitted on all training rows and stopped on all validation rows.
TREES = TreeSettings()
FOREST_TREES = 200


@dataclass(frozen=True)
class Fitted:
    """Models of one scale factor, each trained when first asked for."""

    spark: SparkSession
    sf: str

    @cached_property
    def _processed(self) -> tuple[DataFrame, Preprocessor]:
        flows, pre = preprocess_flows(
            views.labelled_flows(self.spark, self.sf).drop(IS_ATTACK), FLOW_COLS, FLOW_KEYS, "label"
        )
        return stage(flows, "processed", partition_by="split"), pre

    @property
    def flows(self) -> DataFrame:
        return self._processed[0]

    @property
    def pre(self) -> Preprocessor:
        return self._processed[1]

    @cached_property
    def forest(self) -> forests.IsolationForest:
        return train.train_forest(self.flows, FLOW_COLS, FLOW_KEYS, FOREST_TREES, seed=SEED)

    @cached_property
    def classifier(self) -> AttackClassifier:
        return train.train_classifier(self.flows, FLOW_COLS, "label", TREES, "boosted", seed=SEED)

    @property
    def tabular(self) -> train.TabularModels:
        return train.TabularModels(self.forest, self.classifier)

    @cached_property
    def payloads(self) -> DataFrame:
        return preprocess_payloads(views.payloads(self.spark, self.sf), ["doc_id"], "payload", "label")[0]

    @cached_property
    def sequence(self) -> TextSequence:
        return train.train_sequence(self.payloads, "payload", "label")

    @cached_property
    def baseline(self) -> TextBaseline:
        return train.train_baseline(self.payloads, "payload", "label")

    @property
    def texts(self) -> tuple[TextSequence, TextBaseline]:
        return self.sequence, self.baseline

    @cached_property
    def joint(self) -> DataFrame:
        pool = train.pool_scores(train.part(self.payloads, "train"), ["doc_id"], "label", self.sequence)
        joint = train.joint_scores(self.flows, [*FLOW_KEYS, "split"], pool, ["doc_id"], "label", self.tabular, SEED)
        return stage(joint, "joint", partition_by="split")

    @cached_property
    def fusion(self):
        return train.train_fusion(train.part(self.joint, "train"))

    @cached_property
    def bundle(self) -> ScoringBundle:
        return ScoringBundle(self.pre, self.forest, self.classifier, self.sequence, self.fusion)


_fitted: dict[tuple[str, str], Fitted] = {}


def fitted(spark: SparkSession, sf: str) -> Fitted:
    """Models are trained once per session and scale factor; the queries share them."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _fitted:
        _fitted[key] = Fitted(spark, sf)
    return _fitted[key]


@query("anomaly_fit")
def anomaly_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Node counts and depths per tree."""
    m = fitted(spark, sf)
    forest = forests.IsolationForest.fit(
        train.part(m.flows, "train"), FLOW_COLS, FLOW_KEYS, FOREST_TREES, seed=SEED
    )
    return forest.to_table(spark).groupBy("tree").agg(
        F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("feature") < 0).alias("leaves")
    )


@query("anomaly_score")
def anomaly_score(spark: SparkSession, sf: str) -> DataFrame:
    m = fitted(spark, sf)
    scored = m.forest.score(m.flows)
    return scored.select(*FLOW_KEYS, "split", "label", F.round("anomaly_score", 6).alias("anomaly_score"))


_offset_sql = """SELECT round(lo + (pos - floor(pos)) * (hi - lo), 9) AS cut FROM (
                   SELECT pos, max(score) FILTER (rk = floor(pos) + 1) AS lo, max(score) FILTER (rk = ceil(pos) + 1) AS hi
                   FROM (SELECT score, row_number() OVER (ORDER BY score) AS rk FROM scored),
                        (SELECT (1 - least(greatest(avg(y), 0.001::DOUBLE), 0.5::DOUBLE)) * (count(*) - 1) AS pos FROM scored)
                   GROUP BY pos)"""


def event_offset(spark: SparkSession, sf: str) -> float:
    scored = views.scored(spark, sf)
    share = contamination(scored, "y").first()["contamination"]
    return round(forests.anomaly_offset(scored, "score", share), 9)


@query("anomaly_offset", with_views(_offset_sql, "scored"))
def anomaly_offset(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(event_offset(spark, sf),)], "cut double")


@query(
    "anomaly_flag",
    with_views(
        "SELECT event_id, CAST(score >= (SELECT cut FROM o) AS INTEGER) AS flag FROM scored", "scored", o=_offset_sql
    ),
)
def anomaly_flag(spark: SparkSession, sf: str) -> DataFrame:
    flag = forests.anomaly_flag(F.col("score"), event_offset(spark, sf))
    return views.scored(spark, sf).select("event_id", flag.alias("flag"))


@query("classifier_fit")
def classifier_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out recall per class of the boosted model, stopped on validation rows."""
    m = fitted(spark, sf)
    scored = m.classifier.score(train.part(m.flows, "test"))
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg((F.col("label") == F.col("predicted_class")).cast("double")), 6).alias("recall"),
    )


@query("classifier_proba")
def classifier_proba(spark: SparkSession, sf: str) -> DataFrame:
    m = fitted(spark, sf)
    scored = m.classifier.proba(m.flows)
    return scored.select(
        *FLOW_KEYS, F.posexplode("probabilities").alias("position", "p")
    ).select(*FLOW_KEYS, "position", F.round("p", 6).alias("probability"))


# Eight given "probabilities" per flow: its non-negative features, scaled to sum 1.
EIGHT = ["port", "duration", "bytes", "discount", "tax", "total_price", "supplier", "line_no"]
_sum = " + ".join(EIGHT)
_given = {"given": f"SELECT {commas(FLOW_KEYS)}, [x / ({_sum}) for x in [{commas(EIGHT)}]] AS p FROM flows"}


def given_probabilities(spark: SparkSession, sf: str) -> DataFrame:
    total = sum((F.col(c) for c in EIGHT[1:]), F.col(EIGHT[0]))
    return views.flows(spark, sf).select(*FLOW_KEYS, F.array(*[F.col(c) / total for c in EIGHT]).alias("p"))


@query(
    "classifier_predict",
    with_views(
        f"SELECT {commas(FLOW_KEYS)}, CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS class_id FROM given",
        "flows",
        **_given,
    ),
)
def classifier_predict(spark: SparkSession, sf: str) -> DataFrame:
    return given_probabilities(spark, sf).select(*FLOW_KEYS, predicted_class(F.col("p")).alias("class_id"))


@query(
    "attack_proba",
    with_views(
        f"SELECT {commas(FLOW_KEYS)}, round(1 - p[1], 9) AS attack_proba, 1::DOUBLE AS without_benign FROM given",
        "flows",
        **_given,
    ),
)
def attack_proba(spark: SparkSession, sf: str) -> DataFrame:
    return given_probabilities(spark, sf).select(
        *FLOW_KEYS,
        F.round(attack_score(F.col("p")), 9).alias("attack_proba"),
        attack_score(F.col("p"), [1, 2, 3, 4, 5, 6, 7]).alias("without_benign"),
    )


@query("feature_importance")
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    pairs = fitted(spark, sf).classifier.importances()
    return spark.createDataFrame(list(pairs.items()), "feature string, importance double")


@query("text_baseline")
def text_baseline(spark: SparkSession, sf: str) -> DataFrame:
    m = fitted(spark, sf)
    scored = m.baseline.score(m.payloads)
    return scored.select("doc_id", "label", F.round("baseline_proba", 6).alias("baseline_proba"))


@query("text_sequence")
def text_sequence(spark: SparkSession, sf: str) -> DataFrame:
    m = fitted(spark, sf)
    scored = m.sequence.score(m.payloads)
    return scored.select("doc_id", "label", F.round("text_proba", 6).alias("text_proba"))


@query("text_threshold")
def text_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Operating point of the text model on its validation rows."""
    m = fitted(spark, sf)
    scored = m.sequence.score(train.part(m.payloads, "val"))
    return threshold_at_recall(stage(scored.select("label", "text_proba"), "val-scores"), "label", "text_proba", 0.8)


@query("score_matrix")
def score_matrix(spark: SparkSession, sf: str) -> DataFrame:
    joint = fitted(spark, sf).joint
    return joint.select(
        *FLOW_KEYS, "split", *[F.round(c, 6).alias(c) for c in ("anomaly_score", "attack_proba", "text_proba")]
    )


@query("fusion_fit")
def fusion_fit(spark: SparkSession, sf: str) -> DataFrame:
    m = fitted(spark, sf)
    scored = m.joint.select(*FLOW_KEYS, IS_ATTACK, fusion_proba(m.fusion).alias("p"))
    return scored.withColumn("p", F.round("p", 6))


@query("fusion_bakeoff")
def fusion_bakeoff(spark: SparkSession, sf: str) -> DataFrame:
    m = fitted(spark, sf)
    return train.fusion_bakeoff(m.fusion, train.part(m.joint, "test"))


@query("text_bakeoff")
def text_bakeoff(spark: SparkSession, sf: str) -> DataFrame:
    m = fitted(spark, sf)
    return train.text_bakeoff(m.sequence, m.baseline, train.part(m.payloads, "test"), "label")


@query("gate_recheck")
def gate_recheck(spark: SparkSession, sf: str) -> DataFrame:
    """The gate over models loaded from the store they were written to."""
    m = fitted(spark, sf)
    stored = m.tabular.save(spark, scratch_dir(spark, "tabular-models"))
    decided = train.gate_check(train.TabularModels.load(spark, stored), train.part(m.flows, "test"), "label")
    return decided.select("run_id", "passed", F.array_join("reasons", "; ").alias("reasons"))


@query("score_batch")
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    # scoring costs far more than reading, so rows are dealt to all tasks however few the files are
    events = spread(views.events_in(spark, sf).drop("ts"), "event_id")
    return flat_result(fitted(spark, sf).bundle.score(events))


def flat_result(scored: DataFrame) -> DataFrame:
    return scored.select(
        "event_id",
        "threat_probability",
        "is_threat",
        "confidence",
        "predicted_class",
        "decision_source",
        *[F.col("component_scores")[s].alias(s) for s in ("anomaly_score", "attack_proba", "text_proba")],
        F.array_join("explanation.top_features.feature", ",").alias("top_features"),
        F.array_join("explanation.triggering_indicators", ",").alias("indicators"),
    )


_minority = {
    "pos": f"SELECT vec_id, v, row_number() OVER (ORDER BY {draw_key(['vec_id'], SEED)}) AS number FROM vectors WHERE y = 1",
    "sizes": """SELECT (SELECT count(*) FROM pos) AS p, greatest((SELECT count(*) FROM vectors) - 2 * (SELECT count(*) FROM pos), 0) AS missing,
                       greatest(1, least(5, (SELECT count(*) FROM pos) - 1)) AS k""",
    "near": """SELECT base, neighbour, rk, w FROM (
                 SELECT base, neighbour, w, row_number() OVER (PARTITION BY base ORDER BY d, neighbour) AS rk FROM (
                   SELECT a.vec_id AS base, b.vec_id AS neighbour, b.v AS w, round(list_distance(a.v, b.v), 9) AS d
                   FROM pos AS a JOIN pos AS b ON a.vec_id <> b.vec_id)) WHERE rk <= (SELECT k FROM sizes)""",
    "drawn": f"""SELECT i AS synthetic_id, {index_draw(['i'], 'SELECT p FROM sizes', SEED, 'base')} + 1 AS number,
                        {index_draw(['i'], 'SELECT k FROM sizes', SEED, 'neighbour')} + 1 AS rk,
                        {unit_draw(['i'], SEED, 'gap')} AS gap
                 FROM range((SELECT missing FROM sizes)) AS r(i)""",
}


@query(
    "smote_oversample",
    with_views(
        """SELECT synthetic_id, base, neighbour, round(gap, 9) AS gap,
                  round(list_sum([z[1] + gap * (z[2] - z[1]) for z in list_zip(v, w)]), 6) AS total
           FROM drawn JOIN (SELECT vec_id AS base, v, number FROM pos) USING (number) JOIN near USING (base, rk)""",
        "vectors",
        **_minority,
    ),
)
def smote_oversample(spark: SparkSession, sf: str) -> DataFrame:
    made = smote(views.vectors(spark, sf), "vec_id", "v", "y", SEED)
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return made.select(
        "synthetic_id", "base", "neighbour", F.round("gap", 9).alias("gap"), F.round(total, 6).alias("total")
    )


@query(
    "fold_neighbours",
    with_views(
        """SELECT fold, vec_id, neighbour, rank FROM (
             SELECT f.fold, a.vec_id, b.vec_id AS neighbour,
                    (row_number() OVER (PARTITION BY f.fold, a.vec_id ORDER BY round(list_distance(a.v, b.v), 9), b.vec_id))::INT AS rank
             FROM folded a JOIN folded b ON a.vec_id <> b.vec_id JOIN (SELECT DISTINCT fold FROM folded) f ON a.fold <> f.fold AND b.fold <> f.fold
           ) WHERE rank <= 5""",
        "vectors",
        folded=f"""SELECT vec_id, v, ((row_number() OVER (ORDER BY {draw_key(['vec_id'], SEED)}) - 1) % 5)::INT AS fold
                   FROM vectors WHERE y = 1""",
    ),
)
def fold_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest positive rows of every training set of a cross-validation, read from one graph."""
    points = kfold(views.vectors(spark, sf).where("y = 1"), "y", ["vec_id"], 5, SEED)
    graph = stage(neighbour_graph(points, "vec_id", "v", 5, "fold", 5), "fold-neighbours")
    outside = [ranked_neighbours(graph, "vec_id", 5, i).withColumn("fold", F.lit(i)) for i in range(5)]
    return reduce(DataFrame.unionByName, outside).select("fold", "vec_id", "neighbour", "rank")


@query("leakage_compare")
def leakage_compare(spark: SparkSession, sf: str) -> DataFrame:
    return compare_leakage(views.vectors(spark, sf), "vec_id", "v", "y", k=5, seed=SEED)


@query("serve_transform")
def serve_transform(spark: SparkSession, sf: str) -> DataFrame:
    """Raw flows through the stored training parameters: no row lost, every cell finite."""
    pre = fitted(spark, sf).pre
    raw = apply_imputer(inf_to_null(views.flows(spark, sf), ["tax"]), {"tax": 0.0})
    out = pre.transform(raw.drop("line_no"), FLOW_KEYS)
    return out.select(*FLOW_KEYS, *[F.round(F.col(c).cast("double"), 4).alias(c) for c in FLOW_COLS])
