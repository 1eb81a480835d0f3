"""Scoring of events with all fitted models; one function for batch and stream."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.models.classifier import AttackClassifier
from flowsift.models.forest import IsolationForest
from flowsift.models.fusion import weights_from_table, weights_table
from flowsift.models.textmodels import TextSequence
from flowsift.operators.decide import FusionWeights, RouteSettings, explained, fill_modalities, route
from flowsift.operators.fitting import Preprocessor
from flowsift.schema import PAYLOAD, quoted
from flowsift.sources.tables import load_params, save_params, write_table

RESULT_COLUMNS = (
    "threat_probability",
    "is_threat",
    "confidence",
    "predicted_class",
    "decision_source",
    "component_scores",
    "explanation",
)


def score_components(
    df: DataFrame, pre: Preprocessor, forest: IsolationForest, classifier: AttackClassifier, text: TextSequence
) -> DataFrame:
    """Append anomaly_score, attack_proba, predicted_class and text_proba by row-local transforms.

    ``df`` holds the scaled features of ``pre`` and a payload column.
    """
    scored = classifier.score(forest.score(df)).drop("probabilities")
    return text.score(scored)


@dataclass(frozen=True)
class ScoringBundle:
    """Everything needed to turn an event into a decision."""

    pre: Preprocessor
    forest: IsolationForest
    classifier: AttackClassifier
    text: TextSequence
    fusion: FusionWeights
    settings: RouteSettings = field(default_factory=RouteSettings)

    def score(self, events: DataFrame) -> DataFrame:
        """Append the result columns to events with ``features`` (map) and ``payload``.

        Serving never drops a row. An empty feature map counts as absent, an empty payload as
        present. No step looks beyond its row, so the same call serves streams.
        """
        keep = events.columns
        names = list(self.pre.features)
        has_features = F.coalesce(F.size("features") > 0, F.lit(False))
        has_payload = F.col(PAYLOAD).isNotNull()
        opened = events.select(
            *[F.col(quoted(c)) for c in keep], *[F.col("features")[c].alias(c) for c in names]
        )
        scaled = self.pre.transform(opened, keep)
        scored = score_components(scaled, self.pre, self.forest, self.classifier, self.text)
        settings = RouteSettings(
            self.settings.decision_threshold,
            self.text.threshold,
            self.settings.missing_text_score,
            self.settings.top_k,
        )
        routed = route(
            fill_modalities(scored, has_features, has_payload, settings),
            has_features,
            has_payload,
            self.fusion,
            settings,
        )
        vector = [F.col(quoted(c)).cast("double") for c in names]
        shaped = explained(
            routed, has_features, vector, names, self.classifier.importances(), PAYLOAD, settings
        )
        return shaped.select(*[F.col(quoted(c)) for c in keep], *RESULT_COLUMNS)

    def save(self, spark: SparkSession, path: str) -> str:
        save_params(self.pre, spark, f"{path}/params")
        write_table(self.forest.to_table(spark), f"{path}/forest")
        self.classifier.save(spark, f"{path}/classifier")
        self.text.save(spark, f"{path}/text")
        write_table(weights_table(self.fusion, spark), f"{path}/fusion")
        return path

    @classmethod
    def load(
        cls, spark: SparkSession, path: str, settings: RouteSettings = RouteSettings()
    ) -> ScoringBundle:
        return cls(
            load_params(spark, f"{path}/params"),
            IsolationForest.from_table(spark.read.parquet(f"{path}/forest")),
            AttackClassifier.load(spark, f"{path}/classifier"),
            TextSequence.load(spark, f"{path}/text"),
            weights_from_table(spark.read.parquet(f"{path}/fusion")),
            settings,
        )
