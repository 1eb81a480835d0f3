"""Decision routing and explanation of scored events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.functions.numeric import confidence, logistic
from flowsift.functions.text import signatures

UNKNOWN_CLASS = "UNKNOWN"


@dataclass(frozen=True)
class FusionWeights:
    """Standardisation and logistic coefficients of the three component scores."""

    centers: tuple[float, float, float]
    scales: tuple[float, float, float]
    weights: tuple[float, float, float]
    intercept: float


@dataclass(frozen=True)
class RouteSettings:
    """Default decision threshold, text prior and number of explanations."""

    decision_threshold: float = 0.5
    text_threshold: float = 0.5
    missing_text_score: float = 0.5
    top_k: int = 5


def fused_probability(weights: FusionWeights, scores: Sequence[Column]) -> Column:
    """Closed form of the fused model, so it stays a code-generated expression."""
    z = F.lit(weights.intercept)
    for c, center, scale, w in zip(scores, weights.centers, weights.scales, weights.weights, strict=True):
        z = z + (c - F.lit(center)) / F.lit(scale) * F.lit(w)
    return logistic(z)


def fill_modalities(
    df: DataFrame,
    has_features: Column,
    has_payload: Column,
    settings: RouteSettings = RouteSettings(),
) -> DataFrame:
    """Defaults for an absent modality: scores 0 and class UNKNOWN, or the neutral text prior."""
    return df.withColumns(
        {
            "anomaly_score": F.when(has_features, F.col("anomaly_score")).otherwise(F.lit(0.0)),
            "attack_proba": F.when(has_features, F.col("attack_proba")).otherwise(F.lit(0.0)),
            "predicted_class": F.when(has_features, F.col("predicted_class")).otherwise(F.lit(UNKNOWN_CLASS)),
            "text_proba": F.when(has_payload, F.col("text_proba")).otherwise(
                F.lit(settings.missing_text_score)
            ),
        }
    )


def route(
    df: DataFrame,
    has_features: Column,
    has_payload: Column,
    weights: FusionWeights,
    settings: RouteSettings = RouteSettings(),
) -> DataFrame:
    """Append threat_proba, decision_source, is_threat and confidence.

    A payload alone is decided by the text score and its own threshold; everything else by the
    fused probability. The flag compares the unrounded probability.
    """
    text_only = has_payload & ~has_features
    fused = fused_probability(
        weights, [F.col("anomaly_score"), F.col("attack_proba"), F.col("text_proba")]
    )
    source = (
        F.when(text_only, "text-only").when(has_payload & has_features, "fusion").otherwise("tabular-only")
    )
    limit = F.when(text_only, F.lit(settings.text_threshold)).otherwise(F.lit(settings.decision_threshold))
    return (
        df.withColumn("threat_proba", F.when(text_only, F.col("text_proba")).otherwise(fused))
        .withColumn("decision_source", source)
        .withColumn("is_threat", F.col("threat_proba") >= limit)
        .withColumn("confidence", confidence(F.col("threat_proba")))
    )


def top_features(
    values: Sequence[Column], names: Sequence[str], importances: Mapping[str, float], k: int
) -> Column:
    """The k largest importance * |value| as structs (feature, scaled_value, importance).

    Row-local: one sort of a feature-length array. Ties go to the later feature.
    """
    entries = []
    for i, (value, name) in enumerate(zip(values, names, strict=True)):
        weight = float(importances.get(name, 0.0))
        entries.append(
            F.struct(
                (F.abs(value) * F.lit(weight)).alias("contribution"),
                F.lit(i).alias("position"),
                F.struct(
                    F.lit(name).alias("feature"),
                    F.round(value, 4).alias("scaled_value"),
                    F.lit(round(weight, 4)).alias("importance"),
                ).alias("shown"),
            )
        )
    ranked = F.slice(F.sort_array(F.array(*entries), asc=False), 1, k)
    return ranked["shown"]


def explained(
    df: DataFrame,
    has_features: Column,
    scaled: Sequence[Column],
    names: Sequence[str],
    importances: Mapping[str, float],
    payload: str = "payload",
    settings: RouteSettings = RouteSettings(),
) -> DataFrame:
    """Shape routed rows into the nested result: rounded scores, component map and explanation."""
    top = top_features(scaled, names, importances, settings.top_k)
    nothing = F.filter(top, lambda _: F.lit(False))
    return df.withColumns(
        {
            "threat_probability": F.round("threat_proba", 6),
            "confidence": F.round("confidence", 6),
            "component_scores": F.create_map(
                *[
                    v
                    for name in ("anomaly_score", "attack_proba", "text_proba")
                    for v in (F.lit(name), F.round(F.col(name), 6))
                ]
            ),
            "explanation": F.struct(
                F.when(has_features, top).otherwise(nothing).alias("top_features"),
                signatures(F.col(payload)).alias("triggering_indicators"),
            ),
        }
    )
