"""Stacked model over the three component scores."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.operators.decide import FusionWeights, fused_probability
from flowsift.operators.fitting import apply_scaler, fit_scaler

# Component order.
SCORES = ("anomaly_score", "attack_proba", "text_proba")


def fit_fusion(df: DataFrame, target: str, iterations: int = 100) -> FusionWeights:
    """Standardise the scores, then logistic regression with unit ridge penalty."""
    data = df.select(*SCORES, F.col(target).cast("double").alias("__y"))
    scaler = fit_scaler(data, SCORES, "standard")
    scaled = VectorAssembler(inputCols=list(SCORES), outputCol="__x").transform(apply_scaler(data, scaler))
    scaled = scaled.select("__x", "__y").persist()
    try:
        model = LogisticRegression(
            featuresCol="__x",
            labelCol="__y",
            maxIter=iterations,
            regParam=1.0 / max(scaled.count(), 1),
            standardization=False,
        ).fit(scaled)
    finally:
        scaled.unpersist()
    return FusionWeights(
        tuple(scaler[s][0] for s in SCORES),
        tuple(scaler[s][1] for s in SCORES),
        tuple(float(w) for w in model.coefficients.toArray()),
        float(model.intercept),
    )


def fusion_proba(weights: FusionWeights) -> Column:
    return fused_probability(weights, [F.col(s) for s in SCORES])


def weights_table(weights: FusionWeights, spark: SparkSession) -> DataFrame:
    rows = [
        (i, s, weights.centers[i], weights.scales[i], weights.weights[i], weights.intercept)
        for i, s in enumerate(SCORES)
    ]
    return spark.createDataFrame(
        rows, "position int, score string, center double, scale double, weight double, intercept double"
    )


def weights_from_table(table: DataFrame) -> FusionWeights:
    rows = table.orderBy("position").collect()
    return FusionWeights(
        tuple(r["center"] for r in rows),
        tuple(r["scale"] for r in rows),
        tuple(r["weight"] for r in rows),
        rows[0]["intercept"],
    )
