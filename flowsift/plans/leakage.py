"""How much oversampling before cross-validation flatters the score."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.models.persist import reloaded
from flowsift.operators.evaluate import average_precision
from flowsift.operators.neighbours import neighbour_graph
from flowsift.operators.sampling import kfold
from flowsift.operators.smote import MAX_NEIGHBOURS, smote
from flowsift.session import stage


def _balanced(
    df: DataFrame, key: str, vector: str, target: str, seed: int, graph: DataFrame, without: int | None = None
) -> DataFrame:
    """Rows and synthetic positives; synthetic rows get negative keys."""
    made = smote(df, key, vector, target, seed, graph=graph, without=without).select(
        (-F.col("synthetic_id") - 1).alias(key), F.col(vector), F.lit(1).alias(target)
    )
    return df.select(key, vector, F.col(target).cast("int").alias(target)).unionByName(made)


def _fold_scores(train: DataFrame, held: DataFrame, vector: str, target: str, iterations: int) -> DataFrame:
    data = train.select(array_to_vector(vector).alias("x"), F.col(target).cast("double").alias("y"))
    model = LogisticRegression(
        featuresCol="x",
        labelCol="y",
        maxIter=iterations,
        regParam=1.0 / max(data.count(), 1),
        standardization=False,
    ).fit(data)
    model = reloaded(model, train.sparkSession)
    scored = model.transform(held.withColumn("x", array_to_vector(vector)))
    return scored.select(F.col("fold"), F.col(target).alias("y"), vector_to_array("probability")[1].alias("score"))


def compare_leakage(
    df: DataFrame, key: str, vector: str, target: str, k: int = 5, seed: int = 42, iterations: int = 100
) -> DataFrame:
    """One row: mean average precision over folds, oversampled before folding and inside each fold.

    All oversampling reads one graph of the positive rows, whose neighbours reach far enough for every
    fold that is held out.
    """
    honest = stage(kfold(df.select(key, vector, target), target, [key], k, seed), "honest")
    graph = neighbour_graph(honest.where(F.col(target) == 1), key, vector, MAX_NEIGHBOURS, "fold", k)
    graph = stage(graph, "neighbours")
    balanced = _balanced(df, key, vector, target, seed, graph)
    whole = stage(kfold(balanced, target, [key], k, seed), "leaked")
    parts = []
    for fold in range(k):
        inside, outside = F.col("fold") == fold, F.col("fold") != fold
        leaked = _fold_scores(whole.where(outside), whole.where(inside), vector, target, iterations)
        train = stage(_balanced(honest.where(outside), key, vector, target, seed, graph, fold), "fold")
        fair = _fold_scores(train, honest.where(inside), vector, target, iterations)
        parts.append(leaked.withColumn("kind", F.lit("leaked")))
        parts.append(fair.withColumn("kind", F.lit("leak_free")))
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    per_fold = average_precision(scores, "y", "score", ["kind", "fold"])

    def mean(kind: str):
        return F.avg(F.when(F.col("kind") == kind, F.col("average_precision")))

    return per_fold.agg(
        mean("leaked").alias("leaked_pr_auc"), mean("leak_free").alias("leak_free_pr_auc")
    ).withColumn("gap", F.col("leaked_pr_auc") - F.col("leak_free_pr_auc"))
