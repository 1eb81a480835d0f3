"""Eight-class attack classifier on MLlib trees."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.labels import attack_score, label_id, label_name, predicted_class
from flowsift.models.boosting import as_models, boost
from flowsift.models.ensemble import Ensemble, probabilities
from flowsift.models.persist import reloaded
from flowsift.operators.fitting import class_weights
from flowsift.operators.samples import stratified_sample
from flowsift.schema import quoted
from flowsift.session import scratch_dir


@dataclass(frozen=True)
class TreeSettings:
    """Defaults of the boosted trees.

    ``max_rows`` bounds the labelled rows of a fit, training and validation each, to a sample in
    proportion to the classes; a class keeps ``class_floor`` rows at least, if it has them. None takes
    all rows.
    """

    max_depth: int = 6
    learning_rate: float = 0.1
    rounds: int = 200
    subsample: float = 0.8
    column_share: float = 0.8
    min_weight: int = 1
    trees: int = 60
    bins: int = 256
    max_rows: int | None = None
    class_floor: int = 200


def _weighted(rows: DataFrame, label: str, settings: TreeSettings, seed: int, balance: bool) -> DataFrame:
    """Rows, or a sample of them, with weights that sum to those of all rows in every class."""
    if settings.max_rows is None:
        return class_weights(rows, label) if balance else rows.withColumn("weight", F.lit(1.0))
    sample, counts = stratified_sample(rows, label, settings.max_rows, settings.class_floor, seed, "weight")
    if not balance:
        return sample
    total, classes = sum(counts.values()), len(counts)
    share = F.lit(None).cast("double")
    for c, n in counts.items():
        share = F.when(F.col(quoted(label)).eqNullSafe(F.lit(c)), F.lit(total / (classes * n))).otherwise(share)
    return sample.withColumn("weight", F.col("weight") * share)


@dataclass(frozen=True)
class AttackClassifier:
    """One boosted model per class (normalised one-vs-rest), or one multi-class forest.

    ``classes`` are the class ids present in training, in the order of the probability array.
    """

    features: tuple[str, ...]
    classes: tuple[int, ...]
    models: tuple
    kind: str

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        val: DataFrame | None,
        features: Sequence[str],
        label: str,
        settings: TreeSettings = TreeSettings(),
        kind: str = "boosted",
        seed: int = 0,
    ) -> AttackClassifier:
        """Rows are weighted by class balance; validation rows stop the boosting early."""
        data = _weighted(train.select(*features, label), label, settings, seed, balance=True).withColumn("__val", F.lit(False))
        if val is not None:
            held = _weighted(val.select(*features, label), label, settings, seed, balance=False)
            data = data.unionByName(held.withColumn("__val", F.lit(True)))
        data = data.withColumn("__y", label_id(F.col(label)).cast("double"))
        present = data.where(~F.col("__val")).select("__y").distinct().orderBy("__y").collect()
        classes = tuple(int(r["__y"]) for r in present)
        if kind == "forest":
            rf = RandomForestClassifier(
                featuresCol="__x",
                labelCol="__y",
                weightCol="weight",
                numTrees=settings.trees,
                maxDepth=settings.max_depth,
                maxBins=settings.bins,
                subsamplingRate=settings.subsample,
                seed=seed,
            )
            vectors = VectorAssembler(inputCols=list(features), outputCol="__x").transform(data.where(~F.col("__val")))
            models = (reloaded(rf.fit(vectors.select("__x", "__y", "weight")), train.sparkSession),)
        elif kind == "boosted":
            cuts, trees = boost(data, features, classes, settings, seed)
            estimator = GBTClassifier(
                featuresCol="__x",
                labelCol="__is",
                weightCol="weight",
                maxIter=settings.rounds,
                maxDepth=settings.max_depth,
                maxBins=settings.bins,
                stepSize=settings.learning_rate,
                subsamplingRate=settings.subsample,
                featureSubsetStrategy=str(settings.column_share),
                minInstancesPerNode=settings.min_weight,
                seed=seed,
            )
            models = as_models(train.sparkSession, cuts, trees, estimator)
        else:
            raise ValueError(f"unknown classifier kind: {kind}")
        return cls(tuple(features), classes, models, kind)

    def proba(self, df: DataFrame, out: str = "probabilities") -> DataFrame:
        """Append the class probabilities, one per entry of ``classes``."""
        keep = df.columns
        if self.kind == "forest":
            scored = VectorAssembler(inputCols=list(self.features), outputCol="__x", handleInvalid="keep").transform(df)
            scored = self.models[0].transform(scored)
            array = vector_to_array(self.models[0].getProbabilityCol())
            return scored.select(*keep, F.array(*[array[c] for c in self.classes]).alias(out))
        cells = F.struct(*[F.col(quoted(c)).cast("double").alias(f"x{i}") for i, c in enumerate(self.features)])
        scored = df.withColumn("__p", probabilities(self._ensemble, df.sparkSession)(cells))
        parts = [F.col("__p")[f"p{i}"] for i in range(len(self.classes))]
        total = sum(parts[1:], parts[0])
        return scored.select(*keep, F.array(*[p / total for p in parts]).alias(out))

    @cached_property
    def _ensemble(self) -> Ensemble:
        """The boosted trees as tables that score a batch of rows at once, read from the stored models."""
        spark = SparkSession.active()
        path = scratch_dir(spark, "boosted")

        def save(i: int) -> str:
            self.models[i].write().save(f"{path}/{i}")
            return f"{path}/{i}"

        with ThreadPool(min(8, len(self.models))) as pool:
            folders = pool.map(inheritable_thread_target(spark)(save), range(len(self.models)))
        return Ensemble.read(spark, folders, [m.treeWeights for m in self.models], len(self.features))

    def score(self, df: DataFrame) -> DataFrame:
        """Append probabilities, attack_proba and the predicted class name."""
        p = F.col("probabilities")
        return (
            self.proba(df)
            .withColumn("attack_proba", attack_score(p, list(self.classes)))
            .withColumn("predicted_class", label_name(predicted_class(p, list(self.classes))))
        )

    def importances(self) -> dict[str, float]:
        """Global importance per feature, averaged over the models."""
        mean = np.mean([m.featureImportances.toArray() for m in self.models], axis=0)
        return dict(zip(self.features, (float(v) for v in mean), strict=True))

    def save(self, spark: SparkSession, path: str) -> str:
        for c, model in zip(self.classes if self.kind == "boosted" else (0,), self.models, strict=True):
            model.write().overwrite().save(f"{path}/class-{c}")
        meta = [(list(self.features), list(self.classes), self.kind)]
        spark.createDataFrame(meta, "features array<string>, classes array<int>, kind string").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/meta")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> AttackClassifier:
        meta = spark.read.parquet(f"{path}/meta").first()
        kind = meta["kind"]
        reader = GBTClassificationModel if kind == "boosted" else RandomForestClassificationModel
        ids = meta["classes"] if kind == "boosted" else [0]
        models = tuple(reader.load(f"{path}/class-{c}") for c in ids)
        return cls(tuple(meta["features"]), tuple(meta["classes"]), models, kind)
