"""Payload classifiers: n-gram baseline and sequence model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.models.persist import reloaded
from flowsift.models.sequence import SwitchingChain
from flowsift.operators.evaluate import threshold_at_recall
from flowsift.operators.fitting import class_weights
from flowsift.operators.grams import Vocabulary, count_grams, gram_counts, gram_text, gram_vectors, packed, unit_weights
from flowsift.session import stage
from flowsift.sources.tables import write_table

# Terms of the vocabulary at most, the most frequent first; the driver holds one weight for each.
TERMS = 1 << 24
# Penalty of the log odds' two weights, which labels that they part cleanly would leave without an end.
RIDGE = 1e-3


def _logistic(weight: str, iterations: int, ridge: float = 0.0) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="__v",
        labelCol="__y",
        weightCol=weight,
        maxIter=iterations,
        probabilityCol="__proba",
        regParam=ridge,
        standardization=not ridge,
    )


@dataclass(frozen=True)
class TextBaseline:
    """Character n-gram TF-IDF with class-balanced logistic regression and unit ridge penalty."""

    stages: PipelineModel
    text: str

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        text: str,
        label: str,
        min_df: int = 2,
        iterations: int = 100,
        terms: int = TERMS,
        tolerance: float = 1e-6,
    ) -> TextBaseline:
        """Every n-gram of at least ``min_df`` texts is a term with a weight of its own.

        Rows labelled neither 0 nor 1 are left out.
        """
        spark = train.sparkSession
        train = train.where(F.col(label).cast("double").isin(0.0, 1.0))
        data = class_weights(train.select(text, label), label).withColumn("__y", F.col(label).cast("double"))
        # written once: vocabulary, document frequencies and vectors read it
        data = stage(data.select(gram_counts(F.col(text)).alias("grams"), "__y", "weight"), "baseline-terms")
        whole = data.agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("weight")).head()
        counts = data.select(F.inline("grams")).groupBy("g").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("df"))
        kept = counts.where(F.col("df") >= min_df).orderBy(F.desc("n"), "g").limit(terms).toArrow()
        listed = spark.createDataFrame(pa.table({"g": kept["g"]})).select(F.array(gram_text(F.col("g"))).alias("__terms"))
        counted = CountVectorizer(inputCol="__terms", outputCol="__tf", vocabSize=terms).fit(listed)
        # the model has the terms in an order of its own
        grams, found = packed(counted.vocabulary), kept["g"].to_numpy()
        order = np.argsort(found)
        df = kept["df"].to_numpy()[order][np.searchsorted(found[order], grams)]
        smooth = np.log((whole["rows"] + 1.0) / (df + 1.0)) + 1.0
        weigh = ElementwiseProduct(inputCol="__tf", outputCol="__x", scalingVec=Vectors.dense(smooth))
        unit = Normalizer(inputCol="__x", outputCol="__v", p=2.0)
        vectors = stage(data.select(gram_vectors(spark, F.col("grams"), grams, smooth).alias("__v"), "__y", "weight"), "baseline-vectors", vectors=["__v"])
        model = _logistic("weight", iterations, 1.0 / (whole["weight"] or 1.0)).setTol(tolerance).fit(vectors)
        return cls(PipelineModel([counted, weigh, unit, reloaded(model, spark)]), text)

    @cached_property
    def _weights(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        counted, weigh, _, model = self.stages.stages
        idf, odds = weigh.getScalingVec().toArray(), model.coefficients.toArray()
        return packed(counted.vocabulary), idf, odds, model.intercept

    def score(self, df: DataFrame, out: str = "baseline_proba") -> DataFrame:
        """The probability of label 1 as ``stages`` have it, from grams counted by whole batches."""
        shared = df.sparkSession.sparkContext.broadcast(self._weights)

        @F.arrow_udf("double")
        def proba(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            terms, idf, odds, intercept = shared.value
            vocabulary = Vocabulary(terms)
            for batch in batches:
                margins = [np.zeros(0)]
                for texts, counts in count_grams(batch.to_pylist()):
                    owner, term, weight = unit_weights(vocabulary, idf, counts, texts)
                    margins.append(np.bincount(owner, weight * odds[term], texts))
                with np.errstate(over="ignore"):
                    yield pa.array(1.0 / (1.0 + np.exp(-(np.concatenate(margins) + intercept))))

        return df.select("*", proba(F.lower(F.coalesce(F.col(self.text), F.lit("")))).alias(out))


@dataclass(frozen=True)
class TextSequence:
    """Payload model over the order of characters: a switching Markov chain, its log odds as a probability."""

    chain: SwitchingChain
    model: LogisticRegressionModel
    text: str
    threshold: float = 0.5

    @staticmethod
    def _vectors(df: DataFrame, chain: SwitchingChain, text: str) -> DataFrame:
        return df.withColumn("__v", array_to_vector(chain.log_odds(df.sparkSession, F.col(text))))

    @classmethod
    def fit(
        cls, train: DataFrame, text: str, label: str, rounds: int = 3, iterations: int = 50, listed: int = 36
    ) -> TextSequence:
        """Positive rows weigh negatives / positives; rows labelled neither 0 nor 1 are left out."""
        y = F.col(label).cast("double")
        train = train.where(y.isin(0.0, 1.0))
        sizes = train.agg(F.count_if(y == 1).alias("p"), F.count_if(y == 0).alias("n")).first()
        weight = F.when(y == 1, F.lit(sizes["n"] / max(sizes["p"], 1))).otherwise(F.lit(1.0))
        chain = SwitchingChain.fit(train, text, label, listed, rounds)
        data = cls._vectors(train.select(text, y.alias("__y"), weight.alias("weight")), chain, text)
        data = stage(data.select("__v", "__y", "weight"), "sequence-odds")
        model = reloaded(_logistic("weight", iterations, RIDGE).setStandardization(True).fit(data), train.sparkSession)
        return cls(chain, model, text)

    def score(self, df: DataFrame, out: str = "text_proba") -> DataFrame:
        keep = df.columns
        scored = self.model.transform(self._vectors(df, self.chain, self.text))
        return scored.select(*keep, vector_to_array("__proba")[1].alias(out))

    def with_threshold(self, val: DataFrame, label: str, target_recall: float) -> TextSequence:
        """Operating threshold chosen on validation rows for the target recall."""
        scores = stage(self.score(val, "__s").select(label, "__s"), "sequence-scores")
        chosen = threshold_at_recall(scores, label, "__s", target_recall).first()
        return replace(self, threshold=float(chosen["threshold"]) if chosen else 0.5)

    def save(self, spark: SparkSession, path: str) -> str:
        write_table(self.chain.to_table(spark), f"{path}/chain")
        self.model.write().overwrite().save(f"{path}/odds")
        write_table(spark.createDataFrame([(self.text, self.threshold)], "text string, threshold double"), f"{path}/meta")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextSequence:
        meta = spark.read.parquet(f"{path}/meta").first()
        chain = SwitchingChain.from_table(spark.read.parquet(f"{path}/chain"))
        return cls(chain, LogisticRegressionModel.load(f"{path}/odds"), meta["text"], meta["threshold"])
