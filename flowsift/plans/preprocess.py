"""Leak-free preprocessing: clean, split, fit on training rows, transform every split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.functions.labels import binary_target
from flowsift.functions.numeric import is_nonfinite
from flowsift.operators.clean import clean_flows
from flowsift.operators.fitting import Preprocessor
from flowsift.operators.sampling import stratified_split
from flowsift.operators.vocab import build_vocabulary
from flowsift.schema import IS_ATTACK, quoted
from flowsift.session import stage


@dataclass(frozen=True)
class SplitSettings:
    """Default shares and seed."""

    test: float = 0.20
    val: float = 0.10
    stratify: bool = True
    seed: int = 42


def split_flows(
    raw: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    label: str,
    settings: SplitSettings = SplitSettings(),
    drop_duplicates: bool = True,
) -> DataFrame:
    """Cleaned flows with their split, staged because the fits and the transform all read them.

    Duplicates go before the split, so equal rows cannot stand on both sides of it.
    """
    clean = stage(clean_flows(raw, features, drop_duplicates, training=True), "clean")
    strata = [label] if settings.stratify else None
    parts = stratified_split(clean, strata, keys, settings.test, settings.val, settings.seed)
    return stage(parts, "split", partition_by="split")


def preprocess_flows(
    raw: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    label: str,
    settings: SplitSettings = SplitSettings(),
    strategy: str = "median",
    scaler: str = "standard",
    as_float: bool = True,
) -> tuple[DataFrame, Preprocessor]:
    """Scaled features with keys, label, binary target and split; and the fitted parameters."""
    parts = split_flows(raw, features, keys, label, settings)
    pre = Preprocessor(tuple(features), strategy, scaler).fit(parts.where(F.col("split") == "train"))
    out = pre.transform(parts, [*keys, label, "split"], as_float)
    return out.withColumn(IS_ATTACK, binary_target(F.col(quoted(label)))), pre


def write_processed(df: DataFrame, path: str, features: Sequence[str]) -> str:
    """Write one dataset partitioned by split; raises if a feature cell is not finite."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    bad = [is_nonfinite(F.col(quoted(c))) for c in features]
    anywhere = bad[0]
    for b in bad[1:]:
        anywhere = anywhere | b
    wrong = df.sparkSession.read.parquet(path).where(anywhere).limit(1).count()
    if wrong:
        raise ValueError("transformed features hold NaN or infinite values")
    return path


def preprocess_payloads(
    raw: DataFrame,
    keys: Sequence[str],
    text: str,
    label: str,
    settings: SplitSettings = SplitSettings(),
    max_vocab: int = 5000,
    drop_duplicates: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Payloads with their split, and the vocabulary of the training split.

    Equal payloads may stand on both sides of the split unless ``drop_duplicates`` is set.
    """
    if drop_duplicates:
        raw = raw.dropDuplicates([text, label])
    strata = [label] if settings.stratify else None
    parts = stage(
        stratified_split(raw, strata, keys, settings.test, settings.val, settings.seed),
        "payloads",
        partition_by="split",
    )
    return parts, build_vocabulary(parts.where(F.col("split") == "train"), text, max_vocab=max_vocab)
