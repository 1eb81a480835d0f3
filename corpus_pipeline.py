"""Corpus preparation: stages over documents, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.llm.catalog import SURROGATE_KEY, mixing_quality
from flowsift.llm.decontaminate import find_contamination, hit_words, is_contaminated
from flowsift.llm.jaccard import one_per_group
from flowsift.llm.language import UNKNOWN, fit_languages, identify
from flowsift.llm.mixing import mix_sources
from flowsift.llm.pii import replace_entities
from flowsift.llm.words import spaced_count
from flowsift.session import stage as written

#: A document whose language is less certain than this goes.
LANGUAGE_SCORE = 0.5


def _packed(docs: DataFrame) -> DataFrame:
    """``text`` and all other columns as one, so that no operator meets a column named like its own."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("text", F.struct(F.lit(0).alias("__"), *others).alias("row"))


def _unpacked(packed: DataFrame, columns: list[str]) -> DataFrame:
    return packed.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones have, found with some certainty; all columns as they are.

    NULL and empty texts and those without a letter have no language and go, very long ones are read whole.
    Repeated rows are judged alike. Nothing comes of an empty table, and of one without a labelled row.
    """
    found = identify(_packed(docs), fit_languages(docs), keep=["text", "row"])
    return _unpacked(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE)), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of smallest id; all columns as they are.

    Texts without words, NULL ones too, are in no group and stay, but rows that repeat id and text become
    one. Very long texts are compared whole. A NULL id comes last. An empty table stays empty.
    """
    return one_per_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; all columns as they are.

    NULL and empty texts have no word that could be hit and stay, very long ones are searched whole.
    Repeated rows are judged alike. An empty table stays empty; an empty benchmark removes nothing.
    """
    found = find_contamination(_packed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _unpacked(found.where(~is_contaminated(hit_words(), F.col("n_words"))), docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data and secrets.

    ``n_chars`` follows the new text, all other columns are as they are. NULL and empty texts stay, very
    long ones are searched whole, repeated rows are replaced alike. An empty table stays empty.
    """
    replaced = _unpacked(replace_entities(_packed(docs), SURROGATE_KEY), docs.columns)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return replaced


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that each document gives to the mix of sources, with the columns that ``mix_sources`` names.

    NULL and empty texts have size 0 and give 0. Equal keys go by id, then size; rows that repeat an id are
    documents of their own. An empty table stays empty. The given columns go, but for id and source.
    """
    size = spaced_count(F.col("text"))
    return mix_sources(docs, size, mixing_quality(F.col("text"), size))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("private", private),
    ("mixed", mixed),
]

#: Fitted and keyed stages cannot be written in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = written(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
