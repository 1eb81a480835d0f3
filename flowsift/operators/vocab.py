"""Vocabulary, token encoding and TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.text import char_ngrams, tokens
from flowsift.operators.grams import LONGEST, gram_counts, gram_text, gram_weights
from flowsift.operators.joins import attach, spread
from flowsift.session import stage

# Special tokens and their ids.
PAD_ID = 0
UNKNOWN_ID = 1
SPECIALS = 2

# A literal map is searched linearly, so larger vocabularies are joined.
MAP_TOKENS = 256
# Terms that every task may hold with their weights.
LISTED = 1 << 22


def token_counts(df: DataFrame, text: str, level: str = "char", lowercase: bool = True) -> DataFrame:
    """(token, freq) over the corpus; counted inside each task before the shuffle."""
    return (
        df.select(F.explode(tokens(F.col(text), level, lowercase)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


def build_vocabulary(
    df: DataFrame,
    text: str,
    level: str = "char",
    lowercase: bool = True,
    min_freq: int = 1,
    max_vocab: int = 5000,
) -> DataFrame:
    """(token, freq, id): the most frequent tokens, ties by token, ids from 2.

    ``max_vocab`` counts the two special ids. Only the kept tokens, at most ``max_vocab``, reach the
    single task that numbers them.
    """
    kept = (
        token_counts(df, text, level, lowercase)
        .where(F.col("freq") >= min_freq)
        .orderBy(F.col("freq").desc(), F.col("token"))
        .limit(max(0, max_vocab - SPECIALS))
    )
    order = Window.orderBy(F.col("freq").desc(), F.col("token"))
    return kept.withColumn("id", (F.row_number().over(order) + (SPECIALS - 1)).cast("int"))


def vocab_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg((F.count(F.lit(1)) + SPECIALS).alias("vocab_size"))


def encode_tokens(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    vocab: DataFrame,
    level: str = "char",
    lowercase: bool = True,
    max_len: int = 256,
    map_tokens: int = MAP_TOKENS,
) -> DataFrame:
    """(keys, ids): one fixed-length id array per text; unknown tokens 1, padding 0.

    Encoding keeps the first ``max_len`` tokens by definition. A small vocabulary becomes a literal
    map and the encoding a projection. A larger one is joined token by token; a text contributes at
    most ``max_len`` rows to its group. Either way rows that repeat a key stay rows of their own.
    """
    keys = list(keys)
    head = F.slice(tokens(F.col(text), level, lowercase), 1, max_len)
    padding = F.array_repeat(F.lit(PAD_ID), max_len)
    entries = vocab.select("token", "id").limit(map_tokens + 1).collect()
    if len(entries) <= map_tokens:
        if entries:
            ids = F.create_map(*[F.lit(v) for e in entries for v in (e["token"], e["id"])])
            coded = F.transform(head, lambda t: F.coalesce(F.element_at(ids, t), F.lit(UNKNOWN_ID)))
        else:
            coded = F.transform(head, lambda t: F.lit(UNKNOWN_ID))
        return df.select(*keys, F.slice(F.concat(coded, padding), 1, max_len).alias("ids"))
    rows = df.select(*keys, head.alias("__head")).withColumn("__row", F.monotonically_increasing_id())
    placed = rows.select(*keys, "__row", F.posexplode_outer("__head").alias("__pos", "__token"))
    dim = vocab.select(F.col("token").alias("__token"), F.col("id").alias("__id"))
    pair = F.struct("__pos", F.coalesce("__id", F.lit(UNKNOWN_ID)).alias("__id"))
    coded = (
        attach(placed, dim, ["__token"], how="left")
        .groupBy(*keys, "__row")
        .agg(F.array_sort(F.collect_list(F.when(F.col("__pos").isNotNull(), pair))).alias("__pairs"))
    )
    return coded.select(*keys, F.slice(F.concat(F.col("__pairs.__id"), padding), 1, max_len).alias("ids"))


def tfidf(
    df: DataFrame, key: str, text: str, min_df: int = 2, low: int = 1, high: int = 3, most: int = LISTED
) -> DataFrame:
    """(key, term, weight): tf * (ln((1 + n) / (1 + df)) + 1), each text scaled to unit length.

    Texts that repeat a key are one. Grams of up to three characters are counted where their text lies and
    written once, a row for each text. If no key repeats and at most ``most`` terms are kept, tasks weigh whole
    texts; otherwise counts are joined with the terms and grouped by key.
    """
    coded = high <= LONGEST
    texts = spread(df.select(key, text), key)
    if coded:
        texts = stage(texts.select(key, gram_counts(F.col(text), low, high).alias("grams")), "term-counts")
        n = texts.count()
        alone = not texts.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").head(1)
        counts = texts.select(key, F.inline("grams").alias("term", "tf"))
        if not alone:
            counts = stage(counts.groupBy(key, "term").agg(F.sum("tf").alias("tf")), "term-counts")
    else:
        n, alone = df.count(), False
        grams = F.explode(char_ngrams(F.coalesce(F.col(text), F.lit("")), low, high))
        counts = texts.select(key, grams.alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
        counts = stage(counts, "term-counts")
    idf = (
        counts.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .where(F.col("df") >= min_df)
        .select("term", (F.ln(F.lit(1.0 + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf"))
    )
    listed = idf.limit(most + 1).toArrow() if alone else None
    if listed is not None and listed.num_rows <= most:
        weights = gram_weights(df.sparkSession, F.col("grams"), listed["term"].to_numpy(), listed["idf"].to_numpy())
        weighted = texts.select(key, F.inline(weights).alias("term", "weight"))
    else:
        weighted = attach(counts, idf, ["term"]).withColumn("__w", F.col("tf") * F.col("idf"))
        norm = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(key)))
        weighted = weighted.select(key, "term", (F.col("__w") / norm).alias("weight"))
    return weighted.withColumn("term", gram_text(F.col("term"))) if coded else weighted
