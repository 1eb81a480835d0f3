"""Tokens, vocabulary, n-grams, TF-IDF, signatures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.catalog import query
from flowsift.catalog.scans import VOCAB_SQL
from flowsift.catalog.sql import text as quoted_text
from flowsift.catalog.sql import with_views
from flowsift.functions import text
from flowsift.operators import vocab
from flowsift.operators.grams import gram_counts, gram_text
from flowsift.operators.joins import spread
from flowsift.sources import views


def token_digest(df: DataFrame, level: str) -> DataFrame:
    return df.select("doc_id", text.tokens(F.col("payload"), level).alias("t")).select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", "|")).alias("digest")
    )


def digest_sql(tokens: str) -> str:
    return with_views(
        f"""SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, '|')) AS digest
            FROM (SELECT doc_id, {tokens} AS t FROM payloads)""",
        "payloads",
    )


@query("tokenize_char", digest_sql("string_split(lower(payload), '')"))
def tokenize_char(spark: SparkSession, sf: str) -> DataFrame:
    return token_digest(views.payloads(spark, sf), "char")


WORDS_SQL = r"regexp_extract_all(lower(payload), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')"


@query("tokenize_word", digest_sql(WORDS_SQL))
def tokenize_word(spark: SparkSession, sf: str) -> DataFrame:
    return token_digest(views.payloads(spark, sf), "word")


@query(
    "token_frequency",
    with_views(
        f"SELECT token, count(*) AS freq FROM (SELECT unnest({WORDS_SQL}) AS token FROM payloads) GROUP BY token", "payloads"
    ),
)
def token_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.token_counts(views.payloads(spark, sf), "payload", "word")


@query(
    "build_vocabulary",
    with_views(
        f"""SELECT token, freq, CAST(row_number() OVER (ORDER BY freq DESC, token) + 1 AS INTEGER) AS id FROM (
              SELECT token, count(*) AS freq FROM (SELECT unnest({WORDS_SQL}) AS token FROM payloads)
              GROUP BY token HAVING count(*) >= 2 ORDER BY freq DESC, token LIMIT 4998)""",
        "payloads",
    ),
)
def build_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.build_vocabulary(views.payloads(spark, sf), "payload", "word", min_freq=2)


def encode_sql(tokens: str, vocabulary: str) -> str:
    return with_views(
        """SELECT doc_id, string_agg(CASE WHEN p > len(t) THEN '0' ELSE coalesce(CAST(v.id AS VARCHAR), '1') END, ' ' ORDER BY p) AS ids
           FROM places LEFT JOIN vocab AS v ON v.token = t[p] GROUP BY doc_id""",
        "payloads",
        vocab=vocabulary,
        places=f"SELECT doc_id, t, unnest(range(1, 257)) AS p FROM (SELECT doc_id, {tokens} AS t FROM payloads)",
    )


@query("encode_tokens", encode_sql("string_split(lower(payload), '')", VOCAB_SQL))
def encode_tokens(spark: SparkSession, sf: str) -> DataFrame:
    df = views.payloads(spark, sf)
    coded = vocab.encode_tokens(df, ["doc_id"], "payload", vocab.build_vocabulary(df, "payload"))
    return coded.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query(
    "encode_tokens_word",
    encode_sql(
        WORDS_SQL,
        f"""SELECT token, row_number() OVER (ORDER BY freq DESC, token) + 1 AS id FROM (
              SELECT token, count(*) AS freq FROM (SELECT unnest({WORDS_SQL}) AS token FROM payloads)
              GROUP BY token HAVING count(*) >= 2 ORDER BY freq DESC, token LIMIT 4998)""",
    ),
)
def encode_tokens_word(spark: SparkSession, sf: str) -> DataFrame:
    """Vocabulary above the map bound, so the tokens are joined."""
    df = views.payloads(spark, sf)
    words = vocab.build_vocabulary(df, "payload", "word", min_freq=2)
    coded = vocab.encode_tokens(df, ["doc_id"], "payload", words, "word")
    return coded.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query(
    "vocab_size",
    with_views(
        "SELECT count(*) + 2 AS vocab_size FROM (SELECT DISTINCT unnest(string_split(lower(payload), '')) FROM payloads)",
        "payloads",
    ),
)
def vocab_size(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.vocab_size(vocab.build_vocabulary(views.payloads(spark, sf), "payload"))


GRAMS = {
    "words": r"""SELECT doc_id, ' ' || w || ' ' AS w
                 FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(payload), '[\s\p{Z}]+')) AS w FROM payloads)
                 WHERE w <> ''""",
    "grams": """SELECT doc_id, substr(w, CAST(i AS BIGINT), n) AS term
                FROM (SELECT doc_id, w, n, unnest(range(1, length(w) - n + 2)) AS i
                      FROM (SELECT doc_id, w, unnest([1, 2, 3]) AS n FROM words))""",
}


@query(
    "char_wb_ngrams",
    with_views("SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS texts FROM grams GROUP BY term", "payloads", **GRAMS),
)
def char_wb_ngrams(spark: SparkSession, sf: str) -> DataFrame:
    """Corpus counts; counted per text first, so no term's texts are gathered."""
    texts = spread(views.payloads(spark, sf).select("doc_id", "payload"), "doc_id")
    grams = texts.select("doc_id", F.inline(gram_counts(F.col("payload"))).alias("g", "n"))
    per_text = grams.groupBy("doc_id", "g").agg(F.sum("n").alias("n"))
    counts = per_text.groupBy("g").agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("texts"))
    return counts.select(gram_text(F.col("g")).alias("term"), "occurrences", "texts")


@query(
    "tfidf",
    with_views(
        """SELECT doc_id, count(*) AS n_terms, round(sum(w / norm), 6) AS total, round(max(w / norm), 6) AS largest
           FROM (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS norm FROM weighted) GROUP BY doc_id""",
        "payloads",
        **GRAMS,
        tf="SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term",
        idf="""SELECT term, ln((1::DOUBLE + (SELECT count(*) FROM payloads)) / (1::DOUBLE + count(*))) + 1 AS idf
               FROM tf GROUP BY term HAVING count(*) >= 2""",
        weighted="SELECT doc_id, tf.term, tf * idf AS w FROM tf JOIN idf USING (term)",
    ),
)
def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    weights = vocab.tfidf(views.payloads(spark, sf), "doc_id", "payload")
    return weights.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.round(F.sum("weight"), 6).alias("total"),
        F.round(F.max("weight"), 6).alias("largest"),
    )


def hits_sql(column: str) -> str:
    cases = ", ".join(
        f"CASE WHEN regexp_matches({column}, {quoted_text(pattern)}) THEN '{name}' END" for name, pattern in text.SIGNATURES
    )
    return f"concat_ws(',', {cases})"


@query(
    "payload_indicators",
    with_views(
        f"""SELECT 'payload' AS kind, doc_id AS id, {hits_sql('payload')} AS indicators FROM payloads
            UNION ALL SELECT 'page', page_id, {hits_sql('html')} FROM pages""",
        "payloads",
    ),
)
def payload_indicators(spark: SparkSession, sf: str) -> DataFrame:
    texts = views.payloads(spark, sf).select(F.lit("payload").alias("kind"), F.col("doc_id").alias("id"), "payload")
    pages = views.table(spark, sf, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("payload")
    )
    return texts.unionByName(pages).select(
        "kind", "id", F.array_join(text.signatures(F.col("payload")), ",").alias("indicators")
    )
