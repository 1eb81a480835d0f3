"""Registered queries of the subpackage, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.llm.decontaminate import find_contamination, hit_words, is_contaminated
from flowsift.llm.fingerprints import compare_with_edits
from flowsift.llm.jaccard import join_similar
from flowsift.llm.language import learn_and_identify
from flowsift.llm.licenses import license_report
from flowsift.llm.middles import fill_in_middle, restore_text
from flowsift.llm.mixing import mix_sources
from flowsift.llm.pii import replace_entities
from flowsift.llm.quality import classify_quality
from flowsift.llm.substrings import remove_repeats
from flowsift.llm.topk import top_inner_products
from flowsift.llm.tries import conversation_trie
from flowsift.llm.warc import archive_round_trip
from flowsift.llm.words import held_out, spaced_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def mixing_quality(text, size):
    """Weight of a document in the mix: ordinary word length counts in full, other lengths less."""
    length = F.length(text) / F.greatest(size, F.lit(1))
    return F.when(length.between(4.0, 8.0), 1.0).when(length.between(3.0, 12.0), 0.5).otherwise(0.25)


@query
def op4_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    size = spaced_count(F.col("text"))
    mixed = mix_sources(table(spark, sf, "documents"), size, mixing_quality(F.col("text"), size))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op4_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, length(text) AS chars,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|17'), 1, 13))::BIGINT / pow(16, 13) AS u
  FROM documents
), weighted AS (
  SELECT *, CASE WHEN chars IS NULL THEN 0.25
                 WHEN chars / greatest(size, 1) BETWEEN 4 AND 8 THEN 1.0
                 WHEN chars / greatest(size, 1) BETWEEN 3 AND 12 THEN 0.5 ELSE 0.25 END AS weight
  FROM sized
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS most,
         [3, 1, 2][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS share
  FROM weighted GROUP BY source
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(most) OVER (ORDER BY most / share, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(share) OVER (ORDER BY most / share, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM per_source
), targets AS (
  SELECT source, source_size,
         CASE WHEN most / share <= lvl THEN most
              ELSE least(share * max(CASE WHEN most / share > lvl THEN lvl END) OVER (), most) END AS target
  FROM levels
), ordered AS (
  SELECT w.doc_id, w.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size + 1e-9) ELSE 0 END AS epochs,
         coalesce(sum(w.size) OVER (PARTITION BY w.source ORDER BY -ln(1.0 - w.u) / w.weight, w.doc_id, w.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM weighted w JOIN targets t ON w.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target - epochs * source_size + 0.5) - start)))::BIGINT AS taken
FROM ordered
"""


@query
def op6_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return compare_with_edits(table(spark, sf, "documents"))


@query
def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held = held_out(F.col("doc_id"), 4, 2)
    scored, _ = classify_quality(docs, table(spark, sf, "labels"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query
def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    held = held_out(F.col("doc_id"), 3, 1)
    found = learn_and_identify(table(spark, sf, "documents"), ~held)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return join_similar(table(spark, sf, "documents"))


@query
def op8_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = find_contamination(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    items = F.coalesce("hit_items", F.array().cast("array<string>"))
    return found.withColumn("n_hit", hit_words()).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


@query
def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    return archive_round_trip(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op7_warc"] = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), kept AS (
  SELECT payload, max(page_id) AS kept FROM sized WHERE payload_bytes >= 1000 GROUP BY payload HAVING count(*) > 1
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept <> page_id THEN kept END AS refers_to
FROM sized LEFT JOIN kept USING (payload)
"""

ORACLES["op2_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13
), windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 12), ' ')) AS k FROM places
), smallest AS (
  SELECT k, min(doc_id) AS m FROM windows GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM windows JOIN smallest USING (k) WHERE m < doc_id
), per_doc AS (
  SELECT doc_id, list(j) AS gone FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w
              ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN per_doc USING (doc_id)
"""

ORACLES["op8_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), items AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark
), starts AS (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0
), phrases AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + 12), ' ') AS k FROM starts
), lengths AS (
  SELECT DISTINCT n FROM phrases
), places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n
), hits AS (
  SELECT doc_id, i, p.n, item_id FROM places JOIN phrases p ON p.n = places.n AND p.k = array_to_string(list_slice(w, i, i + places.n - 1), ' ')
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES["op3_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + 4), ' ')) AS s FROM starts
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), ends AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(doc_id, r) AS (
  SELECT a, b FROM ends UNION SELECT reach.doc_id, ends.b FROM reach JOIN ends ON ends.a = reach.r
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT doc_id, min(r) AS m FROM reach GROUP BY doc_id) USING (doc_id)
"""


@query
def op5_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return license_report(table(spark, sf, "documents"))


#: Key of the surrogates of the registered query. A run on real data passes a secret of its own.
SURROGATE_KEY = "registered-query"


@query
def op10_pii_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return replace_entities(docs, SURROGATE_KEY).withColumn("entity_kinds", F.array_join("entity_kinds", ","))


@query
def op13_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf, "documents"))
    hashes = F.sha2("output", 256).alias("output_sha256"), F.sha2(restore_text("output", "form"), 256).alias("restored_sha256")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


ORACLES["op13_fill_in_middle"] = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents
), numbers AS (
  SELECT *, [('0x' || substr(hex, 8 * i + 1, 8))::BIGINT FOR i IN [0, 1, 2, 3]] AS h FROM drawn
), cut AS (
  SELECT doc_id, text, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1, n - b) AS suffix FROM cut
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query
def op11_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_inner_products(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


ORACLES["op11_exact_top_k"] = """
WITH longest AS (
  SELECT max(len(embedding)) AS n FROM embeddings
), v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_resize(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)), (SELECT n FROM longest), 0::DOUBLE) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, v.vec_id, list_dot_product(q.c, v.c)::BIGINT AS score
  FROM v q JOIN v ON q.r <> v.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST))::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


@query
def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_trie(table(spark, sf, "conversations"))


ORACLES["op12_prefix_trie"] = r"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT conv_id, struct_pack(k := md5(length(role) || ':' || role || text), w := len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS pos
  FROM told
), own AS (
  SELECT conv_id, list(t ORDER BY pos) AS ts,
         -- CRC-32 of the decimal id, bit by bit
         xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
             lambda crc, b: list_reduce([xor(crc, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda x, one: xor(x >> 1, 3988292384 * (x & one)))), 4294967295) % 4 AS h
  FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT o.conv_id, list_concat(list_slice(coalesce(f.ts, []), 1, o.h), list_slice(o.ts, o.h + 1, len(o.ts))) AS ts
  FROM own o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 20
), prefixes AS (
  SELECT conv_id, ts, d, array_to_string(list_transform(list_slice(ts, 1, d), lambda t: t.k), '') AS node
  FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d > 0 THEN ts[d].w ELSE 0 END) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ts) = d), '')) AS ends_sha256
  FROM prefixes GROUP BY node, d
), children AS (
  SELECT substr(node, 1, 32 * (d - 1)) AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), sized AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (node)
), above AS (
  SELECT substr(node, 1, 32 * unnest(range(0, d + 1))) AS node, (n_children = 0)::INT AS leaf, (n_convs - 1) * words AS saved FROM sized
), sums AS (
  SELECT node, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY node
)
SELECT s.conv_id, s.d::BIGINT AS depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, s.ends_sha256
FROM sized s JOIN sums USING (node) LEFT JOIN sized p ON s.d > 0 AND p.node = substr(s.node, 1, 32 * (s.d - 1))
"""
