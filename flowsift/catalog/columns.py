"""Projections, predicates, schema checks and row cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.catalog import query
from flowsift.catalog.sql import commas, finite, text, with_views
from flowsift.functions import labels, numeric
from flowsift.operators import clean, columns
from flowsift.schema import LABELS
from flowsift.sources import views
from flowsift.sources.views import FLOW_COLS, FLOW_KEYS

ROWS = commas([*FLOW_KEYS, *FLOW_COLS, "label"])


def keyed(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*FLOW_KEYS, *cols)


@query(
    "normalise_columns",
    with_views(
        """SELECT label AS "Label", count(*) AS n_rows, round(sum(bytes), 2) AS sum_bytes FROM flows GROUP BY label""",
        "flows",
    ),
)
def normalise_columns(spark: SparkSession, sf: str) -> DataFrame:
    wide = views.flows(spark, sf)
    padded = wide.toDF(*[f"  {c} " for c in wide.columns])
    return (
        columns.normalise_columns(padded)
        .groupBy("Label")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("bytes"), 2).alias("sum_bytes"))
    )


_rules = " ".join(f"WHEN contains(t, {text(w)}) THEN {text(c)}" for w, c in labels.LABEL_RULES)
NORMAL_SQL = f"""CASE WHEN raw_label IS NULL THEN 'BENIGN' {_rules.replace('(t,', '(lower(trim(raw_label)),')}
                 WHEN lower(trim(raw_label)) IN ('', 'nan') THEN 'BENIGN' ELSE 'DoS' END"""


@query(
    "normalise_label",
    with_views(
        f"SELECT raw_label, {NORMAL_SQL} AS label_class, count(*) AS n_rows FROM raw_labels GROUP BY 1, 2",
        "raw_labels",
    ),
)
def normalise_label(spark: SparkSession, sf: str) -> DataFrame:
    df = views.raw_labels(spark, sf)
    return df.groupBy("raw_label", labels.normalise_label(F.col("raw_label")).alias("label_class")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


_required = {"doc_id": "bigint", "lang": "double", "n_chars": "int", "source": "bigint", "quality": "int"}


@query(
    "schema_check",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_values,
                   count(*) FILTER ({c} IS NOT NULL AND try_cast({c} AS {t}) IS NULL) AS uncastable_values
            FROM documents LEFT JOIN labels USING (doc_id)"""
        for c, t in _required.items()
    ),
)
def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    docs = views.table(spark, sf, "documents").join(views.table(spark, sf, "labels"), "doc_id", "left")
    return columns.schema_check(docs, _required)


@query("project_canonical", with_views("SELECT packet_rate IS NULL AS no_rate, duration, bytes, label FROM folded", "folded"))
def project_canonical(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["duration", "packet_rate", "bytes"]
    strict = columns.project_canonical(clean.inf_to_null(views.flows(spark, sf), FLOW_COLS), wanted, "label")
    return strict.select(F.col("packet_rate").isNull().alias("no_rate"), "duration", "bytes", "label")


@query(
    "reindex_lenient",
    with_views(f"SELECT {commas(FLOW_KEYS)}, bytes, CAST(NULL AS DOUBLE) AS absent, duration FROM flows", "flows"),
)
def reindex_lenient(spark: SparkSession, sf: str) -> DataFrame:
    return columns.reindex(views.flows(spark, sf), ["bytes", "absent", "duration"], FLOW_KEYS)


@query("inf_to_null", with_views(f"SELECT {ROWS} FROM folded", "folded"))
def inf_to_null(spark: SparkSession, sf: str) -> DataFrame:
    return clean.inf_to_null(views.flows(spark, sf), FLOW_COLS)


@query(
    "drop_all_null",
    with_views(
        f"""SELECT {commas(FLOW_KEYS)}, byte_rate, packet_rate FROM folded
            WHERE byte_rate IS NOT NULL OR packet_rate IS NOT NULL""",
        "folded",
    ),
)
def drop_all_null(spark: SparkSession, sf: str) -> DataFrame:
    rates = ["byte_rate", "packet_rate"]
    return clean.drop_all_null(keyed(clean.inf_to_null(views.flows(spark, sf), rates), *rates), rates)


_folded_dup = f"SELECT {commas(FLOW_KEYS)}, {', '.join(f'{finite(c)} AS {c}' for c in FLOW_COLS)}, label FROM flows_dup"


@query("clean_flows_train", with_views(f"SELECT DISTINCT {ROWS} FROM f", "flows_dup", f=_folded_dup))
def clean_flows_train(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_flows(views.flows_dup(spark, sf), FLOW_COLS, training=True)


@query("clean_flows_serve", with_views(f"SELECT {ROWS} FROM f", "flows_dup", f=_folded_dup))
def clean_flows_serve(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_flows(views.flows_dup(spark, sf), FLOW_COLS, training=False)


@query("dedup_exact", with_views(f"SELECT DISTINCT {ROWS} FROM f", "flows_dup", f=_folded_dup))
def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return clean.dedup_exact(views.flows_dup(spark, sf), FLOW_COLS)


@query(
    "duplicate_report",
    with_views(
        f"""SELECT CAST(sum(c) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(c - 1) AS BIGINT) AS surplus_rows,
                   count(*) FILTER (c > 1) AS duplicated_groups, sum(c - 1) > 0 AS has_duplicates
            FROM (SELECT count(*) AS c FROM f GROUP BY {ROWS})""",
        "flows_dup",
        f=_folded_dup,
    ),
)
def duplicate_report(spark: SparkSession, sf: str) -> DataFrame:
    return clean.duplicate_report(clean.inf_to_null(views.flows_dup(spark, sf), FLOW_COLS))


@query(
    "binary_target",
    with_views(f"SELECT {commas(FLOW_KEYS)}, CAST(label <> 'BENIGN' AS INTEGER) AS is_attack FROM flows", "flows"),
)
def binary_target(spark: SparkSession, sf: str) -> DataFrame:
    return views.flows(spark, sf).select(*FLOW_KEYS, labels.binary_target(F.col("label")).alias("is_attack"))


_ids = "CASE label " + " ".join(f"WHEN {text(x)} THEN {i}" for i, x in enumerate(LABELS)) + " END"


@query("encode_labels", with_views(f"SELECT {commas(FLOW_KEYS)}, CAST({_ids} AS INTEGER) AS class_id FROM flows", "flows"))
def encode_labels(spark: SparkSession, sf: str) -> DataFrame:
    return keyed(columns.encode_labels(views.flows(spark, sf), "label"), "class_id")


@query(
    "unknown_labels",
    with_views(
        f"""SELECT raw_label AS unknown_label, count(*) AS rows FROM raw_labels
            WHERE raw_label IS NULL OR raw_label NOT IN ({commas([text(x) for x in LABELS])}) GROUP BY 1""",
        "raw_labels",
    ),
)
def unknown_labels(spark: SparkSession, sf: str) -> DataFrame:
    return columns.unknown_labels(views.raw_labels(spark, sf), "raw_label")


@query(
    "decode_labels",
    f"SELECT vec_id, ([{commas([text(x) for x in LABELS])}])[(label % 8) + 1] AS class FROM embeddings",
)
def decode_labels(spark: SparkSession, sf: str) -> DataFrame:
    emb = views.table(spark, sf, "embeddings")
    return emb.select("vec_id", labels.label_name(F.col("label") % 8).alias("class"))


@query("class_filter", with_views(f"SELECT {commas(FLOW_KEYS)}, bytes FROM flows WHERE label = 'DDoS'", "flows"))
def class_filter(spark: SparkSession, sf: str) -> DataFrame:
    return keyed(views.flows(spark, sf).where(F.col("label") == "DDoS"), "bytes")


@query(
    "event_validity",
    with_views(
        """SELECT event_id, CASE WHEN has_features OR payload IS NOT NULL THEN 'valid' ELSE 'rejected' END AS status
           FROM events_in""",
        "events_in",
    ),
)
def event_validity(spark: SparkSession, sf: str) -> DataFrame:
    valid, rejected = columns.split_valid(views.events_in(spark, sf))
    named = [df.select("event_id", F.lit(s).alias("status")) for df, s in ((valid, "valid"), (rejected, "rejected"))]
    return named[0].unionByName(named[1])


@query(
    "threshold_flag",
    with_views("SELECT event_id, CAST(score >= 0.3::DOUBLE AS INTEGER) AS flag FROM scored", "scored"),
)
def threshold_flag(spark: SparkSession, sf: str) -> DataFrame:
    return views.scored(spark, sf).select("event_id", numeric.threshold_flag(F.col("score"), 0.3).alias("flag"))


@query(
    "cast_float32",
    with_views(
        f"SELECT {commas(FLOW_KEYS)}, {', '.join(f'CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}' for c in FLOW_COLS)} FROM folded",
        "folded",
    ),
)
def cast_float32(spark: SparkSession, sf: str) -> DataFrame:
    narrow = columns.cast_float32(clean.inf_to_null(views.flows(spark, sf), FLOW_COLS), FLOW_COLS)
    return narrow.select(*FLOW_KEYS, *[F.col(c).cast("double").alias(c) for c in FLOW_COLS])


_bad = " + ".join(f"CAST(NOT isfinite({c}) AS BIGINT)" for c in FLOW_COLS)


@query(
    "assert_finite",
    with_views(
        f"""SELECT count(*) AS rows, CAST(sum({_bad}) AS BIGINT) AS bad_cells,
                   count(*) FILTER (({_bad}) > 0) AS bad_rows FROM flows""",
        "flows",
    ),
)
def assert_finite(spark: SparkSession, sf: str) -> DataFrame:
    return columns.count_nonfinite(views.flows(spark, sf), FLOW_COLS)


