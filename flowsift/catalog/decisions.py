"""Routing, explanation, monitoring and model versions on given scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.catalog import query
from flowsift.catalog.sql import commas, with_views
from flowsift.functions.numeric import confidence
from flowsift.operators import decide, monitor, versions
from flowsift.operators.clean import inf_to_null
from flowsift.operators.fitting import apply_imputer, apply_scaler
from flowsift.sources import views
from flowsift.sources.views import FLOW_COLS, FLOW_KEYS

WEIGHTS = decide.FusionWeights((36000.0, 0.35, 0.5), (36000.0, 0.22, 0.29), (0.4, 1.3, 0.9), -0.6)
SETTINGS = decide.RouteSettings(0.5, 0.6, 0.5, 3)


def given_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Component scores joined with the modalities of each event."""
    scores = views.scores3(spark, sf).drop("event_type", "y")
    predicted = views.scored(spark, sf).select("event_id", F.col("predicted").alias("predicted_class"))
    events = views.events_in(spark, sf).select("event_id", "features", "payload")
    return events.join(scores, "event_id").join(predicted, "event_id")




def presence() -> tuple:
    return F.coalesce(F.size("features") > 0, F.lit(False)), F.col("payload").isNotNull()


def z_sql(scores: tuple[str, str, str]) -> str:
    z = f"{WEIGHTS.intercept}::DOUBLE"
    for s, c, d, w in zip(scores, WEIGHTS.centers, WEIGHTS.scales, WEIGHTS.weights):
        z = f"({z} + ({s} - {c}::DOUBLE) / {d}::DOUBLE * {w}::DOUBLE)"
    return f"(1 / (1 + exp(-{z})))"


SCORES = ("anomaly_score", "attack_proba", "text_proba")
FILLED = {
    "filled": """SELECT event_id, has_features, payload,
                        CASE WHEN has_features THEN anomaly_score ELSE 0::DOUBLE END AS anomaly_score,
                        CASE WHEN has_features THEN attack_proba ELSE 0::DOUBLE END AS attack_proba,
                        CASE WHEN has_features THEN predicted ELSE 'UNKNOWN' END AS predicted_class,
                        CASE WHEN payload IS NOT NULL THEN text_proba ELSE 0.5::DOUBLE END AS text_proba
                 FROM events_in JOIN scores3 USING (event_id) JOIN (SELECT event_id, predicted FROM scored) USING (event_id)""",
}
ROUTED = {
    **FILLED,
    "fused": f"""SELECT *, payload IS NOT NULL AND NOT has_features AS text_only, {z_sql(SCORES)} AS fused FROM filled""",
    "routed": """SELECT *, CASE WHEN text_only THEN text_proba ELSE fused END AS p,
                        CASE WHEN text_only THEN 'text-only' WHEN payload IS NOT NULL THEN 'fusion'
                             ELSE 'tabular-only' END AS decision_source,
                        CASE WHEN text_only THEN 0.6::DOUBLE ELSE 0.5::DOUBLE END AS threshold FROM fused""",
}


@query("fusion_proba", with_views(f"SELECT event_id, round({z_sql(SCORES)}, 6) AS fused FROM scores3", "scores3"))
def fusion_proba(spark: SparkSession, sf: str) -> DataFrame:
    p = decide.fused_probability(WEIGHTS, [F.col(s) for s in SCORES])
    return views.scores3(spark, sf).select("event_id", F.round(p, 6).alias("fused"))


@query(
    "missing_modality_defaults",
    with_views(
        "SELECT event_id, anomaly_score, attack_proba, text_proba, predicted_class FROM filled",
        "events_in",
        "scores3",
        "scored",
        **FILLED,
    ),
)
def missing_modality_defaults(spark: SparkSession, sf: str) -> DataFrame:
    filled = decide.fill_modalities(given_scores(spark, sf), *presence(), SETTINGS)
    return filled.select("event_id", *SCORES, "predicted_class")


def routed(spark: SparkSession, sf: str) -> DataFrame:
    filled = decide.fill_modalities(given_scores(spark, sf), *presence(), SETTINGS)
    return decide.route(filled, *presence(), WEIGHTS, SETTINGS)


@query(
    "route_decision",
    with_views(
        """SELECT event_id, decision_source, p >= threshold AS is_threat, round(p, 6) AS threat_probability,
                  round(least(abs(p - 0.5::DOUBLE) * 2, 1), 6) AS confidence, predicted_class FROM routed""",
        "events_in",
        "scores3",
        "scored",
        **ROUTED,
    ),
)
def route_decision(spark: SparkSession, sf: str) -> DataFrame:
    return routed(spark, sf).select(
        "event_id",
        "decision_source",
        "is_threat",
        F.round("threat_proba", 6).alias("threat_probability"),
        F.round("confidence", 6).alias("confidence"),
        "predicted_class",
    )


@query(
    "confidence",
    with_views("SELECT event_id, least(abs(score - 0.5::DOUBLE) * 2, 1::DOUBLE) AS confidence FROM scored", "scored"),
)
def confidence_query(spark: SparkSession, sf: str) -> DataFrame:
    return views.scored(spark, sf).select("event_id", confidence(F.col("score")).alias("confidence"))


# Given importances and scaling of the flow features.
IMPORTANCES = {c: (i * 7 % 10 + 1) / 55 for i, c in enumerate(FLOW_COLS)}
FIXED_SCALES = {c: (float(i), 3.7 * 10 ** (i % 4)) for i, c in enumerate(FLOW_COLS)}
_cells = ", ".join(
    f"{{'i': {i}, 'f': '{c}', 'v': (coalesce({c}, 0) - {FIXED_SCALES[c][0]}::DOUBLE) / {FIXED_SCALES[c][1]}::DOUBLE, 'w': {IMPORTANCES[c]!r}::DOUBLE}}"
    for i, c in enumerate(FLOW_COLS)
)


@query(
    "topk_features",
    with_views(
        f"""SELECT {commas(FLOW_KEYS)}, CAST(rk - 1 AS INTEGER) AS place, s.f AS feature,
                   round(s.v, 4) AS scaled_value, round(s.w, 4) AS importance
            FROM (SELECT *, row_number() OVER (PARTITION BY {commas(FLOW_KEYS)} ORDER BY abs(s.v) * s.w DESC, s.i DESC) AS rk
                  FROM (SELECT {commas(FLOW_KEYS)}, unnest([{_cells}]) AS s FROM folded))
            WHERE rk <= 3""",
        "folded",
    ),
)
def topk_features(spark: SparkSession, sf: str) -> DataFrame:
    df = apply_imputer(inf_to_null(views.flows(spark, sf), FLOW_COLS), dict.fromkeys(FLOW_COLS, 0.0))
    scaled = apply_scaler(df, FIXED_SCALES)
    top = decide.top_features([F.col(c) for c in FLOW_COLS], FLOW_COLS, IMPORTANCES, 3)
    return scaled.select(*FLOW_KEYS, F.posexplode(top).alias("place", "t")).select(*FLOW_KEYS, "place", "t.*")


@query(
    "parse_event_json",
    with_views(
        """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE duration END AS duration,
                  CASE WHEN event_type = 'error' THEN NULL ELSE line_no END AS line_no,
                  CASE WHEN event_type = 'error' THEN NULL ELSE payload END AS payload,
                  event_type = 'error' AS is_corrupt
           FROM events_in""",
        "events_in",
    ),
)
def parse_event_json(spark: SparkSession, sf: str) -> DataFrame:
    parsed = views.parse_events(views.event_json(spark, sf))
    bad = F.col("corrupt").isNotNull()
    return parsed.select(
        "event_id",
        F.when(~bad, F.col("features")["duration"]).alias("duration"),
        F.when(~bad, F.col("features")["line_no"]).alias("line_no"),
        F.when(~bad, F.col("payload")).alias("payload"),
        bad.alias("is_corrupt"),
    )


@query(
    "event_counters",
    """SELECT event_type AS endpoint, count(*) AS events_scored, count(*) FILTER (value > 50) AS threats,
              count(*) FILTER (value > 50)::DOUBLE / count(*) AS threat_rate FROM events GROUP BY event_type""",
)
def event_counters(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.event_counters(views.latency(spark, sf), F.col("millis") > 50, ["endpoint"])


def histogram_sql(value: str, source: str, bounds: tuple[float, ...], by: str = "") -> str:
    lead = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    common = f"count({value}) AS observations, round(sum({value}), 6) AS total FROM {source}{tail}"
    parts = [
        f"SELECT {lead}'{b}' AS le, count(*) FILTER ({value} <= {b}::DOUBLE) AS cumulative, {common}" for b in bounds
    ]
    parts.append(f"SELECT {lead}'Infinity' AS le, count({value}) AS cumulative, {common}")
    return " UNION ALL ".join(parts)


def shaped(df: DataFrame) -> DataFrame:
    return df.withColumn("le", F.col("le").cast("string")).withColumn("total", F.round("total", 6))


@query(
    "probability_histogram", with_views(histogram_sql("score", "scored", monitor.PROBABILITY_BOUNDS), "scored")
)
def probability_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return shaped(monitor.cumulative_histogram(views.scored(spark, sf), "score", monitor.PROBABILITY_BOUNDS))


@query(
    "latency_histogram",
    with_views(
        histogram_sql("seconds", "lat", monitor.LATENCY_BOUNDS_SECONDS, "endpoint"),
        lat="SELECT event_type AS endpoint, value / 1000 AS seconds FROM events",
    ),
)
def latency_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return shaped(
        monitor.cumulative_histogram(
            views.latency(spark, sf), "seconds", monitor.LATENCY_BOUNDS_SECONDS, ["endpoint"]
        )
    )


LATEST = {"latest": "SELECT name, max(CAST(version AS BIGINT)) AS latest FROM versions GROUP BY name"}


@query("latest_version", with_views("SELECT * FROM latest", "versions", **LATEST))
def latest_version(spark: SparkSession, sf: str) -> DataFrame:
    return versions.latest_version(views.versions(spark, sf))


@query(
    "promote_alias",
    with_views(
        """SELECT name, alias, CASE WHEN name = 'Brand#4' AND alias = 'production' THEN 3 ELSE version END AS version FROM (
             SELECT name, alias, version FROM aliases WHERE alias <> 'production'
             UNION ALL SELECT name, 'production', latest FROM latest)""",
        "versions",
        "aliases",
        **LATEST,
    ),
)
def promote_alias(spark: SparkSession, sf: str) -> DataFrame:
    """Every model to its latest version, then one model to a given version."""
    known = views.versions(spark, sf)
    promoted = versions.promote_latest(views.aliases(spark, sf), known)
    return versions.promote(promoted, known, "Brand#4", 3)


@query(
    "resolve_alias",
    with_views(
        """SELECT name, version FROM (SELECT DISTINCT name FROM versions)
           LEFT JOIN (SELECT name, version FROM aliases WHERE alias = 'staging') USING (name)""",
        "versions",
        "aliases",
    ),
)
def resolve_alias(spark: SparkSession, sf: str) -> DataFrame:
    return versions.resolve(views.versions(spark, sf), views.aliases(spark, sf), "staging")
