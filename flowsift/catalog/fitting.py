"""Fitted column statistics and transforms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.catalog import query
from flowsift.catalog.sql import commas, split_of, text, with_views
from flowsift.functions.labels import binary_target
from flowsift.models.stages import FlowPreprocessor
from flowsift.operators import fitting
from flowsift.operators.clean import inf_to_null
from flowsift.plans.preprocess import preprocess_flows, split_flows
from flowsift.schema import FLOW_FEATURES
from flowsift.session import scratch_dir, stage
from flowsift.sources import views
from flowsift.sources.views import FLOW_COLS, FLOW_KEYS, WIDE_FROM

KEYS = commas(FLOW_KEYS)


def folded(spark: SparkSession, sf: str) -> DataFrame:
    return inf_to_null(views.flows(spark, sf), FLOW_COLS)


def folded_once(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Columns of the folded flows, written once: the join behind them is not repeated by every pass of a fit."""
    return stage(folded(spark, sf).select(*columns), "folded")


def fills_table(spark: SparkSession, fills: Mapping[str, float], digits: int = 3) -> DataFrame:
    return spark.createDataFrame([(c, round(float(v), digits)) for c, v in fills.items()], "feature string, fill double")


def per_feature(expr: str, source: str = "folded") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {expr.replace('@', c)} FROM {source}" for c in FLOW_COLS
    )


def stats(expr: str, source: str, prefix: str) -> str:
    return "SELECT " + ", ".join(f"{expr.replace('@', c)} AS {prefix}_{c}" for c in FLOW_COLS) + f" FROM {source}"


@query("fit_impute_median", with_views(per_feature("round(median(@), 3) AS fill"), "folded"))
def fit_impute_median(spark: SparkSession, sf: str) -> DataFrame:
    return fills_table(spark, fitting.fit_imputer(folded_once(spark, sf, *FLOW_COLS), FLOW_COLS, "median"))


@query("fit_impute_mean", with_views(per_feature("round(avg(@), 3) AS fill"), "folded"))
def fit_impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    return fills_table(spark, fitting.fit_imputer(folded(spark, sf), FLOW_COLS, "mean"))


@query(
    "fit_impute_mode",
    with_views(
        " UNION ALL ".join(
            f"""(SELECT '{c}' AS feature, round({c}, 3) AS fill FROM folded WHERE {c} IS NOT NULL GROUP BY {c}
                ORDER BY count(*) DESC, {c} LIMIT 1)"""
            for c in FLOW_COLS
        ),
        "folded",
    ),
)
def fit_impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    return fills_table(spark, fitting.fit_imputer(folded(spark, sf), FLOW_COLS, "most_frequent"))


_fills = stats("median(@)", "folded", "m")
_filled = "SELECT " + ", ".join([*FLOW_KEYS, *[f"coalesce({c}, m_{c}) AS {c}" for c in FLOW_COLS], "label"]) + " FROM folded, fills"


@query(
    "apply_impute",
    with_views(
        f"SELECT {KEYS}, {', '.join(f'round({c}, 4) AS {c}' for c in FLOW_COLS)} FROM filled", "folded", fills=_fills, filled=_filled
    ),
)
def apply_impute(spark: SparkSession, sf: str) -> DataFrame:
    df = folded_once(spark, sf, *FLOW_KEYS, *FLOW_COLS)
    filled = fitting.apply_imputer(df, fitting.fit_imputer(df, FLOW_COLS))
    return filled.select(*FLOW_KEYS, *[F.round(c, 4).alias(c) for c in FLOW_COLS])


def scaler_table(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    df = folded_once(spark, sf, *FLOW_COLS)
    filled = fitting.apply_imputer(df, fitting.fit_imputer(df, FLOW_COLS))
    scaler = fitting.fit_scaler(filled, FLOW_COLS, kind)
    return spark.createDataFrame(
        [(c, round(m, 3), round(s, 3)) for c, (m, s) in scaler.items()],
        "feature string, center double, scale double",
    )


@query(
    "fit_scale_standard",
    with_views(
        per_feature("round(avg(@), 3) AS center, round(stddev_pop(@), 3) AS scale", "filled"),
        "folded",
        fills=_fills,
        filled=_filled,
    ),
)
def fit_scale_standard(spark: SparkSession, sf: str) -> DataFrame:
    return scaler_table(spark, sf, "standard")


@query(
    "fit_scale_robust",
    with_views(
        per_feature(
            "round(median(@), 3) AS center, round(quantile_cont(@, 0.75) - quantile_cont(@, 0.25), 3) AS scale", "filled"
        ),
        "folded",
        fills=_fills,
        filled=_filled,
    ),
)
def fit_scale_robust(spark: SparkSession, sf: str) -> DataFrame:
    return scaler_table(spark, sf, "robust")


def _wide_cell(i: int) -> str:
    return f"CASE WHEN (k_part + {i}) % 13 <> 0 THEN {WIDE_FROM[i % len(WIDE_FROM)]} * {i % 9 + 1} END"


@query(
    "fit_scale_robust_wide",
    with_views(
        " UNION ALL ".join(
            f"SELECT {text(name)} AS feature, round(median({_wide_cell(i)}), 3) AS center, "
            f"round(quantile_cont({_wide_cell(i)}, 0.75) - quantile_cont({_wide_cell(i)}, 0.25), 3) AS scale FROM flows"
            for i, name in enumerate(FLOW_FEATURES)
        ),
        "flows",
    ),
)
def fit_scale_robust_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The robust scaler over the whole feature table."""
    scaler = fitting.fit_scaler(views.wide_flows(spark, sf, stage), FLOW_FEATURES, "robust")
    rows = [(c, round(center, 3), round(scale, 3)) for c, (center, scale) in scaler.items()]
    return spark.createDataFrame(rows, "feature string, center double, scale double")


@query("scale_none", with_views(f"SELECT {KEYS}, bytes, byte_rate FROM folded", "folded"))
def scale_none(spark: SparkSession, sf: str) -> DataFrame:
    df = folded(spark, sf)
    scaler = fitting.fit_scaler(df, ["bytes", "byte_rate"], "none")
    return fitting.apply_scaler(df.select(*FLOW_KEYS, "bytes", "byte_rate"), scaler)


def _scaled(source: str, digits: int = 4) -> str:
    cols = ", ".join(f"round(({c} - c_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, {digits}) AS {c}" for c in FLOW_COLS)
    return f"SELECT {KEYS}, {cols} FROM {source}"


_scales = "SELECT " + ", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS s_{c}" for c in FLOW_COLS) + " FROM "


@query(
    "apply_scale",
    with_views(_scaled("filled, scales"), "folded", fills=_fills, filled=_filled, scales=_scales + "filled"),
)
def apply_scale(spark: SparkSession, sf: str) -> DataFrame:
    df = folded_once(spark, sf, *FLOW_KEYS, *FLOW_COLS)
    filled = fitting.apply_imputer(df, fitting.fit_imputer(df, FLOW_COLS))
    scaled = fitting.apply_scaler(filled, fitting.fit_scaler(filled, FLOW_COLS, "standard"))
    return scaled.select(*FLOW_KEYS, *[F.round(c, 4).alias(c) for c in FLOW_COLS])


_pipeline = {
    "f": "SELECT DISTINCT " + commas([*FLOW_KEYS, *[f"CASE WHEN isfinite({c}) THEN {c} END AS {c}" for c in FLOW_COLS], "label"])
    + " FROM flows_dup",
    "parts": split_of("f"),
    "train_fills": stats("median(@)", "parts WHERE split = 'train'", "m"),
    "pfilled": "SELECT " + ", ".join([*FLOW_KEYS, *[f"coalesce({c}, m_{c}) AS {c}" for c in FLOW_COLS], "label", "split"])
    + " FROM parts, train_fills",
    "pscales": _scales + "pfilled WHERE split = 'train'",
}


def preprocessed(spark: SparkSession, sf: str) -> DataFrame:
    return preprocess_flows(views.flows_dup(spark, sf), FLOW_COLS, FLOW_KEYS, "label", as_float=False)[0]


@query(
    "preprocess_fit_transform",
    with_views(
        _scaled("pfilled, pscales").replace(f"SELECT {KEYS}", f"SELECT {KEYS}, label, split"), "flows_dup", **_pipeline
    ),
)
def preprocess_fit_transform(spark: SparkSession, sf: str) -> DataFrame:
    out = preprocessed(spark, sf)
    return out.select(*FLOW_KEYS, "label", "split", *[F.round(c, 4).alias(c) for c in FLOW_COLS])


@query(
    "preprocess_pipeline",
    with_views(
        _scaled("pfilled, pscales").replace(f"SELECT {KEYS}", f"SELECT {KEYS}, label, split"), "flows_dup", **_pipeline
    ),
)
def preprocess_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """The preprocessing as a pipeline stage: fitted on training rows, stored, loaded, applied to every split."""
    parts = split_flows(views.flows_dup(spark, sf), FLOW_COLS, FLOW_KEYS, "label")
    stages = [FlowPreprocessor(inputCols=FLOW_COLS, asFloat=False)]
    path = scratch_dir(spark, "pipeline")
    Pipeline(stages=stages).fit(parts.where(F.col("split") == "train")).write().save(path)
    out = PipelineModel.load(path).transform(parts)
    return out.select(*FLOW_KEYS, "label", "split", *[F.round(c, 4).alias(c) for c in FLOW_COLS])


@query(
    "preprocess_flows",
    with_views(
        "SELECT split, label, count(*) AS n_rows, "
        + ", ".join(
            f"round(avg(({c} - c_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END), 6) AS {c}" for c in FLOW_COLS
        )
        + " FROM pfilled, pscales GROUP BY split, label",
        "flows_dup",
        **_pipeline,
    ),
)
def preprocess_flows_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: mean of every scaled feature per split and label after the whole preprocessing."""
    return (
        preprocessed(spark, sf)
        .groupBy("split", "label")
        .agg(F.count(F.lit(1)).alias("n_rows"), *[F.round(F.avg(c), 6).alias(c) for c in FLOW_COLS])
    )


def targets(spark: SparkSession, sf: str) -> DataFrame:
    return views.flows(spark, sf).select(*FLOW_KEYS, "label", binary_target(F.col("label")).alias("is_attack"))


@query("prevalence", with_views("SELECT avg(CAST(label <> 'BENIGN' AS DOUBLE)) AS prevalence FROM flows", "flows"))
def prevalence(spark: SparkSession, sf: str) -> DataFrame:
    return fitting.prevalence(targets(spark, sf), "is_attack")


@query(
    "class_balanced_weight",
    with_views(
        f"""SELECT {KEYS}, label, round((SELECT count(*) FROM flows)::DOUBLE /
                   ((SELECT count(DISTINCT label) FROM flows) * count(*) OVER (PARTITION BY label)), 6) AS weight
            FROM flows""",
        "flows",
    ),
)
def class_balanced_weight(spark: SparkSession, sf: str) -> DataFrame:
    df = fitting.class_weights(views.flows(spark, sf).select(*FLOW_KEYS, "label"), "label")
    return df.select(*FLOW_KEYS, "label", F.round("weight", 6).alias("weight"))


@query(
    "positive_weight",
    with_views(
        """SELECT count(*) FILTER (label = 'BENIGN') / greatest(count(*) FILTER (label <> 'BENIGN'), 1)::DOUBLE AS pos_weight
           FROM flows""",
        "flows",
    ),
)
def positive_weight(spark: SparkSession, sf: str) -> DataFrame:
    return fitting.positive_weight(targets(spark, sf), "is_attack")


@query(
    "resolve_contamination",
    with_views(
        """SELECT least(greatest(avg(CAST(label <> 'BENIGN' AS DOUBLE)), 0.001::DOUBLE), 0.5::DOUBLE) AS contamination
           FROM flows""",
        "flows",
    ),
)
def resolve_contamination(spark: SparkSession, sf: str) -> DataFrame:
    return fitting.contamination(targets(spark, sf), "is_attack")


_scores = ("anomaly_score", "attack_proba", "text_proba")


@query(
    "minmax_average",
    with_views(
        "SELECT event_id, round(("
        + " + ".join(f"({c} - lo_{c}) / CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE hi_{c} - lo_{c} END" for c in _scores)
        + ") / 3, 6) AS average FROM scores3, bounds",
        "scores3",
        bounds="SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _scores) + " FROM scores3",
    ),
)
def minmax_average(spark: SparkSession, sf: str) -> DataFrame:
    out = fitting.minmax_average(views.scores3(spark, sf), _scores)
    return out.select("event_id", F.round("average", 6).alias("average"))
