"""Splits, folds, samples and label-driven transformations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.catalog import query
from flowsift.catalog.sql import (
    commas,
    draw_key,
    index_draw,
    split_of,
    text,
    unit_draw,
    with_views,
)
from flowsift.functions.labels import binary_target
from flowsift.functions.numeric import INF
from flowsift.operators import sampling
from flowsift.operators.clean import inf_to_null
from flowsift.session import stage
from flowsift.sources import views
from flowsift.sources.views import FLOW_COLS, FLOW_KEYS, SIGNAL_COLS

KEYS = commas(FLOW_KEYS)
SEED = 42


def flows_once(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Columns of the flows, written once: the join behind them is not repeated by every pass over keys."""
    return stage(views.flows(spark, sf).select(*columns), "flows")


def split_flows(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_split(flows_once(spark, sf, *FLOW_KEYS, "label"), ["label"], FLOW_KEYS, 0.2, 0.1, SEED)


@query("union_rows", with_views(f"SELECT {KEYS}, bytes FROM flows UNION ALL SELECT {KEYS}, bytes FROM flows_dup", "flows_dup"))
def union_rows(spark: SparkSession, sf: str) -> DataFrame:
    slim = [df.select(*FLOW_KEYS, "bytes") for df in (views.flows(spark, sf), views.flows_dup(spark, sf))]
    return sampling.union_all([slim[0], slim[1].select("bytes", *FLOW_KEYS)])


@query("stratified_split3", with_views(f"SELECT {KEYS}, label, split FROM parts", "flows", parts=split_of("flows")))
def stratified_split3(spark: SparkSession, sf: str) -> DataFrame:
    return split_flows(spark, sf).select(*FLOW_KEYS, "label", "split")


@query(
    "random_split3",
    with_views(
        f"""SELECT {KEYS}, CASE WHEN u < 0.2::DOUBLE THEN 'test' WHEN u < 0.2::DOUBLE + 0.1::DOUBLE THEN 'val'
                                ELSE 'train' END AS split
            FROM (SELECT *, {unit_draw(FLOW_KEYS, SEED)} AS u FROM flows)""",
        "flows",
    ),
)
def random_split3(spark: SparkSession, sf: str) -> DataFrame:
    parts = sampling.stratified_split(views.flows(spark, sf), None, FLOW_KEYS, 0.2, 0.1, SEED)
    return parts.select(*FLOW_KEYS, "split")


@query(
    "split_counts",
    with_views(
        """SELECT 'flows' AS modality, split, label, count(*) AS rows FROM fparts GROUP BY split, label
           UNION ALL SELECT 'payloads', split, CAST(label AS VARCHAR), count(*) FROM tparts GROUP BY split, label""",
        "flows",
        "payloads",
        fparts=split_of("flows"),
        tparts=split_of("payloads", keys=["doc_id"]),
    ),
)
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    texts = sampling.stratified_split(
        views.payloads(spark, sf).select("doc_id", "label"), ["label"], ["doc_id"], 0.2, 0.1, SEED
    )
    counted = [
        sampling.split_counts(df.withColumn("label", F.col("label").cast("string")), "split", "label").select(
            F.lit(name).alias("modality"), "split", "label", "rows"
        )
        for name, df in (("flows", split_flows(spark, sf)), ("payloads", texts))
    ]
    return counted[0].unionByName(counted[1])


@query(
    "stratified_kfold",
    with_views(
        f"""SELECT {KEYS}, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {draw_key(FLOW_KEYS, SEED)}) - 1) % 5
                   AS INTEGER) AS fold FROM flows""",
        "flows",
    ),
)
def stratified_kfold(spark: SparkSession, sf: str) -> DataFrame:
    flows = flows_once(spark, sf, *FLOW_KEYS, "label")
    return sampling.kfold(flows, "label", FLOW_KEYS, 5, SEED)


@query(
    "sample_with_replacement",
    with_views(
        f"""SELECT {KEYS}, count(*) AS times
            FROM numbered JOIN (SELECT {index_draw(['i'], 'SELECT count(*) FROM flows', SEED, 'pick')} + 1 AS number
                                FROM range((SELECT count(*) // 50 FROM flows)) AS r(i)) USING (number)
            GROUP BY {KEYS}""",
        "flows",
        numbered=f"SELECT {KEYS}, row_number() OVER (ORDER BY {draw_key(FLOW_KEYS, SEED)}) AS number FROM flows",
    ),
)
def sample_with_replacement(spark: SparkSession, sf: str) -> DataFrame:
    flows = flows_once(spark, sf, *FLOW_KEYS)
    drawn = sampling.draw_rows(flows, FLOW_KEYS, flows.count() // 50, SEED)
    return drawn.groupBy(*FLOW_KEYS).agg(F.count(F.lit(1)).alias("times"))


MIX = {"BENIGN": 0.6, "DoS": 0.2, "PortScan": 0.15, "Botnet": 0.05}
_shares = ", ".join(f"({text(k)}, {v}::DOUBLE)" for k, v in MIX.items())


@query(
    "resample_to_mix",
    with_views(
        f"""SELECT {KEYS}, label FROM (
              SELECT *, row_number() OVER (PARTITION BY label ORDER BY {draw_key(FLOW_KEYS, SEED)}) AS rk FROM flows)
            JOIN quotas USING (label) WHERE rk <= quota""",
        "flows",
        goal="SELECT count(*) // 3 AS goal FROM flows",
        floors=f"""SELECT label, share, goal, floor(share / sum(share) OVER () * goal) AS f
                   FROM (VALUES {_shares}) AS t(label, share), goal""",
        quotas="""SELECT label, f + CASE WHEN label = 'BENIGN' THEN goal - sum(f) OVER () ELSE 0 END AS quota FROM floors""",
    ),
)
def resample_to_mix(spark: SparkSession, sf: str) -> DataFrame:
    flows = flows_once(spark, sf, *FLOW_KEYS, "label")
    return sampling.resample_to_mix(flows, "label", MIX, flows.count() // 3, FLOW_KEYS, SEED)


_PROBED = ["bytes", "duration", "total_price"]


@query(
    "corrupt_cells",
    with_views(
        f"SELECT {KEYS}, "
        + ", ".join(
            f"CASE WHEN r_{c} <= floor(floor(n * 0.01::DOUBLE) / 2) THEN 'inf' WHEN r_{c} <= floor(n * 0.01::DOUBLE) "
            f"THEN 'nan' ELSE 'ok' END AS {c}_state"
            for c in _PROBED
        )
        + " FROM ranked",
        "flows",
        ranked="SELECT *, count(*) OVER () AS n, "
        + ", ".join(f"row_number() OVER (ORDER BY {draw_key(FLOW_KEYS, SEED, c)}) AS r_{c}" for c in _PROBED)
        + " FROM flows",
    ),
)
def corrupt_cells(spark: SparkSession, sf: str) -> DataFrame:
    bad = sampling.corrupt_cells(flows_once(spark, sf, *FLOW_KEYS, *_PROBED), _PROBED, 0.01, FLOW_KEYS, SEED)
    return bad.select(
        *FLOW_KEYS,
        *[
            F.when(F.isnan(c), "nan").when(F.col(c) == INF, "inf").otherwise("ok").alias(f"{c}_state")
            for c in _PROBED
        ],
    )


@query(
    "scale_by_class",
    with_views(
        f"SELECT {commas(FLOW_KEYS, 'flows.')}, label, "
        + ", ".join(
            f"CASE WHEN isfinite(flows.{c}) THEN flows.{c} END * (profile.{c} * "
            f"CASE WHEN label = 'BENIGN' THEN 1::DOUBLE ELSE 1.5::DOUBLE END) AS {c}"
            for c in SIGNAL_COLS
        )
        + " FROM flows LEFT JOIN profile ON class = label",
        "flows",
        "profile",
    ),
)
def scale_by_class(spark: SparkSession, sf: str) -> DataFrame:
    scaled = sampling.scale_by_class(
        inf_to_null(views.flows(spark, sf), FLOW_COLS), "label", views.class_profile(spark), drift=1.5
    )
    return scaled.select(*FLOW_KEYS, "label", *SIGNAL_COLS)


@query(
    "pair_by_label",
    with_views(
        f"""SELECT {KEYS}, is_attack, pool_label, doc_id FROM drawn JOIN pool USING (pool_label, number)""",
        "flows",
        "payloads",
        pool=f"""SELECT doc_id, label AS pool_label, row_number() OVER (PARTITION BY label ORDER BY
                 {draw_key(['doc_id'], SEED, 'pool')}) AS number FROM payloads""",
        sizes="SELECT pool_label, count(*) AS size FROM pool GROUP BY pool_label",
        choice=f"""SELECT {KEYS}, CAST(label <> 'BENIGN' AS INTEGER) AS is_attack,
                   CAST({unit_draw(FLOW_KEYS, SEED, 'pool')} < CASE WHEN label <> 'BENIGN' THEN 0.7::DOUBLE ELSE 0.03::DOUBLE END
                        AS BIGINT) AS pool_label FROM flows""",
        drawn=f"""SELECT choice.*, {index_draw(FLOW_KEYS, 'size', SEED, 'number')} + 1 AS number
                  FROM choice JOIN sizes USING (pool_label)""",
    ),
)
def pair_by_label(spark: SparkSession, sf: str) -> DataFrame:
    flows = views.flows(spark, sf).select(*FLOW_KEYS, binary_target(F.col("label")).alias("is_attack"))
    texts = views.payloads(spark, sf).select("doc_id", F.col("label").alias("pool_label"))
    return sampling.pair_payloads(
        flows, FLOW_KEYS, "is_attack", texts, ["doc_id"], "pool_label", 0.7, 0.03, SEED
    )


