"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.catalog import query
from flowsift.catalog.sql import split_of, with_views
from flowsift.operators.clean import inf_to_null
from flowsift.operators.fitting import Preprocessor
from flowsift.operators.sampling import stratified_split
from flowsift.operators.vocab import build_vocabulary
from flowsift.session import scratch_dir, stage
from flowsift.sources import flows as scan
from flowsift.sources import tables, views
from flowsift.sources.views import FLOW_COLS, FLOW_KEYS

SUMMARY_SQL = """
    SELECT label, count(*) AS n_rows, round(sum(bytes), 2) AS sum_bytes,
           CAST(sum(CASE WHEN isinf(byte_rate) THEN 1 ELSE 0 END) AS BIGINT) AS inf_rates,
           CAST(sum(CASE WHEN isnan(packet_rate) THEN 1 ELSE 0 END) AS BIGINT) AS nan_rates
    FROM flows GROUP BY label"""


def summary(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.sum("bytes"), 2).alias("sum_bytes"),
        F.count_if(F.abs("byte_rate") == float("inf")).alias("inf_rates"),
        F.count_if(F.isnan("packet_rate")).alias("nan_rates"),
    )


@query("scan_flows_parquet", with_views(SUMMARY_SQL, "flows"))
def scan_flows_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "scan") + "/flows.parquet"
    tables.write_table(views.flows(spark, sf), path)
    return summary(scan.read_flows(spark, path, FLOW_COLS), "Label")


@query("scan_flows_csv", with_views(SUMMARY_SQL, "flows"))
def scan_flows_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Header names padded with blanks, as flow exporters write them."""
    path = scratch_dir(spark, "scan") + "/flows.csv"
    wide = views.flows(spark, sf)
    wide.toDF(*[f" {c}" for c in wide.columns]).write.option("header", True).csv(path)
    return summary(scan.read_flows(spark, path, FLOW_COLS), "Label")


@query(
    "scan_csv_dir_union",
    with_views(
        SUMMARY_SQL.replace("isnan(packet_rate)", "label = 'BENIGN' AND isnan(packet_rate)"),
        "flows",
    ),
)
def scan_csv_dir_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two layouts in one folder: attack files have another order and lack the packet rate."""
    path = scratch_dir(spark, "scan")
    base = views.flows(spark, sf)
    benign = base.where(F.col("label") == "BENIGN")
    attacks = base.where(F.col("label") != "BENIGN").select(*reversed([*FLOW_COLS[:-1], "label"]))
    for df in (benign, attacks):
        df.write.mode("append").option("header", True).csv(path)
    return summary(scan.read_flows(spark, path, FLOW_COLS), "Label")


_faults = """CASE o_key % 50 WHEN 0 THEN 'too few cells' WHEN 1 THEN 'too many cells' WHEN 2 THEN 'unclosed quote' ELSE 'read' END"""


@query(
    "scan_csv_rejects",
    with_views(
        f"""SELECT {_faults} AS outcome, count(*) AS n_rows, CASE WHEN outcome = 'read' THEN CAST(sum(port) AS BIGINT) END AS ports
            FROM (SELECT {FLOW_KEYS[0]} AS o_key, port FROM flows) GROUP BY 1""",
        "flows",
    ),
)
def scan_csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Flows as lines of text, some cut short, some with a cell too many, some with an open quote."""
    path = scratch_dir(spark, "scan")
    wide, turn = views.flows(spark, sf), F.col(FLOW_KEYS[0]) % 50
    names = [*FLOW_COLS, "label"]
    cells = [F.col(c).cast("string") for c in names]
    line = (
        F.when(turn == 0, F.concat_ws(",", *cells[:-1]))
        .when(turn == 1, F.concat_ws(",", *cells, F.lit("9")))
        .when(turn == 2, F.concat_ws(",", *cells[:-1], F.concat(F.lit('"'), cells[-1])))
        .otherwise(F.concat_ws(",", *cells))
    )
    wide.select(line.alias(",".join(names))).write.option("header", True).option("quote", "").option("sep", "\x01").csv(path)
    flows, rejects = scan.read_flows_checked(spark, path, FLOW_COLS)
    read = flows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("port").cast("bigint").alias("ports"))
    bad = rejects.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("bigint").alias("ports"))
    return read.select(F.lit("read").alias("outcome"), "n_rows", "ports").unionByName(bad)


@query(
    "scan_payloads",
    with_views(
        "SELECT label, count(*) AS n_rows, CAST(sum(length(payload)) AS BIGINT) AS chars FROM payloads GROUP BY label",
        "payloads",
    ),
)
def scan_payloads(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "scan") + "/payloads.parquet"
    tables.write_table(views.payloads(spark, sf), path)
    return (
        scan.read_payloads(spark, path)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.char_length("payload")).alias("chars"))
    )


@query("sink_parquet", with_views(SUMMARY_SQL, "flows"))
def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "sink")
    df = views.flows(spark, sf)
    tables.write_table(df, path)
    tables.write_table(df, path)
    return summary(spark.read.parquet(path))


@query(
    "materialize_if_absent",
    with_views(
        """SELECT t.step, t.status, n.n_rows
           FROM (VALUES ('first', 'written'), ('again', 'kept'), ('forced', 'written'), ('beside_csv', 'csv_present'))
                AS t(step, status),
                (SELECT count(*) AS n_rows FROM flows) AS n""",
        "flows",
    ),
)
def materialize_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "materialize")
    path, real = f"{root}/flows", f"{root}/real"

    def make() -> DataFrame:
        return views.flows(spark, sf)

    views.table(spark, sf, "nation").write.option("header", True).csv(real)
    steps = [
        ("first", tables.materialize(spark, make, path)),
        ("again", tables.materialize(spark, make, path)),
        ("forced", tables.materialize(spark, make, path, force=True)),
        ("beside_csv", tables.materialize(spark, make, path, force=True, csv_folder=real)),
    ]
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))
    named = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(r).alias("status")) for s, r in steps])
    return rows.select(F.inline(named), "n_rows")


@query(
    "scan_split",
    with_views(
        """SELECT label, count(*) AS n_rows, round(sum(bytes), 2) AS sum_bytes
           FROM parts WHERE split = 'train' GROUP BY label""",
        "folded",
        parts=split_of("folded"),
    ),
)
def scan_split(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "splits")
    folded = stage(inf_to_null(views.flows(spark, sf), FLOW_COLS), "folded")
    parts = stratified_split(folded, ["label"], FLOW_KEYS, 0.2, 0.1, 42)
    parts.write.option("compression", "zstd").partitionBy("split").parquet(path)
    train = scan.read_split(spark, path, "train", ["label", "bytes"])
    return train.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("bytes"), 2).alias("sum_bytes")
    )


_fits = " UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS feature, round(median({c}), 3) AS fill,
               round(avg(coalesce({c}, m{i})), 3) AS center, round(stddev_pop(coalesce({c}, m{i})), 3) AS scale
        FROM folded, fills"""
    for i, c in enumerate(FLOW_COLS)
)


@query(
    "sink_params",
    with_views(
        _fits,
        "folded",
        fills="SELECT " + ", ".join(f"median({c}) AS m{i}" for i, c in enumerate(FLOW_COLS)) + " FROM folded",
    ),
)
def sink_params(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "params")
    tables.save_params(Preprocessor(tuple(FLOW_COLS)).fit(stage(views.flows(spark, sf).select(*FLOW_COLS), "flows")), spark, path)
    table = tables.load_params(spark, path).to_table(spark)
    return table.select("position", "feature", *[F.round(c, 3).alias(c) for c in ("fill", "center", "scale")])


VOCAB_SQL = """
    SELECT token, freq, CAST(row_number() OVER (ORDER BY freq DESC, token) + 1 AS INTEGER) AS id FROM (
        SELECT token, count(*) AS freq
        FROM (SELECT unnest(string_split(lower(payload), '')) AS token FROM payloads) GROUP BY token)"""


@query("sink_vocab", with_views(VOCAB_SQL, "payloads"))
def sink_vocab(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "vocab")
    tables.save_vocab(build_vocabulary(views.payloads(spark, sf), "payload"), path)
    return tables.load_vocab(spark, path)


@query(
    "sink_run_metrics",
    with_views(
        """SELECT run_id, kind, name, step, value FROM (
             SELECT 'a' AS run_id, 'param' AS kind, 'seed' AS name, CAST(NULL AS INTEGER) AS step, '42' AS value
             UNION ALL SELECT 'b', 'param', 'seed', NULL, '43'
             UNION ALL SELECT r, 'metric', 'rows', NULL, CAST(n AS VARCHAR) || '.0'
                       FROM (SELECT count(*) AS n FROM flows), (VALUES ('a'), ('b')) AS t(r)
             UNION ALL SELECT 'a', 'series', 'class_rows', CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER),
                              CAST(n AS VARCHAR) || '.0'
                       FROM (SELECT label, count(*) AS n FROM flows GROUP BY label)
             UNION ALL SELECT 'b', 'tag', 'beats_baseline', NULL, 'True')""",
        "flows",
    ),
)
def sink_run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "runs")
    per_class = views.flows(spark, sf).groupBy("label").count().orderBy(F.desc("count"), "label").collect()
    total = sum(r["count"] for r in per_class)
    series = {"class_rows": [r["count"] for r in per_class]}
    tables.append_run(spark, path, "a", {"seed": 42}, {"rows": total}, series)
    tables.append_run(spark, path, "b", {"seed": 43}, {"rows": total}, tags={"beats_baseline": True})
    return tables.read_runs(spark, path)


