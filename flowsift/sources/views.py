"""Security views over the given tables: flows, payloads, events and scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.functions.labels import binary_target
from flowsift.schema import BENIGN, FLOW_FEATURES, LABELS, event_schema

FLOW_KEYS = ["k_order", "k_part", "k_supp", "k_line", "k_cents"]
FLOW_COLS = [
    "port",
    "duration",
    "bytes",
    "discount",
    "tax",
    "total_price",
    "supplier",
    "line_no",
    "byte_rate",
    "packet_rate",
]
# Columns that the class profile scales.
SIGNAL_COLS = ["duration", "bytes", "byte_rate", "supplier", "port", "total_price"]

# Granular label spellings per class, chosen by supplier.
RAW_LABELS = [
    ("BENIGN", ["BENIGN", " benign ", "Benign", "", None]),
    ("DoS", ["DoS Hulk", "DoS GoldenEye", " dos slowloris", "Slow read", "DOS"]),
    ("DDoS", ["DDoS", " ddos ", "DDoS LOIT", "DDOS HOIC", "ddos-udp"]),
    ("PortScan", ["PortScan", "Port Scan", "portscan ", "PORT SCAN tcp", "PortScan-S"]),
    ("Brute Force", ["FTP-Patator", "SSH-Patator", "Web Attack - Brute Force", "brute", "Brute Force "]),
    ("Web Attack", ["Web Attack - XSS", "Sql Injection", "xss", "WEB ATTACK", "web attack sqli"]),
    ("Botnet", ["Bot", "botnet", "BOT ARES", " Bot", "Botnet IRC"]),
    ("Infiltration", ["Infiltration", "Heartbleed", "infiltration - cool", "HEARTBLEED", " Infiltration"]),
]

# (command, malicious): seven of twenty hold a signature.
COMMANDS = [
    ("tar -czf nightly.tgz ./site", 0),
    ("1' UNION  SELECT card FROM clients", 1),
    ("kubectl get pods -n web", 0),
    ("make test && make lint", 0),
    ("ping -c 3 10.0.0.7; nc 10.9.8.7 4444", 1),
    ("rsync -a ./docs backup:/srv/docs", 0),
    ("GET /health?verbose=1 HTTP/1.1", 0),
    ("open ../../../secrets.txt", 1),
    ("journalctl -u web --since today", 0),
    ("SELECT count(id) FROM invoices", 0),
    ("<ScRiPt>alert(9)</script>", 1),
    ("uptime", 0),
    ("grep -n error app.log", 0),
    ("cat /etc/shadow", 1),
    ("vim notes.md", 0),
    ("npm run build", 0),
    ("powershell  -enc SQBFAFgA", 1),
    ("df -i /data", 0),
    ("echo `id` $(whoami)", 1),
    ("terraform plan -out next", 0),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choice(values: list[object], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as flows: five key columns, ten features (two rates with bad cells), a label."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    share = F.col("l_partkey") % 100
    label = (
        F.when(share < 75, "BENIGN")
        .when(share < 84, "DoS")
        .when(share < 90, "DDoS")
        .when(share < 95, "PortScan")
        .when(share < 97, "Brute Force")
        .when(share < 98, "Web Attack")
        .when(share < 99, "Botnet")
        .otherwise("Infiltration")
    )
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    return lines.select(
        F.col("l_orderkey").alias("k_order"),
        F.col("l_partkey").alias("k_part"),
        F.col("l_suppkey").alias("k_supp"),
        F.col("l_linenumber").cast("bigint").alias("k_line"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("k_cents"),
        (F.col("l_partkey") % 65535).cast("double").alias("port"),
        F.col("l_quantity").alias("duration"),
        F.col("l_extendedprice").alias("bytes"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("o_totalprice").alias("total_price"),
        F.col("l_suppkey").cast("double").alias("supplier"),
        F.col("l_linenumber").cast("double").alias("line_no"),
        F.when(F.col("l_discount") == 0, inf)
        .otherwise(F.try_divide("l_extendedprice", "l_discount"))
        .alias("byte_rate"),
        F.when(F.col("l_tax") == 0, nan).otherwise(F.try_divide("l_quantity", "l_tax")).alias("packet_rate"),
        label.alias("label"),
    )


# Columns that the full feature table repeats in turn.
WIDE_FROM = ["duration", "bytes", "total_price", "supplier", "port"]


def wide_flows(spark: SparkSession, sf_dir: str, stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """The flow keys and all features by name: multiples of the view's columns, each with some NULLs.

    With ``stage``, the few columns they are made of are written once for several readers.
    """
    base = flows(spark, sf_dir).select(*FLOW_KEYS, *WIDE_FROM)
    base = base if stage is None else stage(base, "wide-flows")
    cells = [
        F.when((F.col("k_part") + i) % 13 != 0, F.col(WIDE_FROM[i % len(WIDE_FROM)]) * (i % 9 + 1)).alias(name)
        for i, name in enumerate(FLOW_FEATURES)
    ]
    return base.select(*FLOW_KEYS, *cells)


def flows_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flows, and those without a discount a second time; copied after the join, which is made once."""
    copies = F.when(F.col("discount") == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return flows(spark, sf_dir).withColumn("__copy", F.explode(copies)).drop("__copy")


def raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = flows(spark, sf_dir)
    raw = F.lit(None).cast("string")
    for cls, spellings in RAW_LABELS:
        raw = F.when(F.col("label") == cls, _choice(spellings, F.col("k_supp") % len(spellings))).otherwise(raw)
    return base.withColumn("raw_label", raw)


def class_factor(cls: str, column: str) -> float:
    """Factor of the view's profile: 1 for benign flows, quarters from 0.5 to 2.25 for the others, by position."""
    if cls == BENIGN:
        return 1.0
    return 0.5 + 0.25 * ((3 * LABELS.index(cls) + 5 * SIGNAL_COLS.index(column)) % 8)


def class_profile(spark: SparkSession) -> DataFrame:
    """(class, feature, factor) for the view's signal columns."""
    rows = [(cls, c, class_factor(cls, c)) for cls in LABELS for c in SIGNAL_COLS]
    return spark.createDataFrame(rows, "class string, feature string, factor double")


def commands(index: Column) -> Column:
    return _choice([c for c, _ in COMMANDS], index)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as payloads: a short command, then the whole text."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    pick = F.col("doc_id") % len(COMMANDS)
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.concat_ws(" ", commands(pick), F.col("text")).alias("payload"),
        _choice([m for _, m in COMMANDS], pick).cast("bigint").alias("label"),
        "lang",
        "source",
    )


def event_number() -> Column:
    """The integer ``k`` of the JSON properties."""
    return F.from_json("props", "k INT")["k"]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored rows: truth, score with ties, true and predicted class."""
    truth = (
        F.when(F.col("event_type") == "error", "DoS")
        .when(F.col("event_type") == "purchase", "PortScan")
        .otherwise("BENIGN")
    )
    predicted = (
        F.when(F.col("value") > 60, "DoS").when(event_number() > 70, "PortScan").otherwise("BENIGN")
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        (F.col("event_type") == "error").cast("int").alias("y"),
        (F.col("value") / (F.col("value") + 50)).alias("score"),
        truth.alias("truth"),
        predicted.alias("predicted"),
    )


def scores3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three component scores on different scales, with a binary truth."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        (F.col("event_type") == "error").cast("int").alias("y"),
        (F.col("value") * 1000).alias("anomaly_score"),
        (F.col("value") / (F.col("value") + 50)).alias("attack_proba"),
        (event_number() / F.lit(100.0)).alias("text_proba"),
    )


def events_in_columns() -> list[Column]:
    """Modalities by event type: signup only a payload, view only features, click neither."""
    kind, k = F.col("event_type"), event_number()
    features = F.create_map(
        F.lit("duration"), F.col("value"), F.lit("line_no"), k.cast("double"), F.lit("unlisted"), F.lit(1.0)
    )
    none = F.create_map().cast("map<string,double>")
    return [
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        kind,
        F.when(kind == "click", none).when(kind != "signup", features).alias("features"),
        F.when(~kind.isin("view", "click"), commands(k % len(COMMANDS))).alias("payload"),
    ]


def events_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*events_in_columns())


def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON text; errors arrive truncated."""
    text = F.to_json(F.struct("features", "payload"))
    broken = F.expr("substring(t, 1, length(t) - 1)")
    return (
        events_in(spark, sf_dir)
        .withColumn("t", text)
        .select("event_id", F.when(F.col("event_type") == "error", broken).otherwise(F.col("t")).alias("body"))
    )


def parse_events(df: DataFrame, body: str = "body") -> DataFrame:
    """JSON bodies to features and payload; an unreadable body is kept in ``corrupt``."""
    schema = T.StructType([*event_schema().fields, T.StructField("corrupt", T.StringType())])
    parsed = F.from_json(body, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    return df.withColumn("__e", parsed).select(
        *[c for c in df.columns if c != body], "__e.features", "__e.payload", "__e.corrupt"
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v"), (F.col("label") == 0).cast("int").alias("y")
    )


def latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("endpoint"),
        F.col("value").alias("millis"),
        (F.col("value") / 1000).alias("seconds"),
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as models, sizes as their versions (as text)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("name"), F.col("p_size").cast("string").alias("version")
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest size per brand in production, smallest size of economy parts as staging."""
    part = table(spark, sf_dir, "part")
    small = F.min("p_size").cast("bigint").alias("version")
    production = part.groupBy(F.col("p_brand").alias("name")).agg(small).withColumn("alias", F.lit("production"))
    staging = (
        part.where(F.col("p_type") == "ECONOMY")
        .groupBy(F.col("p_brand").alias("name"))
        .agg(small)
        .withColumn("alias", F.lit("staging"))
    )
    return production.unionByName(staging).select("name", "alias", "version")


def labelled_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with learnable classes: signal columns scaled by class."""
    from flowsift.operators.sampling import scale_by_class

    scaled = scale_by_class(flows(spark, sf_dir), "label", class_profile(spark))
    return scaled.withColumn("is_attack", binary_target(F.col("label")))
