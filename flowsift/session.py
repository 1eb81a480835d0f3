"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "flowsift") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """Fresh folder below the shared ``spark.checkpoint.dir``.

    Only a local master may fall back to the machine's temporary folder: on a cluster the
    executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _local_scratch(spark)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_folders: dict[str, str] = {}


def _local_scratch(spark: SparkSession) -> str:
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _folders:
        _folders[context.applicationId] = tempfile.mkdtemp(prefix="flowsift-")
    return _folders[context.applicationId]


def stage(df: DataFrame, purpose: str, partition_by: str | None = None, vectors: Sequence[str] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Used where several later jobs read the same intermediate result. The written table cuts the
    lineage, survives lost executors and keeps column pruning and filter pushdown for its readers.
    Its files are packed with zstd, which takes fewer bytes than the default. ``vectors`` are columns of a vector's struct that are read as vectors.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    fields = [T.StructField(f.name, VectorUDT()) if f.name in vectors else f for f in df.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)
