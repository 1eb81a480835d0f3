"""Sinks: datasets, fitted parameters, vocabularies and run records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from flowsift.operators.fitting import Preprocessor
from flowsift.sources.flows import list_files

VOCAB_SCHEMA = "token string, freq bigint, id int"
RUN_SCHEMA = "run_id string, kind string, name string, step int, value string"


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Replace a parquet dataset."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or "") or "UNABLE_TO_INFER_SCHEMA" in (e.getCondition() or ""):
            return False
        raise
    return True


def materialize(
    spark: SparkSession,
    make: Callable[[], DataFrame],
    path: str,
    force: bool = False,
    csv_folder: str | None = None,
) -> str:
    """Write ``make()`` unless the dataset exists; ``force`` rewrites it.

    Returns what was done: written, kept, or csv_present. CSV input in ``csv_folder`` is real data
    and is never replaced, not even with ``force``.
    """
    if csv_folder is not None:
        try:
            present = bool(list_files(spark, csv_folder, "*.csv"))
        except AnalysisException:
            present = False
        if present:
            return "csv_present"
    if not force and table_exists(spark, path):
        return "kept"
    make().write.mode("overwrite" if force else "ignore").parquet(path)
    return "written"


def save_params(pre: Preprocessor, spark: SparkSession, path: str) -> str:
    return write_table(pre.to_table(spark), path)


def load_params(spark: SparkSession, path: str) -> Preprocessor:
    """Raises when the stored version is not the current one."""
    return Preprocessor.from_table(spark.read.parquet(path))


def save_vocab(vocab: DataFrame, path: str) -> str:
    vocab.select("token", "freq", "id").write.mode("overwrite").json(path)
    return path


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOCAB_SCHEMA).json(path)


def append_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
    series: Mapping[str, Sequence[float]] | None = None,
    tags: Mapping[str, object] | None = None,
) -> str:
    """Append one run's parameters, metrics, per-step series and tags to the run table."""
    rows = [(run_id, "param", k, None, str(v)) for k, v in (params or {}).items()]
    rows += [(run_id, "metric", k, None, repr(float(v))) for k, v in (metrics or {}).items()]
    rows += [
        (run_id, "series", k, i, repr(float(v)))
        for k, values in (series or {}).items()
        for i, v in enumerate(values)
    ]
    rows += [(run_id, "tag", k, None, str(v)) for k, v in (tags or {}).items()]
    spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)
