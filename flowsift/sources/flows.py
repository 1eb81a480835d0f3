"""Scans of raw flows, payloads and processed splits."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.functions.labels import normalise_label
from flowsift.operators.columns import normalise_columns, project_canonical
from flowsift.schema import FLOW_FEATURES, IS_ATTACK, LABEL, PAYLOAD, PAYLOAD_LABEL, quoted


def list_files(spark: SparkSession, folder: str, glob: str) -> list[str]:
    """Sorted paths below a folder on any file system Spark can read; contents are not opened."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return sorted(r["path"] for r in listing.select("path").collect())


def _distinct_names(columns: Sequence[str]) -> list[str]:
    """Undo the position suffix Spark gives to repeated headers: the n-th repeat becomes ``name.n``."""
    bases = []
    for i, c in enumerate(columns):
        name = c.strip()
        bases.append(name.removesuffix(str(i)).strip() if name.endswith(str(i)) else None)
    repeated = {b for b in bases if b and bases.count(b) > 1}
    seen: dict[str, int] = defaultdict(int)
    out = []
    for c, base in zip(columns, bases, strict=True):
        if base not in repeated:
            out.append(c.strip())
            continue
        out.append(base if not seen[base] else f"{base}.{seen[base]}")
        seen[base] += 1
    return out


def _read_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(paths)
    return df.toDF(*_distinct_names(df.columns))


def _read_csv_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Union of all CSV files; columns absent from a file become NULL.

    There is one multi-file scan per distinct header, so thousands of files with one layout make a
    single scan.
    """
    parts = [_read_csv(spark, paths) for _, paths in _layouts(spark, _csv_files(spark, folder))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


#: A quoted cell, or a part of one between doubled quotes; and a quote that opens a cell.
QUOTED_PART, OPENING = r'(?<![^,"])"[^"]*+"', r'(?<![^,])"'


def _layouts(spark: SparkSession, files: list[str]) -> list[tuple[str, list[str]]]:
    """Headers and the files that have them, found in one distributed read of their first lines."""
    lines = spark.read.text(files).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    headers = lines.where("start = 0 AND value != ''").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    layouts = headers.groupBy("header").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    return [(r["header"], r["paths"]) for r in layouts.orderBy("header").collect()]


def _csv_files(spark: SparkSession, folder: str) -> list[str]:
    files = list_files(spark, folder, "*.csv")
    if not files:
        raise FileNotFoundError(f"no CSV files in {folder}")
    return files


def _fault(line: Column, cells: int) -> Column:
    """Why a line does not fit a header of so many cells; NULL if it does."""
    outside = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, QUOTED_PART, "")).otherwise(line)
    found = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    return (
        F.when(outside.rlike(OPENING), "unclosed quote")
        .when(found < cells, "too few cells")
        .when(found > cells, "too many cells")
    )


def read_csv_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of a CSV file or a folder of them; every line is in one of the two.

    A line with more or fewer cells than its header, or with a quote that is not closed on it, is
    rejected: ``file, line, reason``. Nothing of it is cut off or filled up silently. Blank lines are no
    lines, and lines equal to the header are headers wherever they stand.
    """
    files = list_files(spark, path, "*") if path.endswith(".csv") else _csv_files(spark, path)
    rows, rejects = [], []
    for header, paths in _layouts(spark, files):
        names = _read_csv(spark, paths).columns
        lines = spark.read.text(paths).withColumn("file", F.col("_metadata.file_path"))
        lines = lines.where((F.col("value") != header) & (F.btrim("value") != ""))
        lines = lines.withColumn("reason", _fault(F.col("value"), len(names)))
        cells = ", ".join(f"c{i} string" for i in range(len(names)))
        parsed = lines.where(F.col("reason").isNull()).select(F.from_csv("value", cells, {"escape": "\""}).alias("cells"))
        rows.append(parsed.select("cells.*").toDF(*names))
        rejects.append(lines.where(F.col("reason").isNotNull()).select("file", F.col("value").alias("line"), "reason"))
    return (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows),
        reduce(DataFrame.unionByName, rejects),
    )


def read_flows_checked(
    spark: SparkSession, path: str, features: Sequence[str] = FLOW_FEATURES
) -> tuple[DataFrame, DataFrame]:
    """Canonical flows of a CSV file or folder, and the lines that are none; see ``read_csv_checked``."""
    rows, rejects = read_csv_checked(spark, path)
    return canonical_flows(rows, features, path), rejects


def canonical_flows(
    df: DataFrame, features: Sequence[str] = FLOW_FEATURES, source: str = "the table"
) -> DataFrame:
    """Typed features and normalised label in canonical order."""
    df = normalise_columns(df)
    try:
        df = project_canonical(df, features)
    except ValueError as e:
        raise ValueError(f"{source}: {e}") from None
    return df.select(
        *[F.col(quoted(c)).try_cast("double").alias(c) for c in features],
        normalise_label(F.col(LABEL).cast("string")).alias(LABEL),
    )


def read_flows(
    spark: SparkSession, path: str, features: Sequence[str] = FLOW_FEATURES, format: str | None = None
) -> DataFrame:
    """Flows from a parquet table, a CSV file or a folder of CSV files.

    ``format`` is parquet, csv or csv_folder; by default it follows the path's suffix.
    """
    if format is None:
        format = "parquet" if path.endswith(".parquet") else "csv" if path.endswith(".csv") else "csv_folder"
    if format == "parquet":
        raw = spark.read.parquet(path)
    elif format == "csv":
        raw = _read_csv(spark, path)
    elif format == "csv_folder":
        raw = _read_csv_folder(spark, path)
    else:
        raise ValueError(f"unknown flow format: {format}")
    return canonical_flows(raw, features, path)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payload corpus: the two required columns only."""
    csv = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    df = spark.read.parquet(path) if path.endswith(".parquet") else csv.csv(path)
    missing = [c for c in (PAYLOAD, PAYLOAD_LABEL) if c not in df.columns]
    if missing:
        raise ValueError(f"{path} must have the columns {PAYLOAD!r} and {PAYLOAD_LABEL!r}")
    return df.select(PAYLOAD, F.col(PAYLOAD_LABEL).try_cast("bigint").alias(PAYLOAD_LABEL))


def read_split(
    spark: SparkSession,
    root: str,
    name: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One processed split, by partition pruning; optionally only some columns."""
    df = spark.read.parquet(root).where(F.col("split") == name).drop("split")
    if columns is None:
        return df
    return df.select(*[F.col(quoted(c)) for c in columns])
