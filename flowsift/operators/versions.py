"""Model versions and aliases as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_version(versions: DataFrame) -> DataFrame:
    """(name, latest): highest version as a number, not as text."""
    return versions.groupBy("name").agg(
        F.max(F.col("version").cast("string").try_cast("bigint")).alias("latest")
    )


def promote(
    aliases: DataFrame, versions: DataFrame, name: str, version: int | None = None, alias: str = "production"
) -> DataFrame:
    """New alias table with ``alias`` of ``name`` pointing at the version, by default the latest."""
    if version is None:
        row = latest_version(versions.where(F.col("name") == name)).first()
        if row is None or row["latest"] is None:
            raise ValueError(f"model {name!r} has no registered version")
        version = row["latest"]
    kept = aliases.where(~(F.col("name").eqNullSafe(name) & F.col("alias").eqNullSafe(alias)))
    entry = aliases.sparkSession.createDataFrame(
        [(name, alias, int(version))], "name string, alias string, version bigint"
    )
    return kept.select("name", "alias", F.col("version").cast("bigint").alias("version")).unionByName(entry)


def promote_latest(aliases: DataFrame, versions: DataFrame, alias: str = "production") -> DataFrame:
    """Point ``alias`` of every registered model at its latest version; other aliases stay."""
    fresh = latest_version(versions).select(
        "name", F.lit(alias).alias("alias"), F.col("latest").alias("version")
    )
    kept = aliases.join(fresh.select("name", "alias"), ["name", "alias"], "left_anti")
    return kept.select("name", "alias", F.col("version").cast("bigint").alias("version")).unionByName(fresh)


def resolve(models: DataFrame, aliases: DataFrame, alias: str = "production") -> DataFrame:
    """(name, version) for every known model, NULL where the alias is not set."""
    pointed = aliases.where(F.col("alias") == alias).select("name", F.col("version").cast("bigint").alias("version"))
    return models.select("name").distinct().join(pointed, "name", "left")
