"""Model versions and their scores: append-only tables plus the nested metadata file."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from keeprate.functions.columns import next_version, version_number
from keeprate.schema import VERSION_SCHEMA

FIRST_VERSION = "1.0"


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Version metadata documents; parts absent in older files are null."""
    return spark.read.schema(VERSION_SCHEMA).json(path, multiLine=True)


def history(metadata: DataFrame) -> DataFrame:
    """(version, timestamp) of every entry of the history."""
    return metadata.select(F.inline("version_history"))


def scores(metadata: DataFrame) -> DataFrame:
    """(version, metric, value, ts) of every score."""
    return (
        metadata.select(F.explode("version_scores").alias("version", "entry"))
        .select("version", F.col("entry.evaluation_date").alias("ts"), F.explode("entry.scores").alias("metric", "value"))
        .select("version", "metric", "value", "ts")
    )


def append_rows(df: DataFrame, path: str) -> None:
    """Adds rows to a version or score table; nothing is rewritten."""
    df.write.mode("append").parquet(path)


def latest_scores(scores: DataFrame) -> DataFrame:
    """Last value per version and metric. An aggregate, so repeats merge before the shuffle."""
    return scores.groupBy("version", "metric").agg(
        F.max_by("value", F.struct("ts", "value")).alias("value"), F.max("ts").alias("ts")
    )


def score_report(scores: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """One row per version, one column per metric, in version order."""
    wide = latest_scores(scores).groupBy("version").pivot("metric", metrics).agg(F.first("value"))
    return wide.orderBy(version_number("version"), "version")


def list_versions(rows: DataFrame) -> DataFrame:
    """Distinct versions ordered by number, so 1.10 follows 1.9."""
    return rows.select("version").distinct().orderBy(version_number("version"), "version")


def versions_in_names(names: DataFrame, column: str = "name") -> DataFrame:
    """Versions from snapshot names ``v1.2``; other names are left out."""
    return list_versions(
        names.filter(F.col(column).startswith("v")).select(F.expr(f"substring({column}, 2)").alias("version"))
    )


def current_version(rows: DataFrame) -> DataFrame:
    """One row: the highest version, ``1.0`` when there is none."""
    return rows.agg(
        F.coalesce(F.max_by("version", F.struct(version_number("version"), "version")), F.lit(FIRST_VERSION))
        .alias("version")
    )


def following_version(rows: DataFrame) -> DataFrame:
    return current_version(rows).select("version", next_version("version").alias("next_version"))


def snapshot(model: PipelineModel, version_rows: DataFrame, folder: str, version: str) -> None:
    """Saves all stages of a model under its version and records the version."""
    model.write().overwrite().save(f"{folder}/versions/v{version}/model")
    append_rows(version_rows.filter(F.col("version") == version), f"{folder}/history")
