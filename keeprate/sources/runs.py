"""Run tables read from tracker folders: ``RUN/metrics/NAME`` and ``RUN/params/NAME``.

The same layout in partition-folder form (``run_id=RUN/kind=metrics/name=NAME``) is
what the writers here produce, and is read back by the same scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Where run, kind and name stand in a path.
PATH_PATTERN = r"(?:run_id=)?([^/]+)/(?:kind=)?(?:metrics|params)/(?:name=)?([^/]+)"


def _path_part(group: int) -> Column:
    return F.url_decode(F.regexp_extract("_metadata.file_path", PATH_PATTERN, group))


def _text(spark: SparkSession, path: str, kind: str, whole: bool) -> DataFrame:
    return (
        spark.read.option("recursiveFileLookup", True).option("wholetext", whole).text(path)
        .filter(F.col("_metadata.file_path").rlike(f"/(kind=)?{kind}/"))
        .select(_path_part(1).alias("run_id"), _path_part(2).alias("name"), "value")
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, name, ts, value, step) from lines ``epoch_ms value step``."""
    parts = F.split("value", " ")
    return _text(spark, path, "metrics", whole=False).select(
        "run_id", "name",
        F.timestamp_millis(F.get(parts, F.lit(0)).cast("long")).alias("ts"),
        F.get(parts, F.lit(1)).cast("double").alias("value"),
        F.get(parts, F.lit(2)).cast("int").alias("step"),
    )


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, name, value); a file holds one value."""
    return _text(spark, path, "params", whole=True).withColumn("value", F.rtrim("value"))


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Writes (run_id, name, ts, value, step) as metric lines, one folder per run and name."""
    (
        metrics.select(
            "run_id", F.lit("metrics").alias("kind"), "name",
            F.concat_ws(" ", F.unix_millis(F.col("ts").cast("timestamp")), F.col("value").cast("string"), "step")
            .alias("value"),
        )
        .hint("rebalance", "run_id", "name")
        .write.partitionBy("run_id", "kind", "name").mode("overwrite").text(path)
    )


def write_params(params: DataFrame, path: str) -> None:
    """Writes (run_id, name, value), one file per parameter."""
    (
        params.select("run_id", F.lit("params").alias("kind"), "name", F.col("value").cast("string").alias("value"))
        .repartition("run_id", "name")
        .write.partitionBy("run_id", "kind", "name").mode("overwrite").text(path)
    )


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """One row per run and name: a metric logged more than once keeps its last value."""
    return metrics.groupBy("run_id", "name").agg(
        F.max_by("value", F.struct("ts", "step", "value")).alias("value"),
        F.count(F.lit(1)).alias("points"),
    )
