"""The event log: a day-partitioned table with typed fields, an open map, and search."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keeprate.functions.columns import log_day
from keeprate.schema import EVENT_SCHEMA, LOG_SCHEMA

# What an event carries unless it says otherwise.
PROJECT = "keeprate"
LOGGER = "keeprate-jobs"


def as_events(df: DataFrame, extra: dict[str, Column] | None = None, **fields: Column) -> DataFrame:
    """Events from any table: named fields go to typed columns, others to the open map."""
    known = set(EVENT_SCHEMA.fieldNames())
    values = {"project_name": F.lit(PROJECT), "logger_name": F.lit(LOGGER), "level": F.lit("INFO")}
    values |= {k: v for k, v in fields.items() if k in known}
    open_fields = {k: v for k, v in fields.items() if k not in known} | (extra or {})
    if open_fields:
        pairs = [x for k, v in open_fields.items() for x in (F.lit(k), v.cast("string"))]
        values["extra"] = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return df.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields
    ])


def run_start(runs: DataFrame) -> DataFrame:
    """Start events from (ts, run_id, experiment_name, model_type)."""
    return as_events(
        runs, ts=F.col("ts"), run_id=F.col("run_id"), experiment_name=F.col("experiment_name"),
        model_type=F.col("model_type"), stage=F.lit("run_start"),
        message=F.concat(F.lit("run started: "), F.col("run_id").cast("string")),
    )


def run_end(runs: DataFrame) -> DataFrame:
    """End events from (ts, run_id, status)."""
    return as_events(
        runs, ts=F.col("ts"), run_id=F.col("run_id"), stage=F.lit("run_end"), status=F.col("status"),
        message=F.concat_ws(" ", F.lit("run ended:"), F.col("run_id").cast("string"), F.lit("- status:"), "status"),
    )


def param_events(runs: DataFrame) -> DataFrame:
    """One event per entry of (ts, run_id, params map), values as text."""
    entries = runs.select("ts", "run_id", F.explode("params").alias("name", "value"))
    return as_events(
        entries, ts=F.col("ts"), run_id=F.col("run_id"), stage=F.lit("parameters"),
        param_name=F.col("name"), param_value=F.col("value").cast("string"),
        message=F.concat(F.lit("parameter: "), "name", F.lit(" = "), F.col("value").cast("string")),
    )


def metric_events(runs: DataFrame) -> DataFrame:
    """One event per entry of (ts, run_id, metrics map), values as numbers."""
    entries = runs.select("ts", "run_id", F.explode("metrics").alias("name", "value"))
    return as_events(
        entries, ts=F.col("ts"), run_id=F.col("run_id"), stage=F.lit("metrics"),
        metric_name=F.col("name"), metric_value=F.col("value").cast("double"),
        message=F.concat(F.lit("metric: "), "name", F.lit(" = "), F.col("value").cast("string")),
    )


def preparation_events(df: DataFrame) -> DataFrame:
    """Data-preparation events from (ts, run_id, train_samples, test_samples, n_features)."""
    return as_events(
        df, ts=F.col("ts"), run_id=F.col("run_id"), stage=F.lit("data_preparation"),
        message=F.lit("data preparation finished"),
        **{c: F.col(c) for c in ("train_samples", "test_samples", "n_features")},
    )


def training_events(df: DataFrame) -> DataFrame:
    """Training events from (ts, run_id, model_type, duration); a null duration is left out."""
    text = F.concat(F.lit("model training "), F.col("model_type"))
    timed = F.concat(text, F.lit(" - duration: "), F.format_string("%.2fs", F.col("duration")))
    return as_events(
        df, ts=F.col("ts"), run_id=F.col("run_id"), model_type=F.col("model_type"), stage=F.lit("model_training"),
        message=F.when(F.col("duration").isNotNull(), timed).otherwise(text), training_duration=F.col("duration"),
    )


def evaluation_events(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Evaluation events; each metric column becomes ``metric_<name>`` in the open map."""
    return as_events(
        df, ts=F.col("ts"), run_id=F.col("run_id"), model_type=F.col("model_type"), stage=F.lit("model_evaluation"),
        message=F.concat(F.lit("model evaluation finished: "), F.col("model_type")),
        extra={f"metric_{m}": F.col(m) for m in metrics},
    )


def error_events(df: DataFrame) -> DataFrame:
    """Error events from (ts, run_id, message, exception_type, exception_message)."""
    return as_events(
        df, ts=F.col("ts"), run_id=F.col("run_id"), level=F.lit("ERROR"), stage=F.lit("error"),
        message=F.col("message"), exception_type=F.col("exception_type"),
        exception_message=F.col("exception_message"),
    )


def append(events: DataFrame, path: str) -> None:
    """Appends to the day folders.

    The rebalance step gives each day few, even files and splits a day that holds
    much of the data over several tasks. Rows are sorted by run and have a Bloom filter on
    it, so that a search for a run skips the row groups, and mostly the files, without it.
    """
    (
        events.withColumn("log_date", log_day("ts"))
        .hint("rebalance", "log_date")
        .sortWithinPartitions("log_date", "run_id")
        .write.mode("append").partitionBy("log_date")
        .option("parquet.bloom.filter.enabled#run_id", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def field(name: str) -> Column:
    """A typed field, or a key of the open map."""
    return F.col(name) if name in {*EVENT_SCHEMA.fieldNames(), "log_date"} else F.col("extra").getItem(name)


def matching(log: DataFrame, terms: dict | None = None, days: list[str] | None = None) -> DataFrame:
    """Events whose fields equal the given values, on the given days (read only those folders)."""
    conditions = [field(name) == F.lit(value) for name, value in (terms or {}).items()]
    if days is not None:
        conditions.append(F.col("log_date").isin(days))
    return log.filter(reduce(and_, conditions)) if conditions else log


def search(
    log: DataFrame, terms: dict | None = None, size: int | None = 100, days: list[str] | None = None,
    tie: tuple[str, ...] = ("run_id", "stage", "message"),
) -> DataFrame:
    """Newest events first, at most ``size`` of them; ``None`` means all."""
    found = matching(log, terms, days).orderBy(F.desc("ts"), *tie)
    return found if size is None else found.limit(size)


def run_logs(log: DataFrame, run_id: str, size: int | None = None) -> DataFrame:
    return search(log, {"run_id": run_id}, size)


def hit_count(log: DataFrame, terms: dict | None = None, days: list[str] | None = None) -> DataFrame:
    return matching(log, terms, days).agg(F.count(F.lit(1)).alias("hits"))


def run_spans(log: DataFrame) -> DataFrame:
    """First and last event of each run, and the seconds between."""
    return log.groupBy("run_id").agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count(F.lit(1)).alias("events"),
        ((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6).alias("duration"),
    )


def error_summary(log: DataFrame) -> DataFrame:
    """Errors per exception type with the newest message."""
    return log.filter(F.col("level") == "ERROR").groupBy(field("exception_type").alias("exception_type")).agg(
        F.count(F.lit(1)).alias("errors"),
        F.max_by("message", F.struct("ts", "message")).alias("last_message"),
    )


def log_days(log: DataFrame, size: int | None = 10) -> DataFrame:
    """Days with events, in order."""
    days = log.select("log_date").distinct().orderBy("log_date")
    return days if size is None else days.limit(size)
