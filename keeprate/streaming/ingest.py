"""Streaming ingest of event records into the day-partitioned log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from keeprate.functions.columns import log_day
from keeprate.schema import EVENT_SCHEMA
from keeprate.sources.files import CORRUPT, with_corrupt


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON event files as they arrive, under the fixed log schema; malformed records keep their text in ``_corrupt_record``."""
    reader = spark.readStream.schema(with_corrupt(EVENT_SCHEMA)).option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def ingest(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends all available events; restarts continue where the checkpoint ends.

    A batch's events go to one task per day, so that it adds one file to a day. Records that could not be
    parsed have no time and stay out of the log; ``malformed`` has them.
    """
    whole = events.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in events.columns else events
    return (
        whole.withColumn("log_date", log_day(F.col("ts"))).repartition("log_date")
        .writeStream.format("parquet").outputMode("append").partitionBy("log_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def malformed(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the text of records that could not be parsed."""
    return (
        events.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
        .writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
