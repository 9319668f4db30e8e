"""Spans of runs from a stream of events, with duplicates and late events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from keeprate.sources.files import CORRUPT

DELAY = "1 hour"  # that an event may come after later ones
PAUSE = "6 hours"  # without an event that ends a span


def spans(events: DataFrame, delay: str = DELAY, pause: str = PAUSE) -> DataFrame:
    """(run_id, started, ended, events, duration): a span goes on while less than ``pause`` passes between its events.

    On a stream a span is put out once the watermark, ``delay`` behind the newest event, has passed its
    end by ``pause``; until then it is state. Later events than that are dropped, and so are events that
    equal another one in every field and come within the delay. A run that pauses longer has several spans,
    which ``merged`` joins. Events without time belong to no span; records that could not be parsed are left out.
    """
    whole = events.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in events.columns else events
    once = whole.filter(F.col("ts").isNotNull()).withColumn(
        "_event", F.sha2(F.to_json(F.struct(*whole.columns), {"ignoreNullFields": "false"}), 256)
    ).select("run_id", "ts", "_event").withWatermark("ts", delay)
    once = once.dropDuplicatesWithinWatermark(["_event"]) if events.isStreaming else once.dropDuplicates(["_event"])
    found = once.groupBy("run_id", F.session_window("ts", pause)).agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count(F.lit(1)).alias("events"))
    return found.select("run_id", "started", "ended", "events", _seconds().alias("duration"))


def _seconds():
    return (F.unix_micros("ended") - F.unix_micros("started")) / 1e6


def write_spans(
    events: DataFrame, path: str, checkpoint: str, delay: str = DELAY, pause: str = PAUSE
) -> StreamingQuery:
    """Appends the spans that have ended; restarts go on with the state of the checkpoint."""
    return (
        spans(events, delay, pause)
        .writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def merged(found: DataFrame) -> DataFrame:
    """One span per run, from its first to its last event, as of the spans that have ended."""
    whole = found.groupBy("run_id").agg(
        F.min("started").alias("started"), F.max("ended").alias("ended"), F.sum("events").alias("events"))
    return whole.withColumn("duration", _seconds())
