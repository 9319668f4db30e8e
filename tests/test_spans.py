from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from keeprate.schema import EVENT_SCHEMA
from keeprate.sources import events
from keeprate.streaming import ingest, spans

START = dt.datetime(2024, 5, 1)


def log(spark, rows):
    """Events of (minute, run, message)."""
    df = spark.createDataFrame([(START + dt.timedelta(minutes=m), r, t) for m, r, t in rows], "ts timestamp, run_id string, message string")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])


def fed(spark, source, rows):
    log(spark, rows).coalesce(1).write.mode("append").json(source)


def found(df):
    return sorted(
        (r.run_id, round((r.started - START).total_seconds() / 60), round((r.ended - START).total_seconds() / 60), r.events)
        for r in df.collect())


def test_restarts_late_events_and_duplicates(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        spans.write_spans(ingest.event_stream(spark, source), target, checkpoint, "30 minutes", "60 minutes").awaitTermination()
        return found(spark.read.parquet(target))

    fed(spark, source, [(0, "a", "x"), (10, "a", "y"), (20, "b", "x")])
    assert run() == []  # all may go on
    # Late by ten minutes, a repetition of an event, and the same time with another message.
    fed(spark, source, [(12, "b", "late"), (20, "b", "x"), (20, "b", "z"), (40, "a", "y")])
    assert run() == []
    fed(spark, source, [(300, "c", "x")])
    assert run() == [("a", 0, 40, 3), ("b", 12, 20, 3)]
    # Too late to count; run a begins anew after its pause.
    fed(spark, source, [(5, "a", "too late"), (310, "a", "again")])
    fed(spark, source, [(900, "d", "x")])
    assert run() == [("a", 0, 40, 3), ("a", 310, 310, 1), ("b", 12, 20, 3), ("c", 300, 300, 1)]
    assert found(spans.merged(spark.read.parquet(target))) == [("a", 0, 310, 4), ("b", 12, 20, 3), ("c", 300, 300, 1)]


def test_batch_equals_run_spans_of_distinct_events(spark):
    rows = [(i * 7 % 50, f"r{i % 3}", f"m{i}") for i in range(40)]
    twice = log(spark, rows + rows[:10])
    want = events.run_spans(log(spark, rows))
    assert found(spans.merged(spans.spans(twice))) == found(want)


def test_null_times_and_broken_records(spark, tmp_path):
    odd = log(spark, [(0, "a", "x"), (1, None, "y")])
    odd = odd.union(odd.withColumn("ts", F.lit(None).cast("timestamp")))
    assert [r.events for r in spans.spans(odd).orderBy("run_id").collect()] == [1, 1]
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    fed(spark, source, [(0, "a", "x"), (5000, "b", "x")])
    spark.createDataFrame([('{"ts": 12, "level',)], "value string").write.mode("append").text(source)
    spans.write_spans(ingest.event_stream(spark, source), target, str(tmp_path / "state")).awaitTermination()
    assert found(spark.read.parquet(target)) == [("a", 0, 0, 1)]


def test_no_events(spark):
    assert spans.merged(spans.spans(log(spark, []))).count() == 0
