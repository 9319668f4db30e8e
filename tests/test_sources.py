from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from keeprate.catalog.sources import event_log
from keeprate.plans import models, recipes
from keeprate.plans.usage import customer_usage, held_out_rows, train_rows
from keeprate.schema import FEATURES
from keeprate.session import settled, table
from keeprate.sources import events, files, runs, versions
from keeprate.streaming import ingest, score as score_streaming
from keeprate.plans.scoring import score

FOLDER = "/root/testdata/sf0.001"


def test_csv_template_has_only_the_header(spark, tmp_path):
    files.write_csv(files.template(spark).coalesce(1), str(tmp_path / "template"))
    assert files.read_customers_csv(spark, str(tmp_path / "template")).count() == 0


def test_run_files_in_tracker_layout(spark, tmp_path):
    run = tmp_path / "17" / "run-a"
    (run / "metrics").mkdir(parents=True)
    (run / "params").mkdir()
    (run / "metrics" / "recall").write_text("1700000000000 0.77 0\n1700000001000 0.78 0\n")
    (run / "params" / "model_type").write_text("boosted_trees")
    found = runs.read_metrics(spark, str(tmp_path)).collect()
    assert sorted((r.run_id, r.name, r.value, r.step) for r in found) == [("run-a", "recall", 0.77, 0), ("run-a", "recall", 0.78, 0)]
    last = runs.latest_metrics(runs.read_metrics(spark, str(tmp_path))).first()
    assert (last.value, last.points) == (0.78, 2)
    assert [tuple(r) for r in runs.read_params(spark, str(tmp_path)).collect()] == [("run-a", "model_type", "boosted_trees")]


def test_metadata_without_scores(spark, tmp_path):
    (tmp_path / "old.json").write_text(json.dumps({
        "version_history": [{"version": "1.1", "timestamp": "2021-03-01T08:00:00.000000"}], "version": "1.1",
    }, indent=2))
    (tmp_path / "new.json").write_text(json.dumps({
        "version_history": [{"version": "1.2", "timestamp": "2021-03-02T09:30:00.500000"}], "version": "1.2",
        "version_scores": {"1.2": {"scores": {"accuracy": 0.9, "roc_auc": 0.8}, "evaluation_date": "2021-03-02T09:31:00.250000"}},
    }, indent=2))
    metadata = versions.read_metadata(spark, str(tmp_path))
    assert sorted(r.version for r in versions.history(metadata).collect()) == ["1.1", "1.2"]
    assert sorted((r.version, r.metric, r.value) for r in versions.scores(metadata).collect()) == [
        ("1.2", "accuracy", 0.9), ("1.2", "roc_auc", 0.8),
    ]


def test_versions_without_rows(spark):
    empty = spark.createDataFrame([], "version string")
    assert tuple(versions.following_version(empty).first()) == ("1.0", "1.1")


def test_last_score_wins(spark):
    rows = spark.createDataFrame(
        [("1.10", "accuracy", 0.5, 1), ("1.10", "accuracy", 0.7, 3), ("1.9", "accuracy", 0.6, 2)],
        "version string, metric string, value double, t long",
    ).withColumn("ts", F.timestamp_seconds("t"))
    assert [tuple(r) for r in versions.score_report(rows).collect()] == [("1.9", 0.6), ("1.10", 0.7)]
    assert versions.current_version(rows).first()[0] == "1.10"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "events")
    events.append(event_log(spark, FOLDER).drop("log_date"), path)
    return events.read_log(spark, path)


def test_log_survives_the_round_trip(spark, log):
    assert log.count() == table(spark, FOLDER, "events").count()


def test_search_is_newest_first_and_limited(log):
    rows = events.search(log, size=7).collect()
    assert len(rows) == 7 and [r.ts for r in rows] == sorted((r.ts for r in rows), reverse=True)
    assert events.search(log, {"stage": "error"}, size=None).count() == events.hit_count(log, {"stage": "error"}).first()[0]


def test_days_prune_folders(log):
    found = events.matching(log, days=["2024.01.05"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024.01.05" in plan.split("PartitionFilters")[1][:200]
    assert found.count() > 0


def test_open_fields_and_null_durations(spark):
    runs_ = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "r", "forest", 0.0), (dt.datetime(2024, 1, 1), "s", "forest", None)],
        "ts timestamp, run_id string, model_type string, duration double",
    )
    made = {r.run_id: r for r in events.training_events(runs_).collect()}
    # A duration of zero is a duration.
    assert made["r"].extra == {"training_duration": "0.0"} and made["r"].message.endswith("0.00s")
    assert made["s"].extra == {} and "duration" not in made["s"].message


def test_stream_appends_only_new_files(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    batch = event_log(spark, FOLDER).drop("log_date")
    batch.filter("stage = 'error'").write.json(source)
    ingest.ingest(ingest.event_stream(spark, source, 1), target, checkpoint).awaitTermination()
    first = events.read_log(spark, target).count()
    batch.filter("stage = 'click'").write.mode("append").json(source)
    ingest.ingest(ingest.event_stream(spark, source, 1), target, checkpoint).awaitTermination()
    assert first == batch.filter("stage = 'error'").count()
    assert events.read_log(spark, target).count() == batch.filter("stage IN ('error', 'click')").count()


def test_stream_scores_like_the_batch(spark, tmp_path):
    usage = settled(customer_usage(spark, FOLDER), "usage")
    model = recipes.fit(train_rows(usage), models.production_model("random_forest", numTrees=3), "full")
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    files.to_external(held_out_rows(usage).select("customer_id", *FEATURES)).write.json(source)
    score_streaming.score_stream(
        model, score_streaming.customer_stream(spark, source), target, checkpoint
    ).awaitTermination()
    want = sorted(score(model, held_out_rows(usage)).collect())
    assert sorted(spark.read.parquet(target).collect()) == want
