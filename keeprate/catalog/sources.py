"""Registered scans, sinks, event-log and version-table queries."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession, functions as F

from keeprate.catalog.common import CS_PROBABILITY_SQL, FEATURE_LIST, USAGE_SQL, cs_probability, registered, usage
from keeprate.functions.columns import log_day
from keeprate.plans.scoring import as_predictions, report_table
from keeprate.schema import CUSTOMER_FIELDS, FEATURES, file_schema
from keeprate.session import scratch_path, settled, table
from keeprate.sources import commits, events, files, postings, runs, versions


def _customers(spark, folder):
    return usage(spark, folder).select("customer_id", *FEATURES, "churn")


def s01_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "customers-csv")
    files.write_csv(files.to_external(_customers(spark, folder)), path)
    return files.read_customers_csv(spark, path, file_schema(with_id=True))


def s02_record_scan(spark, folder):
    path = scratch_path(spark, "customers-json")
    files.to_external(_customers(spark, folder).drop("churn")).write.json(path)
    return files.read_customers_json(spark, path, file_schema(with_label=False, with_id=True))


def _dirty(spark, folder):
    """The customer table as text under file names, with missing and malformed entries."""
    u = files.to_external(_customers(spark, folder).drop("churn"))
    return u.select("customer_id", *[
        F.when(F.col("Number vmail messages") % 7 == 3, "unknown").otherwise(F.col(s).cast("string")).alias(s)
        if s == "Account length" else
        F.when(F.col("Total intl calls") != 4, F.col(s).cast("string")).alias(s)
        if s == "Total day charge" else F.col(s).cast("string").alias(s)
        for s, _, _ in CUSTOMER_FIELDS
    ])


def s03_validate_rename(spark, folder):
    accepted, rejected = files.validate(_dirty(spark, folder), keep=["customer_id"])
    return accepted.select("customer_id", F.lit("accepted").alias("outcome"), "account_length", "day_charge").unionByName(
        rejected.select(
            "customer_id", F.concat_ws("|", "faults").alias("outcome"),
            F.lit(None).cast("int").alias("account_length"), F.lit(None).cast("double").alias("day_charge"),
        )
    )


def s04_csv_sink(spark, folder):
    scored = usage(spark, folder).select(
        "customer_id", cs_probability().alias("probability")
    ).withColumn("prediction", (F.col("probability") > 0.8).cast("int"))
    path = scratch_path(spark, "report-csv")
    files.write_csv(report_table(as_predictions(scored, ["customer_id"])), path)
    return spark.read.schema(
        "Customer long, Churn string, Probability string, Confidence string, `Risk Level` string"
    ).option("header", True).csv(path)


# ---- run tables ----------------------------------------------------------------------


def _run_metrics(spark, folder):
    return table(spark, folder, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("run_id"), F.col("event_type").alias("name"),
        F.col("ts").cast("timestamp").alias("ts"), "value", F.col("event_id").cast("int").alias("step"),
    )


def s10_run_metric_scan(spark, folder):
    path = scratch_path(spark, "run-metrics")
    runs.write_metrics(_run_metrics(spark, folder), path)
    found = runs.read_metrics(spark, path)
    return found.select("run_id", "name", F.unix_millis("ts").alias("epoch_ms"), "value", "step")


def s10_run_metric_latest(spark, folder):
    return runs.latest_metrics(_run_metrics(spark, folder))


def s11_run_param_scan(spark, folder):
    path = scratch_path(spark, "run-params")
    params = table(spark, folder, "customer").groupBy(
        F.concat(F.lit("run-"), "c_nationkey").alias("run_id"), F.lower("c_mktsegment").alias("name")
    ).agg(F.count(F.lit(1)).cast("string").alias("value"))
    runs.write_params(params, path)
    return runs.read_params(spark, path)


# ---- event log -----------------------------------------------------------------------


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """The events table in the shape of the log."""
    failed = F.col("event_type") == "error"
    k = F.get_json_object("props", "$.k")
    return events.as_events(
        table(spark, folder, "events"),
        ts=F.col("ts").cast("timestamp"),
        level=F.when(failed, "ERROR").otherwise("INFO"),
        message=F.concat_ws(" ", "event_type", "event_id"),
        run_id=F.col("user_id"),
        metric_name=F.col("event_type"),
        metric_value=F.col("value"),
        stage=F.col("event_type"),
        k=k,
        exception_type=F.when(failed, F.concat(F.lit("Error"), (k.cast("int") % 5).cast("string"))),
    ).withColumn("log_date", log_day("ts"))


EVENT_SQL = """WITH log AS (
  SELECT ts, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
    event_type || ' ' || event_id AS message, CAST(user_id AS VARCHAR) AS run_id, event_type AS stage,
    value AS metric_value, json_extract_string(props, '$.k') AS k,
    CASE WHEN event_type = 'error'
      THEN 'Error' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) END AS exception_type,
    strftime(ts, '%Y.%m.%d') AS log_date
  FROM events
)"""


def _shown(log):
    return log.select(
        F.unix_micros("ts").alias("ts_us"), "level", "message", "run_id", "stage", "metric_value",
        events.field("k").alias("k"), "log_date",
    )


SHOWN_SQL = "epoch_us(ts) AS ts_us, level, message, run_id, stage, metric_value, k, log_date"


def s07_event_append(spark, folder):
    path = scratch_path(spark, "event-log")
    log = event_log(spark, folder).drop("log_date")
    # Two appends: the log is never rewritten.
    events.append(events.matching(log, {"level": "ERROR"}), path)
    events.append(events.matching(log, {"level": "INFO"}), path)
    return _shown(events.read_log(spark, path))


def _run_maps(spark, folder):
    """(ts, run_id, counts map): event counts by type per user, as a tracked run would report them."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    return table(spark, folder, "events").groupBy(F.col("user_id").cast("string").alias("run_id")).agg(
        F.max("ts").cast("timestamp").alias("ts"),
        F.create_map(*[
            x for kind in kinds for x in (F.lit(kind), F.count(F.when(F.col("event_type") == kind, 1)))
        ]).alias("counts"),
    )


RUN_MAPS_SQL = """WITH kinds AS (
  SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS name
), runs AS (SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id
), entries AS (
  SELECT CAST(runs.user_id AS VARCHAR) AS run_id, epoch_us(runs.ts) AS ts_us, name,
    (SELECT count(*) FROM events e WHERE e.user_id = runs.user_id AND e.event_type = name) AS n
  FROM runs CROSS JOIN kinds
)"""


def s08_param_events(spark, folder):
    made = events.param_events(_run_maps(spark, folder).withColumnRenamed("counts", "params"))
    return made.select("run_id", F.unix_micros("ts").alias("ts_us"), "stage", "param_name", "param_value", "message")


def s09_metric_events(spark, folder):
    made = events.metric_events(_run_maps(spark, folder).withColumnRenamed("counts", "metrics"))
    return made.select("run_id", F.unix_micros("ts").alias("ts_us"), "stage", "metric_name", "metric_value")


def l01_search_newest(spark, folder):
    return _shown(events.search(event_log(spark, folder)))


def l02_run_logs(spark, folder):
    return _shown(events.run_logs(event_log(spark, folder), "8"))


def l03_match_field(spark, folder):
    return _shown(events.matching(event_log(spark, folder), {"k": "7", "level": "INFO"}))


def l03_message_words(spark, folder):
    """Events by the words of their message, over a log that grew after its index was made."""
    path, index = scratch_path(spark, "event-log"), scratch_path(spark, "postings")
    log = event_log(spark, folder).drop("log_date")
    before = F.pmod(F.unix_seconds("ts"), F.lit(3)) > 0
    events.append(log.filter(before), path)
    postings.update(spark, path, index)
    events.append(log.filter(~before), path)
    return _shown(postings.search_messages(spark, path, index, "PURCHASE"))


def l04_hit_count(spark, folder):
    return events.hit_count(event_log(spark, folder), {"stage": "purchase"})


def l05_run_spans(spark, folder):
    spans = events.run_spans(event_log(spark, folder))
    return spans.select(
        "run_id", F.unix_micros("started").alias("started_us"), F.unix_micros("ended").alias("ended_us"),
        "events", F.round("duration", 6).alias("duration"),
    )


def l05_run_events(spark, folder):
    spans = events.run_spans(event_log(spark, folder))
    runs_ = spans.select(
        F.col("started").alias("ts"), "run_id", F.lit("usage").alias("experiment_name"), F.lit("forest").alias("model_type")
    )
    ends = spans.select(F.col("ended").alias("ts"), "run_id", F.lit("SUCCESS").alias("status"))
    return events.run_start(runs_).unionByName(events.run_end(ends)).select(
        "run_id", F.unix_micros("ts").alias("ts_us"), "level", "stage", "message", "model_type",
        events.field("status").alias("status"),
    )


def l06_stage_events(spark, folder):
    """Training and evaluation events of every run; a run of one event has no duration."""
    spans = events.run_spans(event_log(spark, folder)).withColumn(
        "duration", F.when(F.col("events") > 1, F.round(F.col("duration") / 86400, 0))
    ).select(F.col("ended").alias("ts"), "run_id", F.lit("forest").alias("model_type"), "duration", "events")
    trained = events.training_events(spans)
    evaluated = events.evaluation_events(spans, ["events"])
    prepared = events.preparation_events(spans.withColumns({
        "train_samples": F.col("events"), "test_samples": F.col("events") * 2, "n_features": F.lit(19),
    }))
    return trained.unionByName(evaluated).unionByName(prepared).select(
        "run_id", "stage", "model_type",
        events.field("training_duration").cast("double").alias("training_duration"),
        events.field("metric_events").cast("long").alias("metric_events"),
        events.field("test_samples").cast("long").alias("test_samples"),
    )


def l07_error_summary(spark, folder):
    return events.error_summary(event_log(spark, folder))


def l07_error_events(spark, folder):
    failed = table(spark, folder, "events").filter(F.col("event_type") == "error").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("string").alias("run_id"),
        F.lit("step failed").alias("message"), F.lit("ValueError").alias("exception_type"),
        F.col("props").alias("exception_message"),
    )
    return events.error_events(failed).select(
        "run_id", F.unix_micros("ts").alias("ts_us"), "level", "stage", "message",
        events.field("exception_type").alias("exception_type"),
        events.field("exception_message").alias("exception_message"),
    )


def l08_log_days(spark, folder):
    return events.log_days(event_log(spark, folder))


def l08_search_days(spark, folder):
    path = scratch_path(spark, "event-log")
    events.append(event_log(spark, folder).drop("log_date"), path)
    days = ["2024.01.05", "2024.01.06"]
    return _shown(events.matching(events.read_log(spark, path), {"stage": "error"}, days))


# ---- versions ------------------------------------------------------------------------


def version_scores(spark: SparkSession, folder: str) -> DataFrame:
    """(version, metric, value, ts) rows from the part table, many per version and metric."""
    number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int") - 1
    return table(spark, folder, "part").select(
        F.concat_ws(".", F.floor(number / 12) + 1, number % 12).alias("version"),
        F.lower("p_type").alias("metric"),
        F.col("p_retailprice").alias("value"),
        F.timestamp_seconds("p_partkey").alias("ts"),
    )


VERSION_SQL = """WITH numbered AS (
  SELECT CAST(substr(p_brand, 7) AS INTEGER) - 1 AS number, lower(p_type) AS metric, p_retailprice AS value, p_partkey AS stamp
  FROM part
), scores AS (
  SELECT CAST(number // 12 + 1 AS VARCHAR) || '.' || CAST(number % 12 AS VARCHAR) AS version,
    number // 12 + 1 AS major, number % 12 AS minor, metric, value, stamp
  FROM numbered
), latest AS (
  SELECT version, major, minor, metric, arg_max(value, stamp) AS value, max(stamp) AS stamp
  FROM scores GROUP BY version, major, minor, metric
)"""


def _metadata_file(spark, folder):
    """Nested metadata documents, one per major version, written as JSON."""
    latest = versions.latest_scores(version_scores(spark, folder))
    per_version = latest.groupBy("version").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("scores"), F.max("ts").alias("ts")
    )
    documents = per_version.groupBy(F.split("version", r"\.")[0].alias("major")).agg(
        F.array_sort(F.collect_list(F.struct("version", F.col("ts").alias("timestamp")))).alias("version_history"),
        F.max_by("version", "ts").alias("version"),
        F.max("ts").alias("last_trained"),
        F.map_from_entries(F.collect_list(
            F.struct("version", F.struct("scores", F.col("ts").alias("evaluation_date")))
        )).alias("version_scores"),
    )
    # One document per file, as the tracker writes them.
    path = scratch_path(spark, "model-metadata")
    documents.repartition("major").write.partitionBy("major").json(path)
    return path


def s05_metadata_history(spark, folder):
    found = versions.history(versions.read_metadata(spark, _metadata_file(spark, folder)))
    return found.select("version", F.unix_seconds("timestamp").alias("stamp"))


def s05_metadata_scores(spark, folder):
    found = versions.scores(versions.read_metadata(spark, _metadata_file(spark, folder)))
    return found.select("version", "metric", F.round("value", 4).alias("value"))


def s06_score_append(spark, folder):
    path = scratch_path(spark, "scores")
    scores = version_scores(spark, folder)
    old = F.unix_seconds("ts") % 2 == 0
    versions.append_rows(scores.filter(old), path)
    versions.append_rows(scores.filter(~old), path)
    return spark.read.parquet(path).groupBy("version").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("value"), 2).alias("total"))


def r01_current_version(spark, folder):
    return versions.current_version(version_scores(spark, folder))


def r02_next_version(spark, folder):
    return versions.following_version(version_scores(spark, folder))


def r03_version_history(spark, folder):
    path = scratch_path(spark, "history")
    rows = version_scores(spark, folder).groupBy("version").agg(F.max("ts").alias("timestamp"))
    versions.append_rows(rows, path)
    return spark.read.parquet(path).select("version", F.unix_seconds("timestamp").alias("stamp"))


def r04_upsert_scores(spark, folder):
    latest = versions.latest_scores(version_scores(spark, folder))
    return latest.select("version", "metric", "value", F.unix_seconds("ts").alias("stamp"))


def r02_versions_of_parallel_runs(spark, folder):
    """One run per metric, all at once: each gets a version of its own."""
    path = scratch_path(spark, "registry")
    runs = [r.metric for r in version_scores(spark, folder).select("metric").distinct().collect()]
    with ThreadPool(len(runs) or 1) as pool:
        given = pool.map(lambda run: commits.reserve_version(spark, path, run), runs)
    found = commits.entries(spark, path).filter(F.col("version").isin(given))
    return found.groupBy("version").agg(F.count_distinct("run_id").alias("runs"))


def r04_committed_scores(spark, folder):
    """Latest scores of tables that four writers commit side by side, beside one that is never committed."""
    path, scores = scratch_path(spark, "registry"), settled(version_scores(spark, folder), "scores")
    scores.withColumns({"value": F.lit(-1.0), "ts": F.current_timestamp()}).write.parquet(f"{path}/data/scores-unfinished")
    with ThreadPool(4) as pool:
        pool.map(lambda i: commits.append(spark, scores.filter(F.pmod(F.unix_seconds("ts"), F.lit(4)) == i), path, "scores"), range(4))
    latest = versions.latest_scores(commits.rows(spark, path, "scores"))
    return latest.select("version", "metric", "value", F.unix_seconds("ts").alias("stamp"))


def r05_score_report(spark, folder):
    return versions.score_report(version_scores(spark, folder))


def r06_list_versions(spark, folder):
    """Versions with their place in number order."""
    listed = versions.list_versions(version_scores(spark, folder))
    number = versions.version_number("version")
    return listed.select("version", number["major"].alias("major"), number["minor"].alias("minor"))


def t05_version_sort(spark, folder):
    names = version_scores(spark, folder).select(F.concat(F.lit("v"), "version").alias("name"))
    return versions.versions_in_names(names)


QUERIES = registered(globals())

ORACLES = {
    "s01_csv_scan": f"{USAGE_SQL} SELECT customer_id, {FEATURE_LIST}, churn FROM usage",
    "s02_record_scan": f"{USAGE_SQL} SELECT customer_id, {FEATURE_LIST} FROM usage",
    "s03_validate_rename": f"""{USAGE_SQL}, marked AS (
      SELECT customer_id, account_length, day_charge, vmail_messages % 7 = 3 AS bad_length, intl_calls = 4 AS bad_charge
      FROM usage)
    SELECT customer_id, CASE WHEN bad_length AND bad_charge THEN 'Account length|Total day charge'
        WHEN bad_length THEN 'Account length' WHEN bad_charge THEN 'Total day charge' ELSE 'accepted' END AS outcome,
      CASE WHEN bad_length OR bad_charge THEN NULL ELSE account_length END AS account_length,
      CASE WHEN bad_length OR bad_charge THEN NULL ELSE day_charge END AS day_charge
    FROM marked""",
    "s04_csv_sink": f"""{USAGE_SQL}, p AS (
      SELECT customer_id, {CS_PROBABILITY_SQL} AS probability FROM usage)
    SELECT row_number() OVER (ORDER BY customer_id) AS "Customer",
      CASE WHEN probability > 0.8 THEN 'Yes' ELSE 'No' END AS "Churn",
      printf('%.2f%%', probability * 100) AS "Probability",
      printf('%.2f%%', abs(probability - 0.5) * 2 * 100) AS "Confidence",
      CASE WHEN probability < 0.3 THEN 'Low' WHEN probability < 0.6 THEN 'Medium' ELSE 'High' END AS "Risk Level"
    FROM p""",
    "s05_metadata_history": f"{VERSION_SQL} SELECT version, max(stamp) AS stamp FROM scores GROUP BY version",
    "s05_metadata_scores": f"{VERSION_SQL} SELECT version, metric, round(value, 4) AS value FROM latest",
    "s06_score_append": f"""{VERSION_SQL} SELECT version, count(*) AS rows, round(sum(value), 2) AS total
      FROM scores GROUP BY version""",
    "s07_event_append": f"{EVENT_SQL} SELECT {SHOWN_SQL} FROM log",
    "s08_param_events": f"""{RUN_MAPS_SQL} SELECT run_id, ts_us, 'parameters' AS stage, name AS param_name,
      CAST(n AS VARCHAR) AS param_value, 'parameter: ' || name || ' = ' || n AS message FROM entries""",
    "s09_metric_events": f"""{RUN_MAPS_SQL} SELECT run_id, ts_us, 'metrics' AS stage, name AS metric_name,
      CAST(n AS DOUBLE) AS metric_value FROM entries""",
    "s10_run_metric_scan": """SELECT strftime(ts, '%Y%m%d') AS run_id, event_type AS name, epoch_us(ts) // 1000 AS epoch_ms,
      value, CAST(event_id AS INTEGER) AS step FROM events""",
    "s10_run_metric_latest": """SELECT strftime(ts, '%Y%m%d') AS run_id, event_type AS name,
      arg_max(value, ts) AS value, count(*) AS points FROM events GROUP BY 1, 2""",
    "s11_run_param_scan": """SELECT 'run-' || c_nationkey AS run_id, lower(c_mktsegment) AS name,
      CAST(count(*) AS VARCHAR) AS value FROM customer GROUP BY 1, 2""",
    "l01_search_newest": f"{EVENT_SQL} SELECT {SHOWN_SQL} FROM log ORDER BY ts DESC, run_id, stage, message LIMIT 100",
    "l02_run_logs": f"{EVENT_SQL} SELECT {SHOWN_SQL} FROM log WHERE run_id = '8'",
    "l03_match_field": f"{EVENT_SQL} SELECT {SHOWN_SQL} FROM log WHERE k = '7' AND level = 'INFO'",
    "l03_message_words": f"{EVENT_SQL} SELECT {SHOWN_SQL} FROM log WHERE list_contains(regexp_split_to_array(lower(message), '[^a-z0-9]+'), 'purchase')",
    "l04_hit_count": f"{EVENT_SQL} SELECT count(*) AS hits FROM log WHERE stage = 'purchase'",
    "l05_run_spans": f"""{EVENT_SQL} SELECT run_id, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) AS ended_us,
      count(*) AS events, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS duration FROM log GROUP BY run_id""",
    "l05_run_events": f"""{EVENT_SQL}, spans AS (SELECT run_id, min(ts) AS started, max(ts) AS ended FROM log GROUP BY run_id)
      SELECT run_id, epoch_us(started) AS ts_us, 'INFO' AS level, 'run_start' AS stage,
        'run started: ' || run_id AS message, 'forest' AS model_type, NULL AS status FROM spans
      UNION ALL SELECT run_id, epoch_us(ended), 'INFO', 'run_end',
        'run ended: ' || run_id || ' - status: SUCCESS', NULL, 'SUCCESS' FROM spans""",
    "l06_stage_events": f"""{EVENT_SQL}, spans AS (
        SELECT run_id, count(*) AS events, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM log GROUP BY run_id)
      SELECT run_id, 'model_training' AS stage, 'forest' AS model_type,
        CASE WHEN events > 1 THEN round(seconds / 86400, 0) END AS training_duration,
        CAST(NULL AS BIGINT) AS metric_events, CAST(NULL AS BIGINT) AS test_samples FROM spans
      UNION ALL SELECT run_id, 'model_evaluation', 'forest', NULL, events, NULL FROM spans
      UNION ALL SELECT run_id, 'data_preparation', NULL, NULL, NULL, events * 2 FROM spans""",
    "l07_error_summary": f"""{EVENT_SQL} SELECT exception_type, count(*) AS errors, arg_max(message, ts) AS last_message
      FROM log WHERE level = 'ERROR' GROUP BY exception_type""",
    "l07_error_events": """SELECT CAST(user_id AS VARCHAR) AS run_id, epoch_us(ts) AS ts_us, 'ERROR' AS level,
      'error' AS stage, 'step failed' AS message, 'ValueError' AS exception_type, props AS exception_message
      FROM events WHERE event_type = 'error'""",
    "l08_log_days": f"{EVENT_SQL} SELECT DISTINCT log_date FROM log ORDER BY log_date LIMIT 10",
    "l08_search_days": f"""{EVENT_SQL} SELECT {SHOWN_SQL} FROM log
      WHERE stage = 'error' AND log_date IN ('2024.01.05', '2024.01.06')""",
    "r01_current_version": f"{VERSION_SQL} SELECT version FROM scores ORDER BY major DESC, minor DESC LIMIT 1",
    "r02_next_version": f"""{VERSION_SQL} SELECT version, CAST(major AS VARCHAR) || '.' || CAST(minor + 1 AS VARCHAR) AS next_version
      FROM scores ORDER BY major DESC, minor DESC LIMIT 1""",
    "r03_version_history": f"{VERSION_SQL} SELECT version, max(stamp) AS stamp FROM scores GROUP BY version",
    "r04_upsert_scores": f"{VERSION_SQL} SELECT version, metric, value, stamp FROM latest",
    "r02_versions_of_parallel_runs": f"{VERSION_SQL} SELECT '1.' || CAST(unnest(range(count(DISTINCT metric))) AS VARCHAR) AS version, CAST(1 AS BIGINT) AS runs FROM scores",
    "r04_committed_scores": f"{VERSION_SQL} SELECT version, metric, value, stamp FROM latest",
    "r05_score_report": f"""{VERSION_SQL} SELECT version, """ + ", ".join(
        f"max(CASE WHEN metric = '{m}' THEN value END) AS {m}"
        for m in ("economy", "large", "medium", "promo", "small", "standard")
    ) + " FROM latest GROUP BY version",
    "r06_list_versions": f"""{VERSION_SQL} SELECT DISTINCT version, CAST(major AS INTEGER) AS major,
      CAST(minor AS INTEGER) AS minor FROM scores""",
    "t05_version_sort": f"""{VERSION_SQL}, listed AS (SELECT DISTINCT version, major, minor FROM scores)
      SELECT version FROM listed ORDER BY major, minor""",
}
