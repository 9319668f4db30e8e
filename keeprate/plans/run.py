"""One training run from rows to scores by version, with its events."""

from __future__ import annotations

import datetime
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from keeprate.operators import importance, metrics
from keeprate.plans import models, recipes
from keeprate.session import settled
from keeprate.sources import commits, events

EVALUATED = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "log_loss"]


class Run:
    """Where a run's tables are, under one folder."""

    def __init__(self, folder: str, run_id: str):
        self.folder, self.run_id = folder, run_id
        self.log, self.registry = f"{folder}/log", f"{folder}/registry"

    def scores(self, spark: SparkSession) -> DataFrame:
        """(version, metric, value, ts) of all runs whose scores are committed."""
        return commits.rows(spark, self.registry, "scores")

    def evaluation(self, part: str) -> str:
        """``matrix``, ``report``, ``curve`` or ``importances``."""
        return f"{self.folder}/evaluation/{self.run_id}/{part}"


def train_and_evaluate(
    spark: SparkSession, train: DataFrame, test: DataFrame, folder: str, name: str = "random_forest", recipe: str = "full",
    version: str | None = None, run_id: str | None = None, balance: dict | None = None, settings: dict | None = None,
) -> Run:
    """Prepares, trains, saves under the next version, evaluates on the test rows and records it all.

    Writes events to the log as the steps end, the model, its version and its
    scores to the registry, and the evaluation tables. Runs side by side in one folder get different versions. An error is recorded as an event and raised again.
    """
    run = Run(folder, run_id or uuid.uuid4().hex)

    def record(build, **values) -> None:
        now = datetime.datetime.now(datetime.timezone.utc)
        row = spark.range(1).select(F.lit(now).alias("ts"), F.lit(run.run_id).alias("run_id"), *[
            (v if not isinstance(v, (str, int, float, bool)) else F.lit(v)).alias(k) for k, v in values.items()])
        events.append(build(row), run.log)

    record(events.run_start, experiment_name="churn", model_type=name)
    try:
        estimator = models.production_model(name, **(settings or {}))
        prepared = recipes.prepare(train, recipe, balance=balance)
        held_out = settled(prepared.transform(test), "held-out")
        n_train, n_test = prepared.train.count(), held_out.count()
        record(events.preparation_events, train_samples=n_train, test_samples=n_test, n_features=len(prepared.names))
        params = {p.name: str(v) for p, v in estimator.extractParamMap().items()}
        record(events.param_events, params=F.create_map(*[F.lit(x) for pair in sorted(params.items()) for x in pair]))

        started = time.perf_counter()
        fitted = estimator.fit(prepared.train)
        record(events.training_events, model_type=name, duration=time.perf_counter() - started)

        version = version or commits.reserve_version(spark, run.registry, run.run_id)
        commits.save_model(spark, run.registry, prepared.model(fitted), version, run.run_id)

        scored = settled(models.positive_probability(fitted.transform(held_out)).select(
            "customer_id", "label", "prediction", "probability"), "scored")
        found = metrics.evaluate(scored)
        metrics.confusion_matrix(scored).write.mode("overwrite").parquet(run.evaluation("matrix"))
        metrics.classification_report(scored).write.mode("overwrite").parquet(run.evaluation("report"))
        metrics.roc_curve(scored).write.mode("overwrite").parquet(run.evaluation("curve"))
        importance.importances(spark, fitted, prepared.names).write.mode("overwrite").parquet(run.evaluation("importances"))
        values = {r.metric: r.value for r in found.collect()}
        record(lambda df: events.evaluation_events(df, EVALUATED), model_type=name, **{
            m: F.lit(values[m]).cast("double") for m in EVALUATED})
        record(events.metric_events, metrics=F.create_map(*[
            x for m, v in sorted(values.items()) if v is not None for x in (F.lit(m), F.lit(v))]))
        commits.append(spark, found.select(
            F.lit(version).alias("version"), "metric", "value", F.current_timestamp().alias("ts")), run.registry, "scores", run_id=run.run_id)
    except Exception as error:
        record(events.error_events, message="training run failed", exception_type=type(error).__name__,
               exception_message=str(error)[:2000])
        record(events.run_end, status="FAILED")
        raise
    record(events.run_end, status="FINISHED")
    return run
