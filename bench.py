"""Headline queries and production training at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the run.
Every query starts from the parquet tables; nothing is kept from one to the next.
"""

from __future__ import annotations

import json
import os
import time

from keeprate import catalog
from keeprate.operators import metrics
from keeprate.plans import models, recipes
from keeprate.plans.scoring import score, summary
from keeprate.plans.usage import customer_usage, held_out_rows, train_rows
from keeprate.session import clear_scratch, local_session, settled

HEADLINE = [
    "a04_distinct_counts", "a06_describe", "a09_count_by_category", "a10_churn_rate_by_state", "a11_histogram",
    "a14_box_stats", "a15_exact_quantile", "a16_correlation", "a18_normality", "a25_roc_auc", "a26_roc_curve",
    "f07_iqr_outliers", "f12_preprocessing", "j02_nearest_neighbors", "l01_search_newest", "l05_run_spans",
    "m01_rebalance", "m05_logistic_regression", "m14_stratified_folds", "r05_score_report", "s01_csv_scan",
    "s07_event_append", "x01_streaming_ingest",
]


def training_run(spark, folder):
    """The forest in its production settings: table, encoding, scaling, fit."""
    usage = settled(customer_usage(spark, folder), "usage")
    prepared = recipes.prepare(train_rows(usage), "basic")
    models.production_model("random_forest").fit(prepared.train)


def full_run(spark, folder):
    """Boosted trees in their production settings: table, encoding, fit, all metrics."""
    usage = settled(customer_usage(spark, folder), "usage")
    prepared = recipes.prepare(train_rows(usage), "basic")
    fitted = models.production_model("boosted_trees").fit(prepared.train)
    held_out = models.positive_probability(fitted.transform(prepared.transform(held_out_rows(usage))))
    metrics.evaluate(held_out).collect()


def batch_scoring(spark, folder):
    """Fit the production forest, then score and summarise every customer."""
    usage = settled(customer_usage(spark, folder), "usage")
    model = recipes.fit(train_rows(usage), models.production_model("random_forest"), "full")
    summary(score(model, usage)).collect()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cores, shuffle_partitions=int(cores), name="keeprate-bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["a10_churn_rate_by_state"](spark, folder).collect()  # warm-up
    runs = {name: (lambda q=queries[name]: q(spark, folder).write.format("noop").mode("overwrite").save()) for name in HEADLINE}
    runs |= {f.__name__: (lambda f=f: f(spark, folder)) for f in (batch_scoring, training_run, full_run)}
    seconds = {}
    for name, run in runs.items():
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)
        clear_scratch(spark)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
