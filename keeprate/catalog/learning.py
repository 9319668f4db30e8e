"""Registered metric, neighbour, training, scoring and streaming queries."""

from __future__ import annotations

import datetime

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keeprate.catalog.common import (
    SMOOTH_PROBABILITY_SQL, USAGE_SQL, kept_usage, registered, rounded, scored, scored_sql, smooth_probability, usage,
)
from keeprate.catalog.sources import EVENT_SQL, SHOWN_SQL, _shown, event_log
from keeprate.operators import encode, folded, importance, kernel, metrics, neighbors, network, resample
from keeprate.plans import models, recipes
from keeprate.plans.run import train_and_evaluate
from keeprate.plans.scoring import report_table, score, score_records, summary
from keeprate.plans.usage import held_out_rows, train_rows
from keeprate.schema import FEATURES
from keeprate.session import scratch_path, settled, table
from keeprate.sources import events, files
from keeprate.streaming import ingest, score as score_streaming, spans as span_streaming

# Parameters of the network whose slopes are compared: two hidden weights a feature, two offsets, two output weights, an offset.
NETWORK = [0.1, -0.2, -0.4, 0.3, 0.01, 0.02, -0.9, -1.8, 0.5, -0.7, 0.2]
SLOPES = ["loss", *(f"{f}_{unit}" for f in ("cs_calls", "intl_flag", "area_code", "offset", "output") for unit in (1, 2)), "output_offset", "rows"]
NUMBERS = [c for c in FEATURES if c not in ("state", "intl_plan", "vmail_plan")]
PENALTY = 0.01
TRIALS = 50  # of the registered searches, as by default


def _points(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), "label"
    )


# ---- neighbours ----------------------------------------------------------------------


def j01_column_concat(spark, folder):
    """Encoded blocks side by side, made on the same rows instead of joined by position."""
    u = usage(spark, folder)
    return encode.one_hot(encode.plan_flags(u), "area_code", [100, 101, 102]).select(
        "customer_id", "intl_plan", "vmail_plan", "area_code_100", "area_code_101", "area_code_102"
    )


def j02_nearest_neighbors(spark, folder):
    found = neighbors.nearest_neighbors(_points(spark, folder), 5)
    return found.select("id", F.col("rank").cast("int").alias("rank"), "neighbor_id", F.round("distance", 6).alias("distance"))


def j02_nearest_neighbors_cells(spark, folder):
    """The same join over many cells and blocks."""
    found = neighbors.nearest_neighbors(_points(spark, folder), 5, cell_rows=60, block_rows=50)
    return found.select("id", F.col("rank").cast("int").alias("rank"), "neighbor_id", F.round("distance", 6).alias("distance"))


def m10_knn_vote(spark, folder):
    return neighbors.knn_vote(_points(spark, folder), 5).select("id", "prediction", "votes")


def m10_knn_probability(spark, folder):
    """Vote of the five training customers nearest in scaled usage."""
    columns = ["account_length", "day_charge", "eve_charge", "cs_calls"]
    u = kept_usage(spark, folder)

    def points(rows):
        scaled = encode.standard_scaled(train_rows(u), columns, rows)
        return scaled.select(
            F.col("customer_id").alias("id"), F.col("churn").cast("int").alias("label"),
            F.array(*columns).alias("vector"),
        )

    found = neighbors.knn_probability(points(train_rows(u)), points(held_out_rows(u)))
    return found.select("id", F.round("probability", 6).alias("probability"))


# ---- metrics -------------------------------------------------------------------------


def _labels(spark, folder):
    return table(spark, folder, "labels").select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


def a22_confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_labels(spark, folder))


def a22_confusion_matrix_classes(spark, folder):
    voted = neighbors.knn_vote(_points(spark, folder), 5)
    return metrics.confusion_matrix(voted)


def a23_scores(spark, folder):
    found = metrics.binary_scores(scored(spark, folder)).select("accuracy", "precision", "recall", "f1_score")
    return rounded(found, {c: 9 for c in found.columns})


def a24_classification_report(spark, folder):
    found = metrics.classification_report(_labels(spark, folder))
    return rounded(found, {c: 9 for c in ("precision", "recall", "f1_score")})


def a25_roc_auc(spark, folder):
    tied = metrics.roc_auc(scored(spark, folder)).withColumn("score", F.lit("cs_calls"))
    smooth = metrics.roc_auc(scored(spark, folder, smooth_probability())).withColumn("score", F.lit("account_length"))
    return rounded(tied.unionByName(smooth), {"roc_auc": 9})


def a26_roc_curve(spark, folder):
    points = metrics.roc_curve(scored(spark, folder, smooth_probability()))
    return rounded(points, {"threshold": 9, "fpr": 9, "tpr": 9})


def a26_roc_curve_corners(spark, folder):
    points = metrics.roc_curve(scored(spark, folder, smooth_probability()), drop_collinear=True)
    return rounded(points, {"threshold": 9, "fpr": 9, "tpr": 9})


def a27_log_loss(spark, folder):
    return rounded(metrics.log_loss(scored(spark, folder, smooth_probability())), {"log_loss": 9})


def a28_cohen_kappa(spark, folder):
    return rounded(metrics.binary_scores(_labels(spark, folder)).select("cohen_kappa"), {"cohen_kappa": 9})


def a29_matthews_correlation(spark, folder):
    return rounded(
        metrics.binary_scores(scored(spark, folder)).select("matthews_corrcoef"), {"matthews_corrcoef": 9}
    )


def a30_fold_mean_std(spark, folder):
    """Churn rate per fold, then its mean and deviation over the folds."""
    folded = _folded(spark, folder)
    rates = folded.groupBy("fold").agg(F.avg("label").alias("value")).withColumn("metric", F.lit("churn_rate"))
    return rounded(metrics.mean_and_std(rates), {"mean": 9, "std": 9})


def _folded(spark, folder):
    rows = train_rows(kept_usage(spark, folder)).select("customer_id", F.col("churn").cast("int").alias("label"), *[
        c for c in FEATURES if c not in ("state", "intl_plan", "vmail_plan")
    ])
    return models.stratified_folds(rows)


# ---- rebalancing ---------------------------------------------------------------------


def _encoded_train(spark, folder):
    train = train_rows(kept_usage(spark, folder))
    return recipes.encode(recipes.fit_features(train, "full"), train)


def m01_synthetic_counts(spark, folder):
    """Rows per class before and after synthesis."""
    rows = settled(recipes.as_points(_encoded_train(spark, folder)), "rows")
    added = resample.synthesize(rows)
    return rows.select("label", F.lit(False).alias("synthetic")).unionByName(
        added.select("label", F.lit(True).alias("synthetic"))
    ).groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


def m01_neighbor_cleaning(spark, folder):
    """Training customers whose three nearest in usage have their own class."""
    rows = train_rows(kept_usage(spark, folder)).select(
        F.col("customer_id").alias("id"), F.col("churn").cast("int").alias("label"),
        F.array(*[F.col(c).cast("double") for c in ("account_length", "cs_calls", "day_calls")]).alias("vector"))
    return resample.edited(settled(rows, "rows"), 3).select("id", "label")


def m01_rebalance(spark, folder):
    rows = recipes.as_points(_encoded_train(spark, folder))
    return resample.rebalance(rows).groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


# ---- training ------------------------------------------------------------------------


def _split(spark, folder):
    u = kept_usage(spark, folder)
    return train_rows(u), held_out_rows(u)


def _fitted(spark, folder, estimator, recipe="basic", **options):
    train, test = _split(spark, folder)
    return recipes.fit(train, estimator, recipe, **options), test


def _contract(scored, test, floor, probability="probability", prediction="prediction"):
    """Per test customer: probability within 0..1, class on the right side of one half; the area under ROC reaches ``floor``."""
    scored = settled(scored.select("customer_id", F.col(probability).alias("p"), F.col(prediction).cast("int").alias("said")), "contract")
    labelled = test.select("customer_id", F.col("churn").cast("int").alias("label")).join(scored, "customer_id")
    area = metrics.roc_auc(labelled, "label", "p").select((F.col("roc_auc") >= floor).alias("ranks_well"))
    return scored.join(area).select(
        "customer_id", F.col("p").between(0, 1).alias("in_range"), ((F.col("p") > 0.5) == (F.col("said") == 1)).alias("consistent"),
        "ranks_well")


def _predictions(spark, folder, name, floor):
    train, test = _split(spark, folder)
    prepared = recipes.prepare(train, "basic")
    return _contract(models.fit_and_score(name, prepared.train, prepared.transform(test)), test, floor)


def _production(spark, folder, name, floor, recipe="basic", **options):
    model, test = _fitted(spark, folder, models.production_model(name), recipe, **options)
    return _contract(score(model, test), test, floor, "churn_probability", "churn_prediction")


def m02_random_forest(spark, folder):
    return _production(spark, folder, "random_forest", 0.6)


def m03_boosted_trees(spark, folder):
    return _production(spark, folder, "boosted_trees", 0.5)


def m04_model_names(spark, folder):
    """Which of the text columns' values name a trainable model."""
    from keeprate.plans.models import PRODUCTION

    known = F.col("value").isin(list(PRODUCTION))
    return usage(spark, folder).select(F.explode(F.array("state", F.lit("random_forest"), F.lit("boosted_trees"))).alias("value")) \
        .groupBy("value").agg(F.first(known).alias("supported"), F.count(F.lit(1)).alias("n"))


def m05_logistic_regression(spark, folder):
    return _predictions(spark, folder, "logistic_regression", 0.6)


def m05_moments(spark, folder):
    """Sums of each feature by fitted probability. Where the likelihood is largest they equal the sums by label, and nowhere else."""
    train, _ = _coarse(spark, folder)
    model = LogisticRegression(regParam=0.0, maxIter=500, tol=1e-14, featuresCol="features", labelCol="label").fit(train)
    scored = models.positive_probability(model.transform(train))
    sums = [(name, F.sum(F.col("probability") * F.col(name))) for name in STUMP] + [("intercept", F.sum("probability"))]
    return scored.agg(F.array(*[F.struct(F.lit(name).alias("feature"), F.round(total, 1).alias("expected")) for name, total in sums])
                      .alias("sums")).select(F.inline("sums"))


def m06_support_vector_machine(spark, folder):
    return _predictions(spark, folder, "support_vector_machine", 0.6)


def m06_calibration(spark, folder):
    """Service calls as a margin, calibrated on the training customers: probability of each test customer."""
    train, test = (t.select("customer_id", F.col("churn").cast("int").alias("label"), F.col("cs_calls").alias("margin")) for t in _split(spark, folder))
    slope, offset = kernel.sigmoid(train)
    return test.select("customer_id", F.round(1 / (1 + F.exp(-(F.lit(slope) * F.col("margin") + F.lit(offset)))), 6).alias("probability"))


def m07_decision_tree(spark, folder):
    return _predictions(spark, folder, "decision_tree", 0.45)


STUMP = ["cs_calls", "intl_flag", "area_code"]


def _stump(spark, folder):
    train, test = (t.withColumns({"label": F.col("churn").cast("double"), "intl_flag": (F.col("intl_plan") == "Yes").cast("int")})
                   for t in _split(spark, folder))
    build = encode.assembler(STUMP, "features")
    tree = DecisionTreeClassifier(maxDepth=1, featuresCol="features", labelCol="label", weightCol="weight")
    return tree.fit(build.transform(metrics.with_class_weight(train))), build.transform(test)


def m07_depth_one_tree(spark, folder):
    """A tree of one split, with balanced classes, has a closed form."""
    model, test = _stump(spark, folder)
    return model.transform(test).select("customer_id", F.round(vector_to_array("probability")[1], 9).alias("probability"))


def a31_depth_one_importance(spark, folder):
    """The one feature of a tree of one split has all importance."""
    model, _ = _stump(spark, folder)
    return importance.importances(spark, model, STUMP)


def _coarse(spark, folder):
    """(train, test) vectors of three features with few values, whose splits SQL can follow."""
    train, test = (t.withColumns({"label": F.col("churn").cast("double"), "intl_flag": (F.col("intl_plan") == "Yes").cast("int")})
                   for t in _split(spark, folder))
    build = encode.assembler(STUMP, "features")
    return build.transform(train), build.transform(test)


def _probabilities(model, rows):
    return model.transform(rows).select("customer_id", F.round("probability", 6).alias("probability"))


def m02_depth_two_tree(spark, folder):
    """A tree of two levels on all rows and columns, by Gini, at the production limits of rows."""
    train, test = _coarse(spark, folder)
    tree = models.production_model("random_forest", numTrees=1, maxDepth=2, bootstrap=False, featureSubsetStrategy="all")
    return _probabilities(tree.fit(train), test)


def _two_rounds(spark, folder):
    train, test = _coarse(spark, folder)
    settings = dict(maxIter=2, maxDepth=1, subsamplingRate=1.0, featureShare=1.0)
    return models.production_model("boosted_trees", **settings).fit(train), test


def m03_two_rounds(spark, folder):
    """Two rounds of one split by second-order gain: splits and leaf values have a closed form."""
    return _probabilities(*_two_rounds(spark, folder))


def a32_two_round_gains(spark, folder):
    """Splits and mean gain of each feature of the two-round model."""
    found = importance.split_importances(spark, _two_rounds(spark, folder)[0], STUMP)
    return found.select("feature", "weight", F.round("gain", 3).alias("gain"))


def m08_balanced_forest(spark, folder):
    return _predictions(spark, folder, "random_forest", 0.6)


BAYES = ["account_length", "cs_calls", "day_calls"]


def _bayes(spark, folder):
    """Gaussian naive Bayes on three measures, whose predictions have a closed form: (pipeline, test rows)."""
    train, test = _split(spark, folder)
    build = encode.assembler(BAYES, "features")
    rows = build.transform(train.withColumn("label", F.col("churn").cast("double")))
    model = NaiveBayes(modelType="gaussian", featuresCol="features", labelCol="label").fit(rows)
    return PipelineModel([build, model]), test


def m09_naive_bayes(spark, folder):
    model, test = _bayes(spark, folder)
    return model.transform(test).select(
        "customer_id", F.round(vector_to_array("probability")[1], 5).alias("probability"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def m11_gradient_boosting(spark, folder):
    return _predictions(spark, folder, "gradient_boosting", 0.55)


def m11_two_rounds(spark, folder):
    """Gradient boosting of two trees of one split: the first fits the classes, the second the slope of the loss."""
    train, test = _coarse(spark, folder)
    model = models.research_model("gradient_boosting", len(STUMP), rounds=2).setMaxDepth(1).fit(train)
    return models.positive_probability(model.transform(test)).select("customer_id", F.round("probability", 6).alias("probability"))


def m12_adaboost(spark, folder):
    return _predictions(spark, folder, "adaboost", 0.6)


def m12_three_rounds(spark, folder):
    """Three reweighting rounds, whose stumps and votes have a closed form."""
    train, test = _coarse(spark, folder)
    return _probabilities(models.research_model("adaboost", len(STUMP), rounds=3).fit(train), test)


def m13_neural_network(spark, folder):
    return _predictions(spark, folder, "neural_network", 0.55)


def m13_slopes(spark, folder):
    """Summed log loss of a network of two hidden units, and its slope by each of its parameters."""
    train, _ = _coarse(spark, folder)
    blocks = network.Blocks(train.select("label", vector_to_array("features").alias("values")), seed=42, batches=1)
    sums = blocks.sums(np.array(NETWORK), 2, 0) * network.UNIT
    rows = [(name, float(value)) for name, value in zip(SLOPES, sums)]
    return rounded(spark.createDataFrame(rows, "name string, value double"), {"value": 3})


def m14_stratified_folds(spark, folder):
    return _folded(spark, folder).select("customer_id", "label", "fold")


def m14_cross_validation(spark, folder):
    """Area under ROC of naive Bayes, mean and deviation over the folds."""
    folds = settled(encode.assembler(BAYES, "features").transform(_folded(spark, folder)), "folds")
    estimator = NaiveBayes(modelType="gaussian", featuresCol="features", labelCol="label")
    return rounded(metrics.mean_and_std(models.cross_validate(folds, estimator)), {"mean": 6, "std": 6})


def m14_shared_bayes(spark, folder):
    """Area under ROC of naive Bayes on all numeric features; one scan fits the models of all folds."""
    found = folded.bayes_margins(settled(_folded(spark, folder), "folds"), NUMBERS)
    areas = metrics.roc_auc_by(found, "fold", score="margin").withColumn("metric", F.lit("roc_auc"))
    return rounded(metrics.mean_and_std(areas), {"mean": 6, "std": 6})


def m14_shared_logistic(spark, folder):
    """Mean of each scaled feature by fitted probability plus what the penalty pulls, for the model without each fold.

    At the optimum this is the mean by label, and nowhere else.
    """
    rows = settled(_folded(spark, folder), "folds")
    shape = rows.agg(*[f(c) for c in NUMBERS for f in (F.avg, F.stddev_pop)]).first()
    scaled = [(F.col(c) - float(shape[2 * i])) / float(shape[2 * i + 1]) for i, c in enumerate(NUMBERS)]
    rows = settled(rows.select("label", "fold", F.array(*scaled).alias("values")), "scaled")
    fits = folded.fit_logistic(rows, [PENALTY])
    taught = rows.select("values", F.explode(F.filter(F.array(*map(F.lit, fits.folds)), lambda f: f != F.col("fold"))).alias("fold"))
    p = 1 / (1 + F.exp(-F.col("margins")[0]))
    sums = fits.margins(taught).select("fold", p.alias("p"), F.posexplode(F.concat("values", F.array(F.lit(1.0)))).alias("i", "x")).groupBy(
        "fold", "i").agg(F.avg(F.col("p") * F.col("x")).alias("mean"))
    pulls = [(fold, i, name, float(w) * (PENALTY if i < len(NUMBERS) else 0.0))
             for j, fold in enumerate(fits.folds) for i, (name, w) in enumerate(zip([*NUMBERS, "intercept"], fits.weights[0, j]))]
    pulls = spark.createDataFrame(pulls, "fold int, i int, feature string, pull double")
    return sums.join(pulls, ["fold", "i"]).select("fold", "feature", F.round(F.col("mean") + F.col("pull"), 7).alias("expected"))


def m15_model_comparison(spark, folder):
    """All ten models: every metric is there and in its range."""
    train, test = _split(spark, folder)
    prepared = recipes.prepare(train, "basic")
    found = models.compare(prepared.train, settled(prepared.transform(test), "held-out"))
    low = F.when(F.col("metric").isin("cohen_kappa", "matthews_corrcoef"), -1.0).otherwise(0.0)
    high = F.when(F.col("metric").isin("tn", "fp", "fn", "tp", "log_loss"), float("inf")).otherwise(1.0)
    return found.select("model", "metric", F.coalesce(F.col("value").between(low, high), F.lit(False)).alias("in_range"))


def _searched(spark, folder, name):
    train, _ = _split(spark, folder)
    trials = models.search_parameters(recipes.prepare(train, "basic").train, name, trials=TRIALS, parallelism=8)[1]
    return trials.select("trial", F.size("settings").alias("n_settings"), F.col("accuracy").between(0.5, 1).alias("in_range"))


def m16_forest_search(spark, folder):
    return _searched(spark, folder, "random_forest")


def m17_boosted_search(spark, folder):
    return _searched(spark, folder, "boosted_trees")


def m18_refit_best(spark, folder):
    """Predictions of the best model of a search, refitted on all training rows."""
    train, test = _split(spark, folder)
    prepared = recipes.prepare(train, "basic")
    search, _ = models.search_parameters(prepared.train, "random_forest", trials=TRIALS, parallelism=8)
    return _contract(score(prepared.model(search.bestModel), test), test, 0.6, "churn_probability", "churn_prediction")


def m19_top_features(spark, folder):
    return _production(spark, folder, "random_forest", 0.5, "full", subset=recipes.FOREST_SUBSET)


def m19_top_features_boosted(spark, folder):
    return _production(spark, folder, "boosted_trees", 0.45, "full", subset=recipes.BOOSTED_SUBSET)


def _linear(spark, folder):
    return _fitted(spark, folder, LogisticRegression(regParam=0.01, maxIter=50), "full")


def m20_prediction_contract(spark, folder):
    """Per test customer: probability within 0..1, class on the right side of one half."""
    model, test = _linear(spark, folder)
    found = score(model, test)
    p = F.col("churn_probability")
    return found.select(
        "customer_id", p.between(0, 1).alias("in_range"),
        ((p > 0.5) == (F.col("churn_prediction") == 1)).alias("consistent"),
    )


def m21_batch_scoring(spark, folder):
    """Batch summary of a fitted model."""
    model, test = _bayes(spark, folder)
    return rounded(summary(score(model, test)), {"churn_percentage": 6})


def m21_batch_report(spark, folder):
    """Numbered report of a fitted model: every test customer once, in key order."""
    model, test = _bayes(spark, folder)
    return report_table(score(model, test))


def m21_rejected_records(spark, folder):
    """Records with missing and malformed values are set aside, the others are scored."""
    model, test = _bayes(spark, folder)
    raw = files.to_external(test.select("customer_id", *[F.col(c).cast("string").alias(c) for c in FEATURES]))
    broken = raw.withColumns({
        "Total day calls": F.when(F.col("customer_id") % 7 == 3, "oops").otherwise(F.col("Total day calls")),
        "State": F.when(F.col("customer_id") % 11 != 4, F.col("State")),
        "International plan": F.when(F.col("customer_id") % 13 == 5, "Maybe").otherwise(F.col("International plan")),
    })
    predictions, rejected = score_records(model, broken, ["customer_id"])
    return predictions.select("customer_id", F.lit("").alias("faults")).unionByName(
        rejected.select("customer_id", F.array_join("faults", ",").alias("faults")))


def m22_timing(spark, folder):
    train, test = _split(spark, folder)
    prepared = recipes.prepare(train, "basic")
    found = models.timed_fit_and_predict(models.production_model("random_forest"), prepared.train, prepared.transform(test))
    return found.select("step", (F.col("seconds") > 0).alias("measured"))


def m23_full_evaluation(spark, folder):
    """Every metric of naive Bayes on the test rows."""
    model, test = _bayes(spark, folder)
    found = models.positive_probability(model.transform(test.withColumn("label", F.col("churn").cast("int"))))
    return rounded(metrics.evaluate(found), {"value": 5})


def m23_training_run(spark, folder):
    """A whole run on rebalanced rows: events by stage, rows of the evaluation tables, scores of the version."""
    train, test = _split(spark, folder)
    run = train_and_evaluate(
        spark, train, test, scratch_path(spark, "run"), balance={"k": 3}, run_id="run-1")
    log = events.read_log(spark, run.log).filter(F.col("run_id") == "run-1")
    stages = log.filter("stage <> 'parameters'").groupBy(F.col("stage").alias("part")).agg(F.count("*").alias("n"))
    held = log.filter("stage = 'data_preparation'").select(
        F.lit("test_samples").alias("part"), F.element_at("extra", "test_samples").cast("long").alias("n"))
    matrix = spark.read.parquet(run.evaluation("matrix")).agg(F.lit("matrix").alias("part"), F.sum("n").alias("n"))
    report = spark.read.parquet(run.evaluation("report")).agg(F.lit("report").alias("part"), F.count("*").alias("n"))
    listed = run.scores(spark).groupBy(F.concat(F.lit("scores "), "version").alias("part")).agg(F.count("*").alias("n"))
    return stages.union(held).union(matrix).union(report).union(listed)


def m23_score_evaluation(spark, folder):
    """The same metrics of a score that SQL can compute."""
    found = metrics.evaluate(scored(spark, folder, smooth_probability()))
    return rounded(found, {"value": 9})


def _importance_contract(found, column):
    return found.agg(
        (F.min(column) >= 0).alias("none_negative"), (F.count("*") <= len(FEATURES)).alias("within_features"),
        (F.count_distinct("feature") == F.count("*")).alias("each_once"))


def a31_importances(spark, folder):
    train, _ = _split(spark, folder)
    prepared = recipes.prepare(train, "basic")
    model = models.production_model("random_forest").fit(prepared.train)
    found = importance.importances(spark, model, prepared.names)
    return _importance_contract(found, "importance").withColumn(
        "sums_to_one", F.lit(abs(found.agg(F.sum("importance")).first()[0] - 1) < 1e-9))


def a32_split_importances(spark, folder):
    train, _ = _split(spark, folder)
    prepared = recipes.prepare(train, "basic")
    model = models.production_model("boosted_trees").fit(prepared.train)
    return _importance_contract(importance.split_importances(spark, model, prepared.names), "gain")


def s12_save_and_load(spark, folder):
    """Customers scored alike by a pipeline and by its saved copy."""
    model, test = _linear(spark, folder)
    path = scratch_path(spark, "pipeline")
    recipes.save(model, path)
    return _agreement(score(model, test), score(recipes.load(path), test))


def _agreement(first, second):
    other = second.select("customer_id", F.col("churn_probability").alias("again"))
    return first.join(other, "customer_id", "left").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count(F.when(F.abs(F.col("again") - F.col("churn_probability")) < 1e-9, 1)).alias("alike"),
    )


def r07_snapshot(spark, folder):
    """A model saved under its version; the copy is loaded and scores every customer alike."""
    from keeprate.sources import versions

    model, test = _linear(spark, folder)
    path = scratch_path(spark, "registry")
    rows = test.agg(F.max("account_length").alias("n")).select(
        F.lit("1.1").alias("version"), F.timestamp_seconds("n").alias("timestamp")
    )
    versions.snapshot(model, rows, path, "1.1")
    again = PipelineModel.load(f"{path}/versions/v1.1/model")
    agreed = _agreement(score(model, test), score(again, test))
    return agreed.withColumn("version", F.lit(spark.read.parquet(f"{path}/history").first()["version"]))


# ---- streams -------------------------------------------------------------------------


def x01_streaming_ingest(spark, folder):
    """JSON event files through the stream into the day-partitioned log."""
    source, target = scratch_path(spark, "events-json"), scratch_path(spark, "log")
    event_log(spark, folder).drop("log_date").write.option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    ).json(source)
    broken = table(spark, folder, "events").select(F.lit('{"ts": 12, "level').alias("value"))
    broken.write.mode("append").text(source)
    query = ingest.ingest(
        ingest.event_stream(spark, source), target, scratch_path(spark, "ingest-checkpoint")
    )
    query.awaitTermination()
    return _shown(events.read_log(spark, target))


def x01_streaming_run_spans(spark, folder):
    """Spans of runs from a stream that stops in between and brings late and repeated events."""
    source, target, state = (scratch_path(spark, name) for name in ("events-json", "spans", "span-state"))
    log = settled(event_log(spark, folder).drop("log_date"), "log")
    ends = log.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    cut = ends.low + (ends.high - ends.low) / 2
    day_before = F.col("ts").between(cut - datetime.timedelta(days=1), cut)
    late = day_before & (F.length("message") % 2 == 0)
    repeated = log.filter(day_before & ~late)
    beat = log.limit(1).withColumns({"ts": F.lit(ends.high + datetime.timedelta(days=30)), "run_id": F.lit("beat")})
    for part in (log.filter((F.col("ts") <= cut) & ~late), log.filter((F.col("ts") > cut) | late).unionByName(repeated), beat):
        part.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(source)
        stream = ingest.event_stream(spark, source)
        span_streaming.write_spans(stream, target, state, "2 days", "1 day").awaitTermination()
    whole = span_streaming.merged(spark.read.parquet(target))
    return whole.select(
        "run_id", F.unix_micros("started").alias("started_us"), F.unix_micros("ended").alias("ended_us"),
        "events", F.round("duration", 6).alias("duration"))


def x02_streaming_scoring(spark, folder):
    """Customers scored by the stream, malformed records beside them, and in a batch: all alike."""
    model, test = _linear(spark, folder)
    source, target = scratch_path(spark, "customers-json"), scratch_path(spark, "predictions")
    files.to_external(test.select("customer_id", *FEATURES)).write.json(source)
    broken = test.filter("customer_id % 10 = 4").select(F.concat(F.lit('{"customer_id": '), "customer_id", F.lit(', "State')).alias("value"))
    broken.write.mode("append").text(source)
    query = score_streaming.score_stream(
        model, score_streaming.customer_stream(spark, source), target, scratch_path(spark, "score-checkpoint")
    )
    query.awaitTermination()
    return _agreement(score(model, test), spark.read.parquet(target))


QUERIES = registered(globals())

_KNN = """WITH p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
  d AS (SELECT a.id, a.label, b.id AS neighbor_id, b.label AS neighbor_label, list_distance(a.v, b.v) AS distance
    FROM p a JOIN p b ON a.id <> b.id),
  r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbor_id) AS rank FROM d)"""
_VOTE = _KNN + """, votes AS (SELECT id, label, neighbor_label, count(*) AS votes FROM r WHERE rank <= 5 GROUP BY ALL),
  best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY votes DESC, neighbor_label) AS place FROM votes)"""
_TRAIN_TEST = f"""{USAGE_SQL}, train AS (SELECT * FROM usage WHERE split = 'train'),
  test AS (SELECT * FROM usage WHERE split = 'test')"""
_CELLS = """count(CASE WHEN label = 0 AND prediction = 0 THEN 1 END) * 1.0e0 AS tn,
  count(CASE WHEN label = 0 AND prediction = 1 THEN 1 END) * 1.0e0 AS fp,
  count(CASE WHEN label = 1 AND prediction = 0 THEN 1 END) * 1.0e0 AS fn,
  count(CASE WHEN label = 1 AND prediction = 1 THEN 1 END) * 1.0e0 AS tp"""
_LABELS = "SELECT quality AS label, toxic AS prediction FROM labels"
_AUC = """SELECT '{name}' AS score, round(sum(pos * (below + neg / 2.0e0)) / (sum(pos) * sum(neg)), 9) AS roc_auc FROM (
    SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM (SELECT {p} AS p, count(CASE WHEN churn THEN 1 END) * 1.0e0 AS pos, count(CASE WHEN NOT churn THEN 1 END) * 1.0e0 AS neg
      FROM usage GROUP BY 1))"""
_CURVE = f"""{USAGE_SQL}, steps AS (
    SELECT {SMOOTH_PROBABILITY_SQL} AS threshold, count(CASE WHEN churn THEN 1 END) AS pos, count(CASE WHEN NOT churn THEN 1 END) AS neg
    FROM usage GROUP BY 1),
  curve AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n,
      lead(pos) OVER (ORDER BY threshold DESC) AS next_pos, lead(neg) OVER (ORDER BY threshold DESC) AS next_neg,
      row_number() OVER (ORDER BY threshold DESC) AS place
    FROM steps WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  SELECT round(threshold, 9) AS threshold, round(CAST(fp AS DOUBLE) / n, 9) AS fpr, round(CAST(tp AS DOUBLE) / p, 9) AS tpr FROM curve"""
_ORIGIN = " UNION ALL SELECT CAST('inf' AS DOUBLE), 0e0, 0e0"
_FOLDS = f"""{_TRAIN_TEST}, ranked AS (
    SELECT customer_id, CAST(churn AS INTEGER) AS label, row_number() OVER (PARTITION BY churn ORDER BY customer_id) AS place FROM train),
  firsts AS (SELECT label, min(customer_id) AS first, count(*) AS n FROM ranked GROUP BY label),
  starts AS (SELECT label, n, coalesce(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM firsts),
  sizes AS (SELECT label, fold, (SELECT count(*) FROM range(CAST(start AS BIGINT), CAST(start + n AS BIGINT)) t(i) WHERE i % 5 = fold) AS size
    FROM starts, (SELECT unnest(range(5)) AS fold)),
  limits AS (SELECT label, fold, sum(size) OVER (PARTITION BY label ORDER BY fold) AS upto FROM sizes),
  folded AS (SELECT customer_id, ranked.label, CAST(min(fold) AS INTEGER) AS fold FROM ranked JOIN limits
    ON ranked.label = limits.label AND place <= upto GROUP BY ALL)"""
def _bayes_sql(train: str, test: str, by: str = "", columns: list[str] = BAYES) -> str:
    """CTEs ending in ``nb`` (customer_id, label, p, prediction[, by]); ``by`` separates models and their test rows."""
    comma, same = (f", {by}", f"x.{by} = y.{by}") if by else ("", "true")
    group = f" GROUP BY {by}" if by else ""
    return f"""eps AS (SELECT 1e-9 * greatest({', '.join(f'var_pop({c})' for c in columns)}) AS e, count(*) AS total{comma} FROM {train}{group}),
  stats AS (SELECT CAST(x.churn AS INTEGER) AS class, ln(count(*) * 1.0e0 / any_value(total)) AS prior{comma.replace(' ', ' x.')},
    {', '.join(f'avg({c}) AS m_{c}, var_pop({c}) + any_value(e) AS v_{c}' for c in columns)}
    FROM {train} x JOIN eps y ON {same} GROUP BY x.churn{comma.replace(' ', ' x.')}),
  logs AS (SELECT customer_id, churn, class{comma.replace(' ', ' x.')}, prior + {' + '.join(f'(-0.5e0 * ln(2e0 * pi() * v_{c}) - pow({c} - m_{c}, 2) / (2e0 * v_{c}))' for c in columns)} AS l
    FROM {test} x JOIN stats y ON {same}),
  wide AS (SELECT customer_id, CAST(any_value(churn) AS INTEGER) AS label{comma}, max(CASE WHEN class = 1 THEN l END) AS l1,
    max(CASE WHEN class = 0 THEN l END) AS l0 FROM logs GROUP BY customer_id{comma}),
  nb AS (SELECT customer_id, label{comma}, 1e0 / (1e0 + exp(l0 - l1)) AS p, CAST(l1 > l0 AS INTEGER) AS prediction FROM wide)"""


_NB_CTE = f"{_TRAIN_TEST}, {_bayes_sql('train', 'test')}"
_NB_SQL = _NB_CTE + " SELECT customer_id, round(p, 5) AS probability, prediction FROM nb"
_CONTRACT = f"{_TRAIN_TEST} SELECT customer_id, true AS in_range, true AS consistent, true AS ranks_well FROM test"
# Cuts of three coarse features: sums of a statistic left and right of each.
_COARSE = f"""{_TRAIN_TEST}, coarse AS (SELECT customer_id, split, CAST(churn AS DOUBLE) AS y, cs_calls * 1e0 AS f0,
    CASE intl_plan WHEN 'Yes' THEN 1e0 ELSE 0e0 END AS f1, area_code * 1e0 AS f2 FROM usage),
  wide AS (SELECT customer_id, split, y, unnest([0, 1, 2]) AS f, unnest([f0, f1, f2]) AS x FROM coarse),
  cut AS (SELECT DISTINCT f, x AS c FROM wide WHERE split = 'train')"""


_W = [f"{w}e0" for w in NETWORK]
_SLOPES_SQL = _COARSE + f""", inner_sums AS (SELECT y, f0, f1, f2,
    f0 * ({_W[0]}) + f1 * ({_W[2]}) + f2 * ({_W[4]}) + ({_W[6]}) AS z1, f0 * ({_W[1]}) + f1 * ({_W[3]}) + f2 * ({_W[5]}) + ({_W[7]}) AS z2
    FROM coarse WHERE split = 'train'),
  active AS (SELECT *, greatest(z1, 0e0) AS a1, greatest(z2, 0e0) AS a2 FROM inner_sums),
  margins AS (SELECT *, a1 * ({_W[8]}) + a2 * ({_W[9]}) + ({_W[10]}) AS m FROM active),
  pushes AS (SELECT *, 1 / (1 + exp(-m)) - y AS p FROM margins),
  backs AS (SELECT *, CASE WHEN z1 > 0 THEN p * ({_W[8]}) ELSE 0e0 END AS b1, CASE WHEN z2 > 0 THEN p * ({_W[9]}) ELSE 0e0 END AS b2 FROM pushes),
  summed AS (SELECT [sum(ln(1 + exp(m)) - y * m), {", ".join(f"sum({f} * b{u})" for f in ("f0", "f1", "f2", "1") for u in (1, 2))},
    sum(a1 * p), sum(a2 * p), sum(p), count(*)] AS all_sums FROM backs)
  SELECT unnest([{", ".join(f"'{n}'" for n in SLOPES)}]) AS name, round(unnest(all_sums), 3) AS value FROM summed"""


def _round_sql(number: int, rate: float) -> str:
    """One boosting round of one split: ``best``, then the rows' margins after it."""
    before = f"m{number - 1}"
    sums = ", ".join(f"sum(CASE WHEN x {op} c THEN {v} ELSE 0 END) AS {v}{side}" for op, side in (("<=", "l"), (">", "r")) for v in "gh")
    return f"""g{number} AS (SELECT customer_id, 1e0 / (1e0 + exp(-margin)) - y AS g, exp(-margin) / (1e0 + exp(-margin)) ** 2 AS h FROM {before}),
  s{number} AS (SELECT cut.f, c, {sums} FROM cut JOIN wide w ON cut.f = w.f AND split = 'train' JOIN g{number} g ON g.customer_id = w.customer_id GROUP BY cut.f, c),
  b{number} AS (SELECT *, gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - (gl + gr) ** 2 / (hl + hr + 1) AS gain FROM s{number}
    WHERE hl >= 1 AND hr >= 1 ORDER BY gain DESC, f, c LIMIT 1),
  m{number} AS (SELECT m.customer_id, y, margin - {rate} * CASE WHEN x <= c THEN gl / (hl + 1) ELSE gr / (hr + 1) END AS margin
    FROM {before} m CROSS JOIN b{number} b JOIN (SELECT customer_id, f, x FROM wide) w ON w.customer_id = m.customer_id AND w.f = b.f)"""


_TWO_ROUNDS = f"{_COARSE}, m0 AS (SELECT customer_id, y, 0e0 AS margin FROM coarse), {_round_sql(1, 0.1)}, {_round_sql(2, 0.1)}"


_MEAN_SUMS = "sum(CASE WHEN x <= c THEN r END) / count(CASE WHEN x <= c THEN 1 END) AS low, sum(CASE WHEN x > c THEN r END) / count(CASE WHEN x > c THEN 1 END) AS high"


def _mean_split(number: int, target: str, rate: float) -> str:
    """A regression tree of one split on ``target`` of the rows' margins; then the margins with it."""
    before = f"v{number - 1}"
    return f"""r{number} AS (SELECT customer_id, {target} AS r FROM {before}),
  p{number} AS (SELECT cut.f, c, sum(CASE WHEN x <= c THEN r END) ** 2 / count(CASE WHEN x <= c THEN 1 END)
      + sum(CASE WHEN x > c THEN r END) ** 2 / count(CASE WHEN x > c THEN 1 END) AS gain, {_MEAN_SUMS}
    FROM cut JOIN wide w ON cut.f = w.f AND split = 'train' JOIN r{number} r ON r.customer_id = w.customer_id GROUP BY cut.f, c
    HAVING count(CASE WHEN x > c THEN 1 END) > 0 ORDER BY round(gain, 9) DESC, cut.f, c LIMIT 1),
  v{number} AS (SELECT v.customer_id, y, margin + {rate} * CASE WHEN x <= c THEN low ELSE high END AS margin
    FROM {before} v CROSS JOIN p{number} p JOIN (SELECT customer_id, f, x FROM wide) w ON w.customer_id = v.customer_id AND w.f = p.f)"""


_BOOST_TWO = f"""{_COARSE}, v0 AS (SELECT customer_id, 2 * y - 1 AS y, 0e0 AS margin FROM coarse), {_mean_split(1, 'y', 1.0)},
  {_mean_split(2, '4 * y / (1 + exp(2 * y * margin))', 0.1)}"""


def _vote_round(number: int) -> str:
    """One reweighting round over a stump by weighted Gini: ``z`` sums the votes, ``say`` their weights."""
    before = f"a{number - 1}"
    return f"""t{number} AS (SELECT cut.f, c, sum(CASE WHEN x <= c THEN wt ELSE 0 END) AS nl, sum(CASE WHEN x > c THEN wt ELSE 0 END) AS nr,
      sum(CASE WHEN x <= c THEN wt * a.y ELSE 0 END) AS pl, sum(CASE WHEN x > c THEN wt * a.y ELSE 0 END) AS pr
    FROM cut JOIN wide w ON cut.f = w.f AND split = 'train' JOIN {before} a ON a.customer_id = w.customer_id GROUP BY cut.f, c),
  u{number} AS (SELECT f, c, CAST(pl > nl / 2 AS INTEGER) AS low, CAST(pr > nr / 2 AS INTEGER) AS high FROM t{number} WHERE nr > 0
    ORDER BY round((pl * (nl - pl) / nl + pr * (nr - pr) / nr) / (nl + nr), 12), f, c LIMIT 1),
  q{number} AS (SELECT a.*, w.split, CASE WHEN x <= c THEN low ELSE high END AS says FROM {before} a CROSS JOIN u{number} u
    JOIN (SELECT customer_id, f, x, split FROM wide) w ON w.customer_id = a.customer_id AND w.f = u.f),
  e{number} AS (SELECT ln((1 - e) / e) AS s FROM (SELECT sum(CASE WHEN says <> y THEN wt ELSE 0 END) / sum(wt) AS e FROM q{number} WHERE split = 'train')),
  a{number} AS (SELECT customer_id, y, CASE WHEN says <> y THEN wt * exp(s) ELSE wt END AS wt, z + s * (2 * says - 1) AS z, say + s AS say
    FROM q{number} CROSS JOIN e{number})"""


_VOTES_THREE = f"{_COARSE}, a0 AS (SELECT customer_id, y, 1e0 AS wt, 0e0 AS z, 0e0 AS say FROM coarse), " + ", ".join(map(_vote_round, (1, 2, 3)))


def _sigmoid_sql(passes: int) -> str:
    """Newton steps for slope ``a`` and offset ``b`` on (f, t) rows of ``aimed``; the last one is ``n{passes}``."""
    steps = [f"""n{i} AS (SELECT a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a,
      b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM (SELECT a, b, sum((p - t) * f) AS ga, sum(p - t) AS gb,
        sum(p * (1 - p) * f * f) AS haa, sum(p * (1 - p) * f) AS hab, sum(p * (1 - p)) AS hbb
      FROM (SELECT a, b, f, t, 1 / (1 + exp(-(a * f + b))) AS p FROM aimed CROSS JOIN n{i - 1}) GROUP BY a, b))""" for i in range(1, passes + 1)]
    return ", ".join(steps)


_CALIBRATED = f"""{_TRAIN_TEST}, c AS (SELECT count(CASE WHEN churn THEN 1 END) AS up, count(CASE WHEN NOT churn THEN 1 END) AS down FROM train),
  aimed AS (SELECT cs_calls * 1e0 AS f, CASE WHEN churn THEN (up + 1e0) / (up + 2) ELSE 1e0 / (down + 2) END AS t FROM train CROSS JOIN c),
  n0 AS (SELECT 0e0 AS a, ln((up + 1e0) / (down + 1)) AS b FROM c), {_sigmoid_sql(12)}"""


def _gini_split(name: str, rows: str) -> str:
    """The best split by Gini of the training rows in ``rows``: (f, c, left and right shares, whether it may be split)."""
    return f"""{name}s AS (SELECT cut.f, c, count(CASE WHEN x <= c THEN 1 END) AS nl, count(CASE WHEN x > c THEN 1 END) AS nr,
      sum(CASE WHEN x <= c THEN w.y ELSE 0 END) AS pl, sum(CASE WHEN x > c THEN w.y ELSE 0 END) AS pr
    FROM cut JOIN wide w ON cut.f = w.f AND split = 'train' JOIN {rows} r ON r.customer_id = w.customer_id GROUP BY cut.f, c),
  {name} AS (SELECT *, pl / nl AS left_share, pr / nr AS right_share FROM {name}s WHERE nl >= 2 AND nr >= 2 AND nl + nr >= 5 AND pl + pr BETWEEN 1 AND nl + nr - 1
    ORDER BY round(2 * pl * (nl - pl) / nl + 2 * pr * (nr - pr) / nr, 9), f, c LIMIT 1)"""


_DEPTH_TWO = f"""{_COARSE}, {_gini_split('top', 'coarse')},
  sides AS (SELECT w.customer_id, x <= c AS goes_left, left_share, right_share FROM top JOIN wide w ON w.f = top.f),
  lefts AS (SELECT customer_id FROM sides WHERE goes_left), rights AS (SELECT customer_id FROM sides WHERE NOT goes_left),
  {_gini_split('lo', 'lefts')}, {_gini_split('hi', 'rights')}
  SELECT s.customer_id, round(CASE WHEN goes_left THEN coalesce((SELECT CASE WHEN x <= c THEN lo.left_share ELSE lo.right_share END FROM lo JOIN wide w ON w.f = lo.f AND w.customer_id = s.customer_id), left_share)
    ELSE coalesce((SELECT CASE WHEN x <= c THEN hi.left_share ELSE hi.right_share END FROM hi JOIN wide w ON w.f = hi.f AND w.customer_id = s.customer_id), right_share) END, 6) AS probability
  FROM sides s JOIN test t ON t.customer_id = s.customer_id"""
_STUMP_CTE = f"""{_TRAIN_TEST}, coded AS (SELECT customer_id, split, CAST(churn AS INTEGER) AS y, cs_calls * 1.0e0 AS f0,
    CASE intl_plan WHEN 'Yes' THEN 1e0 ELSE 0e0 END AS f1, area_code * 1.0e0 AS f2,
    CASE WHEN churn THEN (SELECT count(*) * 0.5e0 / count(CASE WHEN churn THEN 1 END) FROM train)
      ELSE (SELECT count(*) * 0.5e0 / count(CASE WHEN NOT churn THEN 1 END) FROM train) END AS w FROM usage),
  long AS (SELECT customer_id, split, y, w, unnest([0, 1, 2]) AS f, unnest([f0, f1, f2]) AS x FROM coded),
  cuts AS (SELECT DISTINCT f, x AS cut FROM long WHERE split = 'train'),
  sides AS (SELECT c.f, cut, sum(CASE WHEN x <= cut THEN y * w ELSE 0 END) AS pl, sum(CASE WHEN x <= cut THEN w ELSE 0 END) AS nl,
      sum(CASE WHEN x > cut THEN y * w ELSE 0 END) AS pr, sum(CASE WHEN x > cut THEN w ELSE 0 END) AS nr
    FROM cuts c JOIN long l ON c.f = l.f AND l.split = 'train' GROUP BY c.f, cut),
  best AS (SELECT *, pl / nl AS left_share, pr / nr AS right_share,
      2 * ((pl + pr) / (nl + nr)) * (1 - (pl + pr) / (nl + nr)) - (nl * 2 * (pl / nl) * (1 - pl / nl) + nr * 2 * (pr / nr) * (1 - pr / nr)) / (nl + nr) AS gain
    FROM sides WHERE nr > 0 ORDER BY gain DESC, f, cut LIMIT 1)"""
_NEAR = ["account_length", "day_charge", "eve_charge", "cs_calls"]
_KAPPA = "(acc - chance) / (1 - chance)"
_EVAL = f"""{scored_sql(SMOOTH_PROBABILITY_SQL)}, cells AS (SELECT {_CELLS} FROM scored),
  derived AS (SELECT *, (tn + tp) / (tn + fp + fn + tp) AS acc,
    ((tn + fp) * (tn + fn) + (fn + tp) * (fp + tp)) / pow(tn + fp + fn + tp, 2) AS chance FROM cells),
  loss AS (SELECT -avg(ln(CASE WHEN label = 1 THEN probability ELSE 1 - probability END)) AS v FROM scored)"""
_NB_EVAL = _EVAL.replace(scored_sql(SMOOTH_PROBABILITY_SQL), f"{_NB_CTE}, scored AS (SELECT label, p AS probability, prediction FROM nb)")
_NB_AUC = """(SELECT round(sum(pos * (below + neg / 2.0e0)) / (sum(pos) * sum(neg)), 5) AS value FROM (
    SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM (SELECT p, count(CASE WHEN label = 1 THEN 1 END) * 1.0e0 AS pos, count(CASE WHEN label = 0 THEN 1 END) * 1.0e0 AS neg FROM nb GROUP BY 1)))"""
_OTHER_FOLDS = f"""{_FOLDS}, rows AS (SELECT t.*, folded.fold FROM train t JOIN folded ON t.customer_id = folded.customer_id),
  other AS (SELECT r.* EXCLUDE (fold), k AS fold FROM rows r, (SELECT unnest(range(5)) AS k) WHERE r.fold <> k)"""
_FOLD_NB = f"""{_OTHER_FOLDS},
  {_bayes_sql('other', 'rows', 'fold')},
  steps AS (SELECT fold, p, count(CASE WHEN label = 1 THEN 1 END) * 1.0e0 AS pos, count(CASE WHEN label = 0 THEN 1 END) * 1.0e0 AS neg FROM nb GROUP BY ALL),
  summed AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM steps),
  areas AS (SELECT fold, sum(pos * (below + neg / 2.0e0)) / (sum(pos) * sum(neg)) AS v FROM summed GROUP BY fold)
  SELECT 'roc_auc' AS metric, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM areas"""
_SHARED_NB = f"""{_OTHER_FOLDS},
  {_bayes_sql('other', 'rows', 'fold', NUMBERS)},
  steps AS (SELECT fold, l1 - l0 AS p, count(CASE WHEN label = 1 THEN 1 END) * 1.0e0 AS pos, count(CASE WHEN label = 0 THEN 1 END) * 1.0e0 AS neg FROM wide GROUP BY ALL),
  summed AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM steps),
  areas AS (SELECT fold, sum(pos * (below + neg / 2.0e0)) / (sum(pos) * sum(neg)) AS v FROM summed GROUP BY fold)
  SELECT 'roc_auc' AS metric, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM areas"""
_SHARED_LOGISTIC = f"""{_OTHER_FOLDS},
  shape AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMBERS)} FROM train),
  means AS (SELECT fold, {", ".join(f"avg(CAST(churn AS DOUBLE) * ({c} - m_{c}) / s_{c}) AS {c}" for c in NUMBERS)}, avg(CAST(churn AS DOUBLE)) AS intercept
    FROM other, shape GROUP BY fold)
  SELECT CAST(fold AS INTEGER) AS fold, unnest([{", ".join(f"'{c}'" for c in [*NUMBERS, "intercept"])}]) AS feature,
    round(unnest([{", ".join([*NUMBERS, "intercept"])}]), 7) AS expected FROM means"""
_METRICS = {
    "tn": "tn", "fp": "fp", "fn": "fn", "tp": "tp", "accuracy": "acc", "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "tp / (tp + fn)", "f1_score": "2 * tp / (2 * tp + fp + fn)", "cohen_kappa": _KAPPA,
    "matthews_corrcoef": "coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0)",
    "log_loss": "(SELECT v FROM loss)",
}

ORACLES = {
    "j01_column_concat": f"""{USAGE_SQL} SELECT customer_id, intl_flag AS intl_plan, vmail_flag AS vmail_plan,
      CAST(area_code = 100 AS INTEGER) AS area_code_100, CAST(area_code = 101 AS INTEGER) AS area_code_101,
      CAST(area_code = 102 AS INTEGER) AS area_code_102 FROM flagged""",
    "j02_nearest_neighbors": _KNN + """ SELECT id, CAST(rank AS INTEGER) AS rank, neighbor_id, round(distance, 6) AS distance
      FROM r WHERE rank <= 5""",
    "j02_nearest_neighbors_cells": _KNN + """ SELECT id, CAST(rank AS INTEGER) AS rank, neighbor_id, round(distance, 6) AS distance
      FROM r WHERE rank <= 5""",
    "m10_knn_vote": _VOTE + " SELECT id, neighbor_label AS prediction, CAST(votes AS INTEGER) AS votes FROM best WHERE place = 1",
    "m10_knn_probability": f"""{_TRAIN_TEST}, s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _NEAR)} FROM train),
      a AS (SELECT customer_id AS id, {', '.join(f'(t.{c} - m_{c}) / s_{c} AS {c}' for c in _NEAR)} FROM test t, s),
      b AS (SELECT customer_id AS nid, CAST(churn AS INTEGER) AS label, {', '.join(f'(t.{c} - m_{c}) / s_{c} AS {c}' for c in _NEAR)} FROM train t, s),
      r AS (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY {' + '.join(f'pow(a.{c} - b.{c}, 2)' for c in _NEAR)}, nid) AS rank FROM a, b)
      SELECT id, round(avg(label), 6) AS probability FROM r WHERE rank <= 5 GROUP BY id""",
    "a22_confusion_matrix": """WITH c AS (SELECT unnest([0, 1]) AS class)
      SELECT CAST(a.class AS INTEGER) AS label, CAST(b.class AS INTEGER) AS prediction,
        (SELECT count(*) FROM labels WHERE quality = a.class AND toxic = b.class) AS n FROM c a CROSS JOIN c b""",
    "a22_confusion_matrix_classes": _VOTE + """, pairs AS (SELECT label, neighbor_label AS prediction, count(*) AS n FROM best WHERE place = 1 GROUP BY ALL),
      classes AS (SELECT label AS class FROM pairs UNION SELECT prediction FROM pairs)
      SELECT a.class AS label, b.class AS prediction, coalesce(n, 0) AS n FROM classes a CROSS JOIN classes b
      LEFT JOIN pairs ON pairs.label = a.class AND pairs.prediction = b.class""",
    "a23_scores": f"""{scored_sql()} SELECT round((tn + tp) / (tn + fp + fn + tp), 9) AS accuracy,
      round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall,
      round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1_score FROM (SELECT {_CELLS} FROM scored)""",
    "a24_classification_report": f"""WITH d AS ({_LABELS}), c AS (SELECT unnest([0, 1]) AS class),
      per AS (SELECT CAST(class AS VARCHAR) AS class, count(CASE WHEN label = class THEN 1 END) AS support,
        count(CASE WHEN label = class AND prediction = class THEN 1 END) * 1.0e0 AS hit,
        count(CASE WHEN prediction = class THEN 1 END) AS said FROM d CROSS JOIN c GROUP BY class),
      s AS (SELECT class, coalesce(hit / nullif(said, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r,
        coalesce(2 * hit / nullif(said + support, 0), 0) AS f, support, hit FROM per)
      SELECT class, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1_score, support FROM s
      UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM s
      UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), CAST(sum(support) AS BIGINT) FROM s
      UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9),
        round(sum(f * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM s""",
    "a25_roc_auc": f"{USAGE_SQL} " + _AUC.format(name="cs_calls", p="cs_calls / (1.0e0 + cs_calls)") + " UNION ALL "
      + _AUC.format(name="account_length", p=SMOOTH_PROBABILITY_SQL),
    "a26_roc_curve": _CURVE + _ORIGIN,
    "a26_roc_curve_corners": _CURVE + " WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg" + _ORIGIN,
    "a27_log_loss": f"""{scored_sql(SMOOTH_PROBABILITY_SQL)}
      SELECT round(-avg(ln(CASE WHEN label = 1 THEN probability ELSE 1 - probability END)), 9) AS log_loss FROM scored""",
    "a28_cohen_kappa": f"""SELECT round({_KAPPA}, 9) AS cohen_kappa FROM (SELECT (tn + tp) / (tn + fp + fn + tp) AS acc,
      ((tn + fp) * (tn + fn) + (fn + tp) * (fp + tp)) / pow(tn + fp + fn + tp, 2) AS chance FROM (SELECT {_CELLS} FROM ({_LABELS})))""",
    "a29_matthews_correlation": f"""{scored_sql()} SELECT round({_METRICS['matthews_corrcoef']}, 9) AS matthews_corrcoef
      FROM (SELECT {_CELLS} FROM scored)""",
    "a30_fold_mean_std": _FOLDS + """ SELECT 'churn_rate' AS metric, round(avg(v), 9) AS mean, round(stddev_pop(v), 9) AS std
      FROM (SELECT avg(label) AS v FROM folded GROUP BY fold)""",
    "m01_synthetic_counts": f"""{_TRAIN_TEST}, c AS (SELECT count(CASE WHEN churn THEN 1 END) AS few, count(CASE WHEN NOT churn THEN 1 END) AS many FROM train)
      SELECT 0 AS label, false AS synthetic, many AS n FROM c UNION ALL SELECT 1, false, few FROM c
      UNION ALL SELECT 1, true, CAST(floor(many * (30.0e0 / 70) - few) AS BIGINT) FROM c""",
    "m01_neighbor_cleaning": f"""{_TRAIN_TEST}, p AS (SELECT customer_id AS id, CAST(churn AS INTEGER) AS label,
        [account_length * 1.0e0, cs_calls * 1.0e0, day_calls * 1.0e0] AS v FROM train),
      d AS (SELECT a.id, a.label, b.id AS neighbor_id, b.label AS neighbor_label, list_distance(a.v, b.v) AS distance FROM p a JOIN p b ON a.id <> b.id),
      r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbor_id) AS rank FROM d)
      SELECT id, label FROM r WHERE rank <= 3 GROUP BY id, label HAVING count(CASE WHEN neighbor_label = label THEN 1 END) = 3""",
    "m04_model_names": f"""{USAGE_SQL} SELECT state AS value, false AS supported, count(*) AS n FROM usage GROUP BY state
      UNION ALL SELECT 'random_forest', true, count(*) FROM usage UNION ALL SELECT 'boosted_trees', true, count(*) FROM usage""",
    "m09_naive_bayes": _NB_SQL,
    **{name: _CONTRACT for name in (
        "m02_random_forest", "m03_boosted_trees", "m05_logistic_regression", "m06_support_vector_machine", "m07_decision_tree",
        "m08_balanced_forest", "m11_gradient_boosting", "m12_adaboost", "m13_neural_network", "m18_refit_best", "m19_top_features",
        "m19_top_features_boosted")},
    "m07_depth_one_tree": _STUMP_CTE + """ SELECT customer_id, round(CASE WHEN x <= cut THEN left_share ELSE right_share END, 9) AS probability
      FROM best JOIN long ON long.f = best.f WHERE split = 'test'""",
    "a31_depth_one_importance": _STUMP_CTE + """ SELECT unnest(['cs_calls', 'intl_flag', 'area_code']) AS feature,
      unnest([CAST(f = 0 AS DOUBLE), CAST(f = 1 AS DOUBLE), CAST(f = 2 AS DOUBLE)]) AS importance FROM best""",
    "m05_moments": _COARSE + """, train_rows AS (SELECT * FROM coarse WHERE split = 'train')
      SELECT unnest(['cs_calls', 'intl_flag', 'area_code', 'intercept']) AS feature, unnest([sum(y * f0), sum(y * f1), sum(y * f2), sum(y)]) AS expected FROM train_rows""",
    "m06_calibration": _CALIBRATED + " SELECT customer_id, round(1 / (1 + exp(-(a * cs_calls + b))), 6) AS probability FROM test CROSS JOIN n12",
    "m11_two_rounds": _BOOST_TWO + " SELECT v.customer_id, round(1 / (1 + exp(-2 * margin)), 6) AS probability FROM v2 v JOIN test t ON t.customer_id = v.customer_id",
    "m12_three_rounds": _VOTES_THREE + " SELECT a.customer_id, round(1 / (1 + exp(-2 * z / say)), 6) AS probability FROM a3 a JOIN test t ON t.customer_id = a.customer_id",
    "m13_slopes": _SLOPES_SQL, "m14_shared_bayes": _SHARED_NB, "m14_shared_logistic": _SHARED_LOGISTIC,
    "m14_cross_validation": _FOLD_NB,
    "m15_model_comparison": "SELECT unnest([" + ", ".join(f"'{m}'" for m in models.MODEL_NAMES) + "]) AS model, metric, true AS in_range FROM (SELECT unnest(["
      + ", ".join(f"'{m}'" for m in [*_METRICS, "roc_auc"]) + "]) AS metric)",
    **{name: f"SELECT CAST(unnest(range({TRIALS})) AS INTEGER) AS trial, CAST({n} AS INTEGER) AS n_settings, true AS in_range"
       for name, n in (("m16_forest_search", len(models.FOREST_SPACE)), ("m17_boosted_search", len(models.BOOSTED_SPACE)))},
    "m21_batch_scoring": _NB_CTE + """ SELECT count(*) AS total_customers, count(CASE WHEN prediction = 1 THEN 1 END) AS churn_count,
      round(count(CASE WHEN prediction = 1 THEN 1 END) * 100.0e0 / count(*), 6) AS churn_percentage FROM nb""",
    "m21_batch_report": _NB_CTE + """ SELECT row_number() OVER (ORDER BY customer_id) AS "Customer", CASE prediction WHEN 1 THEN 'Yes' ELSE 'No' END AS "Churn",
      printf('%.2f%%', p * 100) AS "Probability", printf('%.2f%%', abs(p - 0.5e0) * 200) AS "Confidence",
      CASE WHEN p < 0.3e0 THEN 'Low' WHEN p < 0.6e0 THEN 'Medium' ELSE 'High' END AS "Risk Level" FROM nb""",
    "m21_rejected_records": f"""{_TRAIN_TEST} SELECT customer_id, CASE
        WHEN customer_id % 11 = 4 AND customer_id % 7 = 3 THEN 'State,Total day calls' WHEN customer_id % 11 = 4 THEN 'State'
        WHEN customer_id % 7 = 3 THEN 'Total day calls' WHEN customer_id % 13 = 5 THEN 'International plan' ELSE '' END AS faults FROM test""",
    "x01_streaming_run_spans": f"""{EVENT_SQL} SELECT run_id, epoch_us(min(ts)) AS started_us, epoch_us(max(ts)) AS ended_us,
      count(*) AS events, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS duration FROM (SELECT DISTINCT * FROM log) GROUP BY run_id""",
    "m22_timing": "SELECT unnest(['train', 'predict']) AS step, true AS measured",
    "m23_full_evaluation": f"{_NB_EVAL} " + " UNION ALL ".join(
        f"SELECT '{name}' AS metric, round({sql}, 5) AS value FROM derived" for name, sql in _METRICS.items()
    ) + f" UNION ALL SELECT 'roc_auc', value FROM {_NB_AUC}",
    "m23_training_run": f"""{_TRAIN_TEST} SELECT unnest(['run_start', 'data_preparation', 'model_training', 'model_evaluation', 'metrics', 'run_end', 'report', 'scores 1.0']) AS part,
      CAST(unnest([1, 1, 1, 1, 12, 1, 5, 12]) AS BIGINT) AS n
      UNION ALL SELECT 'test_samples', count(*) FROM test UNION ALL SELECT 'matrix', count(*) FROM test""",
    "m02_depth_two_tree": _DEPTH_TWO,
    "m03_two_rounds": _TWO_ROUNDS + " SELECT m2.customer_id, round(1e0 / (1e0 + exp(-margin)), 6) AS probability FROM m2 JOIN test ON test.customer_id = m2.customer_id",
    "a32_two_round_gains": _TWO_ROUNDS + """ SELECT CASE f WHEN 0 THEN 'cs_calls' WHEN 1 THEN 'intl_flag' ELSE 'area_code' END AS feature,
      count(*) AS weight, round(avg(gain), 3) AS gain FROM (SELECT f, gain FROM b1 UNION ALL SELECT f, gain FROM b2) GROUP BY f""",
    "a31_importances": "SELECT true AS none_negative, true AS within_features, true AS each_once, true AS sums_to_one",
    "a32_split_importances": "SELECT true AS none_negative, true AS within_features, true AS each_once",
    "m14_stratified_folds": _FOLDS + " SELECT customer_id, label, fold FROM folded",
    "m20_prediction_contract": f"{_TRAIN_TEST} SELECT customer_id, true AS in_range, true AS consistent FROM test",
    "m23_score_evaluation": f"{_EVAL} " + " UNION ALL ".join(
        f"SELECT '{name}' AS metric, round({sql}, 9) AS value FROM derived" for name, sql in _METRICS.items()
    ) + " UNION ALL SELECT 'roc_auc', roc_auc FROM (" + _AUC.format(name="", p=SMOOTH_PROBABILITY_SQL) + ")",
    "s12_save_and_load": f"{_TRAIN_TEST} SELECT count(*) AS customers, count(*) AS alike FROM test",
    "r07_snapshot": f"{_TRAIN_TEST} SELECT count(*) AS customers, count(*) AS alike, '1.1' AS version FROM test",
    "x01_streaming_ingest": f"{EVENT_SQL} SELECT {SHOWN_SQL} FROM log",
    "x02_streaming_scoring": f"{_TRAIN_TEST} SELECT count(*) AS customers, count(*) AS alike FROM test",
}
