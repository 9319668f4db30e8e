from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from keeprate.operators import importance
from keeprate.operators.adaboost import AdaBoost
from keeprate.operators.fourier import FourierFeatures
from keeprate.plans import models, recipes
from keeprate.plans.scoring import as_predictions, report_table, score, split_scorable, summary
from keeprate.plans.usage import customer_usage, held_out_rows, train_rows
from keeprate.session import settled

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def usage(spark):
    return settled(customer_usage(spark, FOLDER), "usage")


@pytest.fixture(scope="module")
def separable(spark):
    """Label follows the first feature beyond a threshold, with the second as noise."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 2))
    rows = [(i, float(a + 0.3 * rng.normal() > 0.4), [float(a), float(b)]) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "customer_id long, label double, v array<double>")
    return df.select("customer_id", "label", array_to_vector("v").alias("features"))


def test_unknown_model_type_is_an_error():
    with pytest.raises(ValueError, match="unsupported model type"):
        models.production_model("perceptron")


def test_production_settings():
    forest, boosted = models.production_model("random_forest"), models.production_model("boosted_trees")
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode()) == (100, 10, 2)
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (100, 6, 0.1)


@pytest.mark.parametrize("name", models.MODEL_NAMES)
def test_every_model_learns(separable, name):
    found = models.fit_and_score(name, separable, separable, rounds=5).collect()
    assert len(found) == 600
    assert all(0 <= r.probability <= 1 for r in found)
    assert np.mean([r.label == r.prediction for r in found]) > 0.8


def test_fit_is_repeatable(separable):
    def once():
        out = models.fit_and_score("random_forest", separable, separable, rounds=5)
        return {r.customer_id: r.probability for r in out.collect()}

    assert once() == once()


def test_adaboost_combines_stumps(separable):
    model = AdaBoost(maxIter=8).fit(separable)
    assert 1 <= len(model.votes()) <= 8
    assert model.votes()[0][0].feature == 0


def test_a_round_of_adaboost_is_one_job(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(500, 3))
    y = x[:, 0] + 2 * rng.normal(size=500) > 0
    rows = spark.createDataFrame([(Vectors.dense(v), float(c)) for v, c in zip(x, y)], ["features", "label"])
    jobs = []
    for rounds in (2, 6):
        spark.sparkContext.setJobGroup(f"boost-{rounds}", "")
        assert len(AdaBoost(maxIter=rounds).fit(rows).votes()) == rounds
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boost-{rounds}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] - jobs[0] <= 2 * 4  # the shuffle of an adaptive query counts as a job of its own


def test_adaboost_saves_and_loads(separable, tmp_path):
    from keeprate.operators.adaboost import AdaBoostModel

    model = AdaBoost(maxIter=7).fit(separable)
    model.write().overwrite().save(str(tmp_path / "boosted"))
    again = AdaBoostModel.load(str(tmp_path / "boosted"))
    first = {r.customer_id: r.probability for r in model.transform(separable).collect()}
    assert first == {r.customer_id: r.probability for r in again.transform(separable).collect()}


def test_fit_does_not_depend_on_partitions(spark, usage):
    def once(n):
        rows = train_rows(usage).repartition(n)
        model = recipes.fit(rows, models.production_model("random_forest", numTrees=5, maxDepth=4), "basic")
        return {r.customer_id: r.churn_probability for r in score(model, held_out_rows(usage)).collect()}

    assert once(1) == once(4) == once(8)


def test_nothing_stays_cached(spark, usage):
    models.compare(*(recipes.prepare(train_rows(usage), "basic").train,) * 2, names=["naive_bayes"]).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_fourier_stage_saves_and_loads(spark, separable, tmp_path):
    stage = FourierFeatures(inputCol="features", outputCol="curved", size=16, seed=3)
    stage.save(str(tmp_path / "stage"))
    again = FourierFeatures.load(str(tmp_path / "stage"))
    first = stage.transform(separable).orderBy("customer_id").first().curved
    assert first == again.transform(separable).orderBy("customer_id").first().curved and first.size == 16


def test_saved_recipe_scores_alike(spark, usage, tmp_path):
    model = recipes.fit(train_rows(usage), models.production_model("random_forest", numTrees=5), "full")
    recipes.save(model, str(tmp_path / "model"))
    again = recipes.load(str(tmp_path / "model"))
    first, second = score(model, held_out_rows(usage)), score(again, held_out_rows(usage))
    assert sorted(first.collect()) == sorted(second.collect())


def test_new_state_is_scored_by_the_full_recipe_only(spark, usage):
    train, test = train_rows(usage), held_out_rows(usage).withColumn("state", F.lit("ATLANTIS"))
    full = recipes.fit(train, models.production_model("random_forest", numTrees=3), "full")
    assert score(full, test).count() == test.count()
    basic = recipes.fit(train, models.production_model("random_forest", numTrees=3), "basic")
    assert score(basic, test).count() == 0
    assert {tuple(r.faults) for r in split_scorable(basic, test)[1].collect()} == {("State",)}


def test_one_bad_record_does_not_stop_the_others(spark, usage):
    model = recipes.fit(train_rows(usage), models.production_model("random_forest", numTrees=3), "full")
    test = held_out_rows(usage)
    one = test.agg(F.min("customer_id")).first()[0]
    broken = test.withColumn("intl_plan", F.when(F.col("customer_id") == one, "yes").otherwise(F.col("intl_plan")))
    assert score(model, broken).count() == test.count() - 1
    assert [(r.customer_id, r.faults) for r in split_scorable(model, broken)[1].collect()] == [(one, ["International plan"])]


def test_test_rows_do_not_change_the_fit(spark, usage):
    prepared = recipes.prepare(train_rows(usage), "basic")
    again = recipes.prepare(train_rows(usage.filter("split = 'train' OR customer_id < 50")), "basic")
    assert sorted(map(str, prepared.train.collect())) == sorted(map(str, again.train.collect()))


def test_balanced_recipe_and_subset(spark, usage):
    with pytest.raises(ValueError, match="no such features"):
        recipes.prepare(train_rows(usage), "full", subset=["total_charge", "no_such"])
    prepared = recipes.prepare(train_rows(usage), "full", balance={"k": 3}, subset=recipes.FOREST_SUBSET)
    assert prepared.names == recipes.FOREST_SUBSET
    assert prepared.train.first().features.size == len(recipes.FOREST_SUBSET)
    assert prepared.transform(held_out_rows(usage)).count() == held_out_rows(usage).count()


def test_summary_of_an_empty_batch(spark):
    empty = spark.createDataFrame([], "prediction double, probability double")
    assert tuple(summary(as_predictions(empty)).first()) == (0, 0, 0.0)


def test_summary_and_report(spark):
    df = spark.createDataFrame([(7, 1.0, 0.75), (3, 0.0, 0.25), (5, 0.0, 0.5)], "customer_id long, prediction double, probability double")
    predictions = as_predictions(df, ["customer_id"])
    assert tuple(summary(predictions).first()) == (3, 1, pytest.approx(100 / 3))
    rows = [tuple(r) for r in report_table(predictions).orderBy("Customer").collect()]
    assert rows == [
        (1, "No", "25.00%", "50.00%", "Low"), (2, "No", "50.00%", "0.00%", "Medium"), (3, "Yes", "75.00%", "50.00%", "High"),
    ]


def test_cross_validation_gives_each_fold(separable):
    folded = models.stratified_folds(separable)
    found = models.cross_validate(folded, models.production_model("random_forest", numTrees=3, maxDepth=3)).collect()
    assert sorted(r.fold for r in found) == [0, 1, 2, 3, 4] and all(r.value > 0.8 for r in found)


def test_search_ranges_and_result(spark, separable):
    for name, space in models.SPACES.items():
        drawn = models.draw_settings(space, 50)
        assert len(drawn) == 50 and drawn == models.draw_settings(space, 50)
        assert all(set(d) == set(space) for d in drawn)
    assert {d["numTrees"] for d in models.draw_settings(models.FOREST_SPACE, 200)} == set(range(100, 501, 50))
    settings = [{"numTrees": 1, "maxDepth": 1}, {"numTrees": 8, "maxDepth": 4}]
    search, trials = models.search_parameters(separable, "random_forest", settings=settings)
    rows = trials.collect()
    best = max(rows, key=lambda r: r.accuracy)
    assert search.bestModel.getNumTrees == int(best.settings["numTrees"])


def test_importances(spark, separable):
    forest = models.production_model("random_forest", numTrees=5).fit(separable)
    rows = importance.ranked(importance.importances(spark, forest, ["signal", "noise"])).collect()
    assert rows[0].feature == "signal" and sum(r.importance for r in rows) == pytest.approx(1)
    boosted = models.production_model("boosted_trees", maxIter=2, maxDepth=2).fit(separable)
    splits = {r.feature: r for r in importance.split_importances(spark, boosted, ["signal", "noise"]).collect()}
    assert splits["signal"].weight >= 1 and splits["signal"].gain > 0


def test_timing_measures_both_steps(separable):
    rows = models.timed_fit_and_predict(models.production_model("random_forest", numTrees=2), separable, separable).collect()
    assert [r.step for r in rows] == ["train", "predict"] and all(r.seconds > 0 for r in rows)
