"""Models of all folds from shared scans, against one fit a fold."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keeprate.operators.folded import bayes_margins, fit_logistic
from keeprate.operators.metrics import roc_auc, roc_auc_by

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3)) * [1, 5, 0.2] + [0, 100, 3]
    y = (rng.random(600) < 1 / (1 + np.exp(-(x[:, 0] - 0.3 * (x[:, 1] - 100) + 4 * (x[:, 2] - 3))))).astype(int)
    rows = [(i, int(t), i % 5, *map(float, r)) for i, (t, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "id long, label int, fold int, a double, b double, c double").repartition(4)
    return df.withColumn("values", F.array(*FEATURES)).cache()


def test_bayes_equals_one_fit_a_fold(folded):
    shared = {r.id: r.margin for r in bayes_margins(folded, FEATURES).collect()}
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(folded)
    for fold in range(5):
        model = NaiveBayes(modelType="gaussian").fit(vectors.filter(F.col("fold") != fold))
        for r in model.transform(vectors.filter(F.col("fold") == fold)).select("id", vector_to_array("rawPrediction").alias("raw")).collect():
            assert shared[r.id] == pytest.approx(r.raw[1] - r.raw[0], abs=1e-8)


def test_bayes_where_rows_or_classes_are_missing(spark):
    nan = float("nan")
    rows = [(0, 0, 1.0), (0, 0, 2.0), (1, 1, 5.0), (1, 0, 1.5), (2, None, 9.0), (1, 1, None), (1, 1, nan), (None, 1, 3.0)]
    df = spark.createDataFrame(rows, "fold int, label int, x double")
    found = {(r.fold, r.x if r.x == r.x else "nan"): r.margin for r in bayes_margins(df, ["x"]).collect()}
    assert found[1, 5.0] == found[1, 1.5] == -math.inf  # without fold 1 there is no positive row
    assert found[1, None] is None and found[1, "nan"] is None and found[None, 3.0] is None
    assert math.isfinite(found[0, 1.0]) and math.isfinite(found[2, 9.0])
    constant = spark.createDataFrame([(f, y, 1.0) for f in (0, 1) for y in (0, 1)], "fold int, label int, x double")
    assert [r.margin for r in bayes_margins(constant, ["x"]).collect()] == [0.0] * 4
    assert bayes_margins(df.limit(0), ["x"]).count() == 0


def test_logistic_equals_one_fit_a_fold_with_a_fifth_of_the_scans(folded):
    penalties = [1e-3, 0.1]
    shared = fit_logistic(folded, penalties)
    scans = 0
    for i, penalty in enumerate(penalties):
        for fold in range(5):
            alone = fit_logistic(folded.filter(F.col("fold") != fold), [penalty], by_fold=False)
            scans += alone.scans
            assert np.abs(alone.weights[0, 0] - shared.weights[i, fold]).max() < 1e-9
    assert shared.scans * 5 <= scans


def test_logistic_equals_the_built_in_solver(folded):
    model = fit_logistic(folded, [0.05])
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(folded)
    known = LogisticRegression(regParam=0.05, standardization=False, maxIter=500, tol=1e-14).fit(vectors)
    assert np.allclose(model.weights[0, -1], [*known.coefficients, known.intercept], atol=1e-5)
    scored = model.margins(folded.select("id", "label", "fold", "values")).collect()
    for r in scored[:20]:
        assert r.margins[0] == pytest.approx(float(np.array([*r["values"], 1]) @ model.weights[0, r.fold]), abs=1e-9)


def test_logistic_on_odd_rows(folded, spark):
    again = folded.select("label", "fold", "values").union(
        spark.createDataFrame([(None, 1, [1.0, 2.0, 3.0]), (1, None, [1.0, 2.0, 3.0]), (1, 2, None)], "label int, fold int, values array<double>"))
    assert np.allclose(fit_logistic(again.repartition(9), [0.1]).weights, fit_logistic(folded, [0.1]).weights, atol=1e-9)
    with pytest.raises(ValueError, match="no rows"):
        fit_logistic(folded.limit(0), [0.1])
    one = fit_logistic(folded.withColumn("fold", F.lit(3)), [0.1])  # without its fold nothing is left
    assert one.folds == [3] and not one.weights[0, 0].any() and one.weights[0, 1].any()


def test_area_by_group_equals_the_area_of_each(folded):
    scored = folded.withColumn("probability", F.round("a", 1))
    found = {r.fold: r.value for r in roc_auc_by(scored, "fold").collect()}
    for fold in range(5):
        assert found[fold] == pytest.approx(roc_auc(scored.filter(F.col("fold") == fold)).first()[0], abs=1e-12)
