from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from keeprate.operators import metrics


def cells(spark, tn, fp, fn, tp):
    return spark.createDataFrame([(tn, fp, fn, tp)], "tn long, fp long, fn long, tp long")


def rows_of(spark, tn, fp, fn, tp):
    pairs = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame(pairs, "label int, prediction int")


def test_scores_of_the_first_published_matrix(spark):
    found = metrics.binary_scores(rows_of(spark, 569, 3, 21, 74)).first()
    assert (found.tn, found.fp, found.fn, found.tp) == (569, 3, 21, 74)
    assert found.accuracy == pytest.approx(0.9640179910044977, abs=1e-15)
    assert found.precision == pytest.approx(0.961038961038961, abs=1e-15)
    assert found.recall == pytest.approx(0.7789473684210526, abs=1e-15)
    assert found.f1_score == pytest.approx(0.8604651162790697, abs=1e-15)


def test_scores_of_the_second_published_matrix(spark):
    found = metrics.scores_from_counts(cells(spark, 563, 9, 39, 56)).first()
    assert found.accuracy == pytest.approx(0.9280359820089955, abs=1e-15)
    assert found.cohen_kappa == pytest.approx(0.6607396418353291, abs=1e-12)
    assert found.matthews_corrcoef == pytest.approx(0.6761134601038989, abs=1e-12)


def test_division_by_zero_gives_zero(spark):
    found = metrics.scores_from_counts(cells(spark, 10, 0, 5, 0)).first()
    assert (found.precision, found.recall, found.f1_score, found.matthews_corrcoef) == (0, 0, 0, 0)


def test_confusion_matrix_fills_missing_cells(spark):
    df = spark.createDataFrame([(0, 2), (0, 2), (1, 1)], "label int, prediction int")
    found = {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(df).collect()}
    assert len(found) == 9 and found[0, 2] == 2 and found[1, 1] == 1 and sum(found.values()) == 3


def test_report(spark):
    rows = {r["class"]: r for r in metrics.classification_report(rows_of(spark, 5, 1, 2, 2)).collect()}
    assert rows["1"].precision == pytest.approx(2 / 3) and rows["1"].recall == pytest.approx(0.5)
    assert rows["accuracy"].f1_score == pytest.approx(0.7)
    assert rows["macro avg"].recall == pytest.approx((5 / 6 + 0.5) / 2)
    assert rows["weighted avg"].precision == pytest.approx((6 * 5 / 7 + 4 * 2 / 3) / 10)
    assert rows["weighted avg"].support == 10


def scored(spark, labels, scores):
    return spark.createDataFrame(
        [(int(a), float(b)) for a, b in zip(labels, scores)], "label int, probability double"
    ).repartition(5)


@pytest.mark.parametrize("digits", [1, 6])
def test_auc_counts_pairs(spark, digits):
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 2, 1500)
    scores = (rng.random(1500) + 0.2 * labels).round(digits)
    pos, neg = scores[labels == 1], scores[labels == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    df = scored(spark, labels, scores)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(want, abs=1e-12)
    # A monotone map of the score leaves it alone.
    assert metrics.roc_auc(df.withColumn("probability", F.exp("probability"))).first()[0] == pytest.approx(want, abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    assert metrics.roc_auc(scored(spark, [1, 1], [0.2, 0.3])).first()[0] is None


def test_roc_curve_and_its_corners(spark):
    rng = np.random.default_rng(6)
    labels, scores = rng.integers(0, 2, 1200), rng.random(1200).round(3)
    df = scored(spark, labels, scores)
    points = sorted(metrics.roc_curve(df).collect(), key=lambda r: -r.threshold)
    thresholds = sorted(set(scores), reverse=True)
    want = [(np.inf, 0.0, 0.0)] + [
        (t, ((scores >= t) & (labels == 0)).sum() / (labels == 0).sum(), ((scores >= t) & (labels == 1)).sum() / labels.sum())
        for t in thresholds
    ]
    assert np.allclose([tuple(p)[1:] for p in points], [w[1:] for w in want])
    corners = sorted(metrics.roc_curve(df, drop_collinear=True).collect(), key=lambda r: -r.threshold)
    fps = np.array([((scores >= t) & (labels == 0)).sum() for t in thresholds])
    tps = np.array([((scores >= t) & (labels == 1)).sum() for t in thresholds])
    keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    assert [c.threshold for c in corners[1:]] == pytest.approx(np.array(thresholds)[keep])


def test_log_loss_is_clipped(spark):
    found = metrics.log_loss(scored(spark, [1, 0], [0.0, 0.25])).first()[0]
    assert found == pytest.approx((-np.log(metrics.LOG_LOSS_EPSILON) - np.log(0.75)) / 2)


def test_class_weights(spark):
    df = rows_of(spark, 6, 0, 0, 2)
    found = {r.label: r.weight for r in metrics.class_weights(df).collect()}
    assert found == {0: pytest.approx(8 / 12), 1: pytest.approx(2.0)}
    weighted = metrics.with_class_weight(df).groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert {r.label: r.w for r in weighted} == {0: pytest.approx(4.0), 1: pytest.approx(4.0)}
