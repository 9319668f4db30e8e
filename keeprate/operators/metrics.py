"""Classification metrics as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from keeprate.operators.ordered import running_totals, with_next
from keeprate.session import settled

# Fixed value: smallest probability used in the log loss (double epsilon).
LOG_LOSS_EPSILON = 2.220446049250313e-16


def _share(top: Column, bottom: Column) -> Column:
    """Ratio with 0 where the divisor is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) for all pairs of classes seen on either side."""
    counts = df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))
    # Every class meets every class, which is the size of the result; null classes are left out.
    pairs = counts.filter(F.col("label").isNotNull() & F.col("prediction").isNotNull())
    classes = counts.select(F.explode(F.array("label", "prediction")).alias("class")).filter("class IS NOT NULL").distinct()
    listed = classes.agg(F.sort_array(F.collect_set("class")).alias("prediction"))
    grid = classes.select(F.col("class").alias("label")).join(listed).select("label", F.explode("prediction").alias("prediction"))
    return grid.join(pairs, ["label", "prediction"], "left").select("label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def binary_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: tn, fp, fn, tp."""
    actual, said = F.col(label).cast("int") == 1, F.col(prediction).cast("int") == 1
    return df.agg(
        F.count(F.when(~actual & ~said, 1)).alias("tn"),
        F.count(F.when(~actual & said, 1)).alias("fp"),
        F.count(F.when(actual & ~said, 1)).alias("fn"),
        F.count(F.when(actual & said, 1)).alias("tp"),
    )


def _cells() -> tuple[Column, ...]:
    return tuple(F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))


def scores_from_counts(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall and f1 of the positive class, kappa and Matthews correlation."""
    tn, fp, fn, tp = _cells()
    total = tn + fp + fn + tp
    agreement = _share(tn + tp, total)
    chance = _share((tn + fp) * (tn + fn) + (fn + tp) * (fp + tp), total * total)
    root = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return counts.select(
        "tn", "fp", "fn", "tp",
        agreement.alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        # Undefined (null) when both sides hold one and the same class.
        F.try_divide(agreement - chance, 1 - chance).alias("cohen_kappa"),
        _share(tp * tn - fp * fn, root).alias("matthews_corrcoef"),
    )


def binary_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scores_from_counts(binary_counts(df, label, prediction))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per class, then ``accuracy``, ``macro avg`` and ``weighted avg``."""
    matrix = confusion_matrix(df, label, prediction)
    per_class = (
        matrix.select(
            F.explode(F.array(
                F.struct(
                    F.col("label").alias("class"), F.lit(0).cast("long").alias("said"), F.col("n").alias("support"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0)).alias("hit"),
                ),
                F.struct(
                    F.col("prediction").alias("class"), F.col("n").alias("said"),
                    F.lit(0).cast("long").alias("support"), F.lit(0).cast("long").alias("hit"),
                ),
            )).alias("r")
        )
        .select("r.*").groupBy("class")
        .agg(F.sum("said").alias("said"), F.sum("support").alias("support"), F.sum("hit").alias("hit"))
        .select(
            F.col("class").cast("string").alias("class"),
            _share(F.col("hit"), F.col("said")).alias("precision"),
            _share(F.col("hit"), F.col("support")).alias("recall"),
            _share(2 * F.col("hit"), F.col("said") + F.col("support")).alias("f1_score"),
            "support", "hit",
        )
    )
    names = ("precision", "recall", "f1_score")
    summary = per_class.agg(
        F.sum("support").alias("support"),
        _share(F.sum("hit"), F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[_share(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}") for c in names],
    )
    lines = [
        F.struct(F.lit("accuracy").alias("class"), *[F.col("accuracy").alias(c) for c in names], "support"),
        F.struct(F.lit("macro avg").alias("class"), *[F.col(f"macro_{c}").alias(c) for c in names], "support"),
        F.struct(F.lit("weighted avg").alias("class"), *[F.col(f"weighted_{c}").alias(c) for c in names], "support"),
    ]
    return per_class.drop("hit").unionByName(
        summary.select(F.explode(F.array(*lines)).alias("r")).select("r.*")
    )


def _by_score(df: DataFrame, label: str, score: str, *by: str) -> DataFrame:
    """Positive and negative rows per distinct score (and group); rows without a score are left out."""
    positive = F.col(label).cast("int") == 1
    return df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(
        *by, F.col(score).cast("double").alias("threshold")
    ).agg(F.count(F.when(positive, 1)).alias("pos"), F.count(F.when(~positive, 1)).alias("neg"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """One row: area under the ROC curve, ties counted half; null with a single class."""
    ranked = running_totals(_by_score(df, label, score), "threshold", {"below_neg": "neg"})
    # A positive wins against every negative below it and half of those level with it.
    wins = F.col("pos") * ((F.col("below_neg") - F.col("neg")).cast("double") + F.col("neg") / 2)
    return ranked.agg(
        F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc")
    )


def roc_auc_by(df: DataFrame, by: str, label: str = "label", score: str = "probability") -> DataFrame:
    """(group, value): the area under ROC of each group, all ranked together; null with a single class."""
    ranked = running_totals(_by_score(df.filter(F.col(by).isNotNull()), label, score, by), "threshold", {"below_neg": "neg"}, by=by)
    wins = F.col("pos") * ((F.col("below_neg") - F.col("neg")).cast("double") + F.col("neg") / 2)
    return ranked.groupBy(by).agg(F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg")).alias("value"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "probability", drop_collinear: bool = False) -> DataFrame:
    """(threshold, fpr, tpr) from the highest score down, after the point (infinity, 0, 0).

    ``drop_collinear`` leaves out the points on a straight line between their neighbours.
    """
    points = running_totals(_by_score(df, label, score), "threshold", {"tp": "pos", "fp": "neg"}, descending=True)
    totals = points.agg(F.max("tp").alias("p"), F.max("fp").alias("n")).first()
    if drop_collinear:
        points = _corners(points)
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(points.select(
        "threshold",
        F.try_divide(F.col("fp").cast("double"), F.lit(float(totals["n"] or 0))).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.lit(float(totals["p"] or 0))).alias("tpr"),
    ))


def _corners(points: DataFrame) -> DataFrame:
    """Points whose step differs from the next one, and both ends."""
    followed = with_next(points, "threshold", F.struct("pos", "neg"), "_next")
    top = points.agg(F.max("threshold")).first()[0]
    return followed.filter(
        F.col("_next").isNull() | (F.col("_next.pos") != F.col("pos")) | (F.col("_next.neg") != F.col("neg"))
        | (F.col("threshold") == F.lit(top))
    ).select(*points.columns)


def log_loss(
    df: DataFrame, label: str = "label", probability: str = "probability", epsilon: float = LOG_LOSS_EPSILON
) -> DataFrame:
    """One row: mean negative log probability of the true class, clipped at ``epsilon``."""
    return df.agg(_log_loss(label, probability, epsilon).alias("log_loss"))


def _log_loss(label: str, probability: str, epsilon: float = LOG_LOSS_EPSILON) -> Column:
    p = F.col(probability)
    of_true = F.when(F.col(label).cast("int") == 1, p).otherwise(1 - p)
    return -F.avg(F.log(F.greatest(F.lit(epsilon), F.least(F.lit(1 - epsilon), of_true))))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, weight) with weight = rows / (classes x class rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per class.
    everything = Window.partitionBy(F.lit(0))
    return counts.select(
        label, "n",
        (F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))).alias("weight"),
    )


def with_class_weight(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Adds the balanced class weight."""
    weights = class_weights(df, label).select(F.col(label).alias("_of"), F.col("weight").alias(name))
    return df.join(weights, F.col(label).eqNullSafe(F.col("_of"))).drop("_of")


def evaluate(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", probability: str = "probability"
) -> DataFrame:
    """All scalar metrics of a scored table as (metric, value) rows."""
    scored = settled(scored.select(label, prediction, probability), "scored")
    row = binary_scores(scored, label, prediction).first().asDict()
    row["log_loss"] = log_loss(scored, label, probability).first()[0]
    row["roc_auc"] = roc_auc(scored, label, probability).first()[0]
    return scored.sparkSession.createDataFrame(
        [(name, None if value is None else float(value)) for name, value in row.items()],
        "metric string, value double",
    )


def mean_and_std(folds: DataFrame, value: str = "value", by: str = "metric") -> DataFrame:
    """Mean and population deviation of fold metrics."""
    return folds.groupBy(by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
