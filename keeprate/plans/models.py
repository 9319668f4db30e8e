"""Estimators by name, comparison, cross-validation and parameter search."""

from __future__ import annotations

import random
import time
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from keeprate.operators.adaboost import AdaBoost
from keeprate.operators.kernel import KernelMachine
from keeprate.operators.metrics import evaluate, roc_auc, with_class_weight
from keeprate.operators.neighbors import knn_probability
from keeprate.operators.network import NeuralNetwork
from keeprate.operators.ordered import row_numbers, running_totals
from keeprate.operators.trees import Forest, SecondOrderBoosting
from keeprate.plans.search import Search, drawn, search

# Settings of the two production models.
FOREST = dict(numTrees=100, maxDepth=10, minRowsToSplit=5, minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=42)
BOOSTED = dict(maxIter=100, maxDepth=6, stepSize=0.1, subsamplingRate=0.8, featureShare=0.8, seed=42)
DEEPEST = 1_000  # of trees without a depth setting: they end where a node has one class or one row

PRODUCTION = {"random_forest": (Forest, FOREST), "boosted_trees": (SecondOrderBoosting, BOOSTED)}


def production_model(name: str, **changes) -> Estimator:
    """One of the two production estimators; any other name is an error."""
    if name not in PRODUCTION:
        raise ValueError(f"unsupported model type: {name}")
    kind, settings = PRODUCTION[name]
    return kind(featuresCol="features", labelCol="label", **(settings | changes))


BALANCED = {"logistic_regression", "support_vector_machine", "decision_tree", "random_forest"}
MODEL_NAMES = [
    "logistic_regression", "support_vector_machine", "decision_tree", "random_forest", "naive_bayes",
    "k_nearest_neighbors", "gradient_boosting", "adaboost", "boosted_trees", "neural_network",
]


def research_model(
    name: str, features: int, rounds: int | None = None, seed: int = 42, depth: int = DEEPEST, steps: int = 100
) -> Estimator:
    """The estimators of the model comparison.

    ``rounds`` are trees, boosting rounds or training passes; by default 50 stumps for AdaBoost, 200 passes for the network, else
    100. ``depth`` bounds the trees that grow freely, ``steps`` the linear solver.
    """
    weight = {"weightCol": "weight"} if name in BALANCED else {}
    common = dict(featuresCol="features", labelCol="label")
    if name == "logistic_regression":
        return LogisticRegression(regParam=1e-3, maxIter=steps, **common, **weight)
    if name == "support_vector_machine":
        return KernelMachine(seed=seed, **common, **weight)
    if name == "decision_tree":
        return Forest(numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=depth, seed=seed, **common, **weight)
    if name == "random_forest":
        return Forest(numTrees=rounds or 100, maxDepth=depth, seed=seed, **common, **weight)
    if name == "naive_bayes":
        return NaiveBayes(modelType="gaussian", **common)
    if name == "gradient_boosting":
        return GBTClassifier(maxIter=rounds or 100, maxDepth=3, stepSize=0.1, seed=seed, **common)
    if name == "boosted_trees":
        return SecondOrderBoosting(maxIter=rounds or 100, maxDepth=6, stepSize=0.3, seed=seed, **common)
    if name == "adaboost":
        return AdaBoost(maxIter=rounds or 50, seed=seed)
    if name == "neural_network":
        return NeuralNetwork(maxIter=rounds or 200, seed=seed, **common)
    raise ValueError(f"unsupported model type: {name}")


def vector_size(df: DataFrame, column: str = "features") -> int:
    """Length of a vector column, from its metadata where a stage left it there, else from one row."""
    noted = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    return noted or df.select(column).first()[0].size


def positive_probability(scored: DataFrame) -> DataFrame:
    """``probability`` as the number for class 1; margins pass through the logistic curve."""
    if "probability" in scored.columns:
        if scored.schema["probability"].dataType.typeName() == "double":
            return scored
        value = F.get(vector_to_array("probability"), F.lit(1))
    else:
        value = 1 / (1 + F.exp(-F.get(vector_to_array("rawPrediction"), F.lit(1))))
    return scored.withColumn("probability", value)


def fit_and_score(name: str, train: DataFrame, test: DataFrame, rounds: int | None = None, seed: int = 42) -> DataFrame:
    """Fits one named model on (label, features) rows and scores the test rows."""
    size = vector_size(train)
    if name == "k_nearest_neighbors":
        def points(df):
            return df.select(
                F.col("customer_id").alias("id"), "label", vector_to_array("features").alias("vector")
            )

        scored = knn_probability(points(train), points(test)).withColumnRenamed("id", "customer_id")
        return scored.select(
            "customer_id", "label", "probability", (F.col("probability") > 0.5).cast("double").alias("prediction")
        )
    if name in BALANCED:
        train = with_class_weight(train)
    model = research_model(name, size, rounds, seed).fit(train)
    return positive_probability(model.transform(test)).select("customer_id", "label", "probability", "prediction")


def compare(train: DataFrame, test: DataFrame, names: list[str] = MODEL_NAMES, rounds: int | None = None) -> DataFrame:
    """(model, metric, value) of every named model on the test rows."""
    out = None
    for name in names:
        rows = evaluate(fit_and_score(name, train, test, rounds)).select(F.lit(name).alias("model"), "metric", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- folds ---------------------------------------------------------------------------


def stratified_folds(
    df: DataFrame, folds: int = 5, id_column: str = "customer_id", label: str = "label"
) -> DataFrame:
    """Adds ``fold``: unshuffled stratified blocks in id order.

    The rank inside a class comes from bucketed running totals, so a class holding
    most rows is ranked by many tasks.
    """
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min(id_column).alias("first"))
    # The fold that deals a class its next row is that of the number of rows of the classes before.
    started = running_totals(classes, "first", {"upto": "n"})
    started = started.select(F.col(label).alias("_of"), "n", (F.col("upto") - F.col("n")).alias("start"))
    sizes = F.transform(F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: F.floor(
        (F.col("n") + folds - 1 - F.pmod(f - F.col("start"), F.lit(folds))) / folds))
    limits = started.select("_of", F.transform(
        F.sequence(F.lit(1), F.lit(folds)), lambda i: F.aggregate(
            F.slice(sizes, F.lit(1), i), F.lit(0).cast("long"), lambda acc, x: acc + x)).alias("_limits"))
    ranked = row_numbers(df, id_column, "_rank", by=label).join(limits, F.col(label).eqNullSafe(F.col("_of")))
    fold = F.size(F.filter("_limits", lambda upto: upto < F.col("_rank")))
    return ranked.select(*df.columns, fold.alias("fold"))


def area_under_roc(scored: DataFrame) -> float:
    """By the probability of class 1: raw scores of some models are not comparable between rows."""
    return roc_auc(positive_probability(scored)).first()[0]


def cross_validate(folded: DataFrame, estimator: Estimator, folds: int = 5, parallelism: int = 4) -> DataFrame:
    """(metric, fold, value): area under ROC on each held-out fold, folds fitted side by side."""
    def one(fold: int) -> tuple[str, int, float]:
        model = estimator.fit(folded.filter(F.col("fold") != fold))
        return "roc_auc", fold, float(area_under_roc(model.transform(folded.filter(F.col("fold") == fold))))

    with ThreadPool(min(parallelism, folds)) as pool:
        rows = pool.map(one, range(folds))
    return folded.sparkSession.createDataFrame(rows, "metric string, fold int, value double")


# ---- parameter search ----------------------------------------------------------------

# Search ranges (low, high, step) or (low, high) or choices.
FOREST_SPACE = {
    "numTrees": ("steps", 100, 500, 50),
    "maxDepth": ("steps", 5, 30, 5),
    "minRowsToSplit": ("steps", 2, 20, 1),
    "minInstancesPerNode": ("steps", 1, 20, 1),
    "featureSubsetStrategy": ("choice", "sqrt", "log2", "all"),
}
BOOSTED_SPACE = {
    "maxIter": ("steps", 50, 300, 50),
    "stepSize": ("log", 0.01, 0.2),
    "maxDepth": ("steps", 3, 10, 1),
    "minHessian": ("steps", 1, 10, 1),
    "subsamplingRate": ("range", 0.5, 1.0),
    "featureShare": ("range", 0.5, 1.0),
    "gamma": ("range", 0.0, 5.0),
}
SPACES = {"random_forest": FOREST_SPACE, "boosted_trees": BOOSTED_SPACE}


def draw_settings(space: dict, trials: int, seed: int = 42) -> list[dict]:
    """Random settings from a search space; the same seed draws the same settings."""
    rng = random.Random(seed)

    return [{name: drawn(kind, limits, rng) for name, (kind, *limits) in space.items()} for _ in range(trials)]


def search_parameters(
    train: DataFrame, name: str, trials: int = 50, seed: int = 42, train_ratio: float = 0.8,
    parallelism: int = 4, settings: list[dict] | None = None,
) -> tuple[Search, DataFrame]:
    """Sequential search over a production model's space, by accuracy on a validation part of the training rows.

    Returns the search, whose ``bestModel`` is refitted on all rows, and the
    trials as (trial, settings, accuracy). ``settings`` are tried instead of proposed ones.
    """
    return search(train, production_model(name), SPACES[name], trials, seed, train_ratio, parallelism, settings)


# ---- timing --------------------------------------------------------------------------


def timed_fit_and_predict(estimator: Estimator, train: DataFrame, test: DataFrame) -> DataFrame:
    """(step, seconds): wall clock of fitting and of a full pass of predictions."""
    started = time.perf_counter()
    model = estimator.fit(train)
    fitted = time.perf_counter()
    model.transform(test).select("prediction").write.format("noop").mode("overwrite").save()
    done = time.perf_counter()
    return train.sparkSession.createDataFrame(
        [("train", fitted - started), ("predict", done - fitted)], "step string, seconds double"
    )
