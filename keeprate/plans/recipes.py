"""Feature recipes and their fitted pipelines.

``basic`` codes the text columns by position in the sorted training values and keeps
all nineteen features. ``full`` uses 1/0 plans, one-hot state and area code, the
engineered totals and rate, and leaves out the correlated columns. Either becomes
one saved ``PipelineModel`` that holds encoders, scaler and model together.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from keeprate.operators.encode import assembler, fit_scaler, index_stage, one_hot_stages
from keeprate.operators.resample import rebalance
from keeprate.schema import CORRELATED, FEATURES, PERIODS
from keeprate.session import settled, shared_folder

BASIC_TEXT = ["state", "intl_plan", "vmail_plan"]

# Features of the two re-trained models, by name of the full recipe. Slots of
# one-hot columns are named column_hot_value; a name that the data does not have is an error.
FOREST_SUBSET = [
    "total_charge", "cs_calls", "vmail_messages", "intl_calls", "intl_charge", "intl_flag", "area_hot_0000000101",
    "area_hot_0000000100", "state_hot_NATION_24", "night_calls",
]
BOOSTED_SUBSET = [
    "total_charge", "area_hot_0000000101", "area_hot_0000000100", "cs_calls", "area_hot_0000000102", "intl_calls", "intl_flag",
    "vmail_messages", "state_hot_NATION_22", "state_hot_NATION_24", "state_hot_NATION_17", "intl_charge", "state_hot_NATION_6", "cs_rate",
]


def basic_stages() -> list:
    texts = ", ".join(f"coalesce({c}, 'nan') AS {c}_text" for c in BASIC_TEXT)
    inputs = [f"{c}_code" if c in BASIC_TEXT else c for c in FEATURES]
    return [
        SQLTransformer(statement=f"SELECT *, {texts} FROM __THIS__"),
        index_stage([f"{c}_text" for c in BASIC_TEXT], [f"{c}_code" for c in BASIC_TEXT], "error"),
        assembler(inputs, "raw", "error"),
    ]


def full_stages(offset: int = 1) -> list:
    calls = " + ".join(f"{p}_calls" for p in PERIODS)
    charge = " + ".join(f"{p}_charge" for p in PERIODS)
    # Area codes are padded so that their text order is their number order.
    statement = (
        "SELECT *, CASE intl_plan WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS intl_flag, "
        "lpad(cast(area_code AS string), 10, '0') AS area, "
        f"{calls} AS total_calls, {charge} AS total_charge, "
        f"try_divide(cast(cs_calls AS double), account_length + {offset}) AS cs_rate FROM __THIS__"
    )
    plain = ["intl_flag" if c == "intl_plan" else c for c in FEATURES if c not in (*CORRELATED, "state", "area_code")]
    return [
        SQLTransformer(statement=statement),
        *one_hot_stages(["state", "area"]),
        assembler([*plain, "state_hot", "area_hot", "total_calls", "total_charge", "cs_rate"], "raw", "error"),
    ]


RECIPES = {"basic": basic_stages, "full": full_stages}


def fit_features(train: DataFrame, recipe: str = "full") -> PipelineModel:
    return Pipeline(stages=RECIPES[recipe]()).fit(train)


def encode(features: PipelineModel, df: DataFrame) -> DataFrame:
    """(customer_id, label, raw vector)."""
    return features.transform(df).select("customer_id", F.col("churn").cast("double").alias("label"), "raw")


def feature_names(df: DataFrame, column: str = "raw") -> list[str]:
    """Names of the vector slots, from the column's attributes."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a for group in groups.values() for a in group), key=lambda a: a["idx"])
    return [a["name"] for a in slots]


def as_points(encoded: DataFrame) -> DataFrame:
    """(id, label, vector array), the shape of the neighbour operators."""
    return encoded.select(
        F.col("customer_id").alias("id"), F.col("label").cast("int").alias("label"),
        vector_to_array("raw").alias("vector"),
    )


def rebalanced(encoded: DataFrame, **options) -> DataFrame:
    """Encoded training rows after rebalancing; new rows have ids of their own."""
    return rebalance(as_points(encoded), **options).select(
        F.col("id").alias("customer_id"), F.col("label").cast("double").alias("label"),
        array_to_vector("vector").alias("raw"),
    )


# Parts in which training rows are dealt to the tasks, by the hash of their id. Tree trainers sample
# per part, so this number, and nothing about the cluster or the input's files, belongs to the result.
# A part is what one task trains on: raise it with the table beyond some 10 GB of encoded rows.
TRAINING_PARTS = 16


def dealt(df: DataFrame, parts: int = TRAINING_PARTS) -> DataFrame:
    """Rows in ``parts`` partitions by id, each in id order."""
    return df.repartition(parts, "customer_id").sortWithinPartitions("customer_id")


class Prepared:
    """Training data ready for estimators, and the stages that lead there."""

    def __init__(self, stages: list[Transformer], train: DataFrame, names: list[str]):
        self.stages = stages
        self.train = train
        self.names = names

    def transform(self, df: DataFrame) -> DataFrame:
        """Applies the fitted stages to other rows: (customer_id, label, features)."""
        out = PipelineModel(self.stages).transform(df)
        label = [F.col("churn").cast("double").alias("label")] if "churn" in df.columns else []
        return out.select("customer_id", *label, "features")

    def model(self, fitted: Transformer) -> PipelineModel:
        """One pipeline from raw columns to predictions."""
        return PipelineModel([*self.stages, fitted])


def prepare(
    train: DataFrame, recipe: str = "full", balance: dict | None = None, subset: list[str] | None = None,
    parts: int = TRAINING_PARTS,
) -> Prepared:
    """Fits encoders and scaler on the training rows.

    ``balance`` turns on rebalancing between encoding and scaling, with its options.
    ``subset`` keeps only the named vector slots. The encoded rows are written once, since
    every estimator passes over them many times; ``parts`` is how they are dealt to tasks.
    """
    shared_folder(train.sparkSession)  # iterative trainers cut their lineage there
    features = fit_features(train, recipe)
    encoded = encode(features, train)
    names = feature_names(encoded)
    if balance is not None:
        encoded = rebalanced(encoded, **balance)
    stages = list(features.stages)
    source = "raw"
    if subset is not None:
        if unknown := [n for n in subset if n not in names]:
            raise ValueError(f"no such features: {unknown}; there are {names}")
        at = [names.index(n) for n in subset]
        slicer = VectorSlicer(inputCol="raw", outputCol="chosen", indices=at)
        encoded, source, names = slicer.transform(encoded).drop("raw"), "chosen", [names[i] for i in at]
        stages.append(slicer)
    encoded = settled(encoded, "encoded")
    scaling = fit_scaler(encoded, source, "features")
    for stage in scaling:
        encoded = stage.transform(encoded)
    return Prepared([*stages, *scaling], dealt(encoded.select("customer_id", "label", "features"), parts), names)


def fit(train: DataFrame, estimator: Estimator, recipe: str = "full", **options) -> PipelineModel:
    prepared = prepare(train, recipe, **options)
    return prepared.model(estimator.fit(prepared.train))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
