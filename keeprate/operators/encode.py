"""Encoding and scaling, as column operators and as fitted ML stages."""

from __future__ import annotations

import math

from pyspark.ml import Transformer
from pyspark.ml.feature import (
    ElementwiseProduct, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from keeprate.functions.columns import total, service_call_rate, yes_no_flag, zscore
from keeprate.operators.ordered import dense_codes
from keeprate.operators.profile import means_and_deviations
from keeprate.schema import CORRELATED

MOST_CATEGORIES = 10_000  # that become columns of a table


def label_codes(train: DataFrame, column: str, apply_to: DataFrame | None = None) -> DataFrame:
    """Adds ``<column>_code``: position of the text among the sorted training values.

    A value unseen in training stops the job with an error.
    """
    codes = dense_codes(train, column, f"{column}_code").withColumnRenamed(column, "_value")
    rows = train if apply_to is None else apply_to
    text = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
    return rows.join(codes, text == F.col("_value"), "left").drop("_value").withColumn(
        f"{column}_code",
        F.when(F.col(f"{column}_code").isNotNull(), F.col(f"{column}_code")).otherwise(
            F.raise_error(F.concat(F.lit(f"unseen label in {column}: "), text)).cast("int")
        ),
    )


def one_hot(df: DataFrame, column: str, categories: list) -> DataFrame:
    """0/1 columns ``<column>_<category>``; unknown and null values are all zeros."""
    return df.withColumns({
        f"{column}_{c}": F.coalesce((F.col(column) == F.lit(c)).cast("int"), F.lit(0)) for c in categories
    })


def categories_of(df: DataFrame, column: str) -> list:
    """Sorted distinct values, which become columns of the caller's table; more than ``MOST_CATEGORIES`` are an error."""
    found = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(MOST_CATEGORIES + 1).collect()
    if len(found) > MOST_CATEGORIES:
        raise ValueError(f"{column} has more than {MOST_CATEGORIES} values; one_hot_stages keeps them in one vector column")
    return sorted(r[0] for r in found)


def standard_scaled(train: DataFrame, columns: list[str], apply_to: DataFrame | None = None) -> DataFrame:
    """Columns replaced by standard scores with the training mean and population deviation."""
    stats = means_and_deviations(train, columns)
    rows = train if apply_to is None else apply_to
    return rows.withColumns({c: zscore(F.col(c), *stats[c]) for c in columns})


def engineered(df: DataFrame, offset: int = 1) -> DataFrame:
    """Adds total calls, total charge and the service-call rate."""
    return df.withColumns({
        "total_calls": total("calls"),
        "total_charge": total("charge"),
        "cs_rate": service_call_rate(offset),
    })


def without_correlated(df: DataFrame) -> DataFrame:
    return df.drop(*CORRELATED)


def plan_flags(df: DataFrame) -> DataFrame:
    """Yes/No plans as 1/0 integers, churn as 1/0."""
    return df.withColumns({c: yes_no_flag(c) for c in ("intl_plan", "vmail_plan")})


# ---- fitted stages -------------------------------------------------------------------


def index_stage(columns: list[str], outputs: list[str], unseen: str) -> StringIndexer:
    """Codes of several columns, learned in one pass."""
    return StringIndexer(
        inputCols=columns, outputCols=outputs, stringOrderType="alphabetAsc", handleInvalid=unseen
    )


def one_hot_stages(columns: list[str]) -> list:
    """Indexer plus encoder: one slot per training category, zeros for anything else."""
    indexed = [f"{c}_index" for c in columns]
    return [
        index_stage(columns, indexed, "keep"),
        OneHotEncoder(
            inputCols=indexed, outputCols=[f"{c}_hot" for c in columns], dropLast=True, handleInvalid="error"
        ),
    ]


def assembler(columns: list[str], output: str, invalid: str = "keep") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid=invalid)


def fit_scaler(df: DataFrame, source: str, output: str) -> list[Transformer]:
    """Fitted scaling with the population deviation.

    Spark's scaler divides by the sample deviation; a constant factor corrects it.
    """
    scaler = StandardScaler(inputCol=source, outputCol=f"{source}_std", withMean=True, withStd=True).fit(df)
    n = df.count()
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    product = ElementwiseProduct(
        inputCol=f"{source}_std", outputCol=output, scalingVec=Vectors.dense([factor] * scaler.mean.size)
    )
    return [scaler, product]
