"""Outlier removal by z-score and by interquartile range."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from keeprate.functions.columns import zscore
from keeprate.operators.normality import split_by_normality
from keeprate.operators.profile import means_and_deviations
from keeprate.operators.project import keep_all_within
from keeprate.operators.quantiles import exact_quantiles
from keeprate.session import settled


def zscores(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``<column>_z``; population deviation of the whole table."""
    stats = means_and_deviations(df, columns)
    return df.withColumns({f"{c}_z": zscore(F.col(c), *stats[c]) for c in columns})


def remove_zscore_outliers(df: DataFrame, columns: list[str], limit: float = 3.0) -> DataFrame:
    """Rows whose every listed column is closer to its mean than ``limit`` deviations.

    The statistics are those of the unfiltered table, for all columns at once.
    """
    if not columns:
        return df
    stats = means_and_deviations(df, columns)
    return df.filter(reduce(and_, [F.abs(zscore(F.col(c), *stats[c])) < limit for c in columns]))


def iqr_limits(df: DataFrame, columns: list[str], reach: float = 1.5) -> dict[str, tuple[float, float]]:
    limits = {}
    for c, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items():
        if q1 is not None:
            limits[c] = (q1 - reach * (q3 - q1), q3 + reach * (q3 - q1))
    return limits


def remove_iqr_outliers(df: DataFrame, columns: list[str], sequential: bool = True) -> DataFrame:
    """Rows inside the whiskers of every column.

    Sequential mode takes the quartiles of each column from the rows that survived
    the columns before it, so the column order matters. The filters are literal
    ranges over the input, of which only the listed columns are read to find them, and the plan stays one scan with one predicate.
    The other mode takes all quartiles from the input, in one pass.
    """
    if not sequential:
        return keep_all_within(df, iqr_limits(df, columns))
    kept, measured = df, settled(df.select(*columns), "measured")
    for c in columns:
        limits = iqr_limits(measured, [c])
        kept, measured = keep_all_within(kept, limits), keep_all_within(measured, limits)
    return kept


def clean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Z-score rule on the normal columns, then the range rule on the others."""
    normal, other = split_by_normality(df, columns)
    return remove_iqr_outliers(remove_zscore_outliers(df, normal), other)
