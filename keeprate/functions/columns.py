"""Scalar expressions: flags, totals, rates, risk levels. All are JVM-side columns."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from keeprate.schema import PERIODS


def mapped(column: Column | str, mapping: dict) -> Column:
    """Dictionary lookup; a value outside the dictionary becomes null."""
    column = F.col(column) if isinstance(column, str) else column
    (first, value), *rest = mapping.items()
    out = F.when(column == F.lit(first), F.lit(value))
    for key, value in rest:
        out = out.when(column == F.lit(key), F.lit(value))
    return out


def yes_no_flag(column: Column | str) -> Column:
    return mapped(column, {"No": 0, "Yes": 1})


def yes_no_label(column: Column | str) -> Column:
    return mapped(column, {1: "Yes", 0: "No"})


def total(kind: str) -> Column:
    """Sum of a measure (``calls``, ``charge`` or ``minutes``) over the four periods."""
    return reduce(add, [F.col(f"{period}_{kind}") for period in PERIODS])


def service_call_rate(offset: int = 1) -> Column:
    """Service calls per day of account age; null where the divisor is zero."""
    return F.try_divide(F.col("cs_calls").cast("double"), F.col("account_length") + F.lit(offset))


def zscore(column: Column, mean: float, std: float) -> Column:
    """Standard score; 0 for a constant column."""
    if not std:
        return F.when(column.isNotNull(), F.lit(0.0))
    return (column - F.lit(mean)) / F.lit(std)


def confidence(probability: Column | str) -> Column:
    """Distance from the decision boundary, scaled to 0..1."""
    probability = F.col(probability) if isinstance(probability, str) else probability
    return F.abs(probability - 0.5) * 2


# Upper bounds (exclusive) of the risk levels.
LOW_BELOW = 0.3
MEDIUM_BELOW = 0.6


def risk_level(probability: Column | str) -> Column:
    probability = F.col(probability) if isinstance(probability, str) else probability
    return (
        F.when(probability < LOW_BELOW, "Low")
        .when(probability < MEDIUM_BELOW, "Medium")
        .when(probability.isNotNull(), "High")
    )


def as_percent(share: Column | str, digits: int = 2) -> Column:
    """``0.1234`` -> ``12.34%``, for display."""
    share = F.col(share) if isinstance(share, str) else share
    return F.format_string(f"%.{digits}f%%", share * 100)


def fixed_digits(value: Column | str, digits: int = 4) -> Column:
    """Value with a fixed number of digits, for display."""
    value = F.col(value) if isinstance(value, str) else value
    return F.format_string(f"%.{digits}f", value)


def log_day(ts: Column | str) -> Column:
    """Day key of the event log, ``yyyy.MM.dd`` in UTC (the session time zone)."""
    return F.date_format(ts, "yyyy.MM.dd")


def version_number(version: Column | str) -> Column:
    """``"1.10"`` -> struct(1, 10), which sorts by number instead of by text."""
    version = F.col(version) if isinstance(version, str) else version
    parts = F.split(version, r"\.")
    return F.struct(
        F.get(parts, F.lit(0)).try_cast("int").alias("major"),
        F.get(parts, F.lit(1)).try_cast("int").alias("minor"),
    )


def next_version(version: Column | str) -> Column:
    """Minor number plus one; ``1.1`` where the text is not two numbers."""
    version = F.col(version) if isinstance(version, str) else version
    number = version_number(version)
    following = F.concat_ws(".", number["major"], number["minor"] + 1)
    valid = (F.size(F.split(version, r"\.")) == 2) & number["major"].isNotNull() & number["minor"].isNotNull()
    return F.when(valid, following).otherwise(F.lit("1.1"))
