"""Shared pieces of the registered queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keeprate.functions.columns import yes_no_flag
from keeprate.operators.encode import engineered
from keeprate.plans.usage import customer_usage
from keeprate.schema import CORRELATION_BEFORE, FEATURES, MEASURES, PERIODS
from keeprate.session import settled

Query = Callable[[SparkSession, str], DataFrame]


def registered(names: dict) -> dict[str, Query]:
    """The queries of a module: functions named by operator id, such as ``a06_describe``."""
    return {name: value for name, value in names.items() if re.match(r"[a-z]\d\d_", name) and callable(value)}


def usage(spark: SparkSession, folder: str) -> DataFrame:
    return customer_usage(spark, folder)


def kept_usage(spark: SparkSession, folder: str) -> DataFrame:
    """The usage table written once, for queries that pass over it several times."""
    return settled(customer_usage(spark, folder), "usage")


def flagged(spark: SparkSession, folder: str, kept: bool = False) -> DataFrame:
    """Usage with 1/0 plans next to the texts and the engineered columns."""
    return engineered(kept_usage(spark, folder) if kept else usage(spark, folder)).withColumns(
        {"intl_flag": yes_no_flag("intl_plan"), "vmail_flag": yes_no_flag("vmail_plan")}
    )


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def cs_probability() -> Column:
    """A score with many ties that needs no model: cs_calls / (1 + cs_calls)."""
    return F.col("cs_calls") / (F.lit(1.0) + F.col("cs_calls"))


def smooth_probability() -> Column:
    """A score with few ties: logistic in the account age."""
    return 1 / (1 + F.exp((F.col("account_length") - F.lit(2000.0)) / 200.0))


def scored(spark: SparkSession, folder: str, probability: Column | None = None) -> DataFrame:
    """(customer_id, label, probability, prediction) from a score expression."""
    p = cs_probability() if probability is None else probability
    return usage(spark, folder).select(
        "customer_id", F.col("churn").cast("int").alias("label"), p.alias("probability")
    ).withColumn("prediction", (F.col("probability") > 0.8).cast("int"))


# ---- SQL -----------------------------------------------------------------------------

PERIOD_SQL = {
    "day": "l_returnflag = 'N' AND l_linestatus = 'O'",
    "eve": "l_returnflag = 'N' AND l_linestatus <> 'O'",
    "night": "l_returnflag <> 'N' AND l_linestatus = 'O'",
    "intl": "l_returnflag <> 'N' AND l_linestatus <> 'O'",
}

_LINE_SUMS = ", ".join(
    f"sum(CASE WHEN {mine} THEN l_quantity END) AS {p}_minutes, "
    f"count(CASE WHEN {mine} THEN 1 END) AS {p}_calls, "
    f"sum(CASE WHEN {mine} THEN l_extendedprice END) AS {p}_charge"
    for p, mine in PERIOD_SQL.items()
)
_MEASURES = ", ".join(
    f"round(coalesce({p}_minutes, 0.0), 2) AS {p}_minutes, "
    f"CAST(coalesce({p}_calls, 0) AS INTEGER) AS {p}_calls, "
    f"round(coalesce({p}_charge, 0.0), 2) AS {p}_charge"
    for p in PERIODS
)

# Common table expressions giving the views ``usage`` and ``flagged``.
USAGE_SQL = f"""
WITH lines AS (
  SELECT o_custkey AS line_custkey, {_LINE_SUMS}
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey
), per_customer AS (
  SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
    count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS pending_orders,
    count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS urgent_orders
  FROM orders GROUP BY o_custkey
), usage AS (
  SELECT c_custkey AS customer_id, n_name AS state,
    CAST(datediff('day', CAST(first_order AS DATE), DATE '2001-08-02') AS INTEGER) AS account_length,
    CAST(100 + c_nationkey % 3 AS INTEGER) AS area_code,
    CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'Yes' ELSE 'No' END AS intl_plan,
    CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS vmail_plan,
    CAST(CASE WHEN c_acctbal > 5000 THEN pending_orders ELSE 0 END AS INTEGER) AS vmail_messages,
    {_MEASURES},
    CAST(urgent_orders AS INTEGER) AS cs_calls,
    last_order < TIMESTAMP '2000-05-01' AS churn,
    CASE WHEN c_custkey % 5 < 4 THEN 'train' ELSE 'test' END AS split
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN per_customer ON c_custkey = o_custkey
  LEFT JOIN lines ON c_custkey = line_custkey
), flagged AS (
  SELECT *, day_calls + eve_calls + night_calls + intl_calls AS total_calls,
    day_charge + eve_charge + night_charge + intl_charge AS total_charge,
    CAST(cs_calls AS DOUBLE) / nullif(account_length + 1, 0) AS cs_rate,
    CASE intl_plan WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS intl_flag,
    CASE vmail_plan WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS vmail_flag
  FROM usage
)"""

CS_PROBABILITY_SQL = "cs_calls / (1.0e0 + cs_calls)"
SMOOTH_PROBABILITY_SQL = "1e0 / (1e0 + exp((account_length - 2000.0e0) / 200.0e0))"


def scored_sql(probability: str = CS_PROBABILITY_SQL) -> str:
    return f"""{USAGE_SQL}, probabilities AS (
  SELECT customer_id, CAST(churn AS INTEGER) AS label, {probability} AS probability FROM usage
), scored AS (
  SELECT *, CAST(probability > 0.8 AS INTEGER) AS prediction FROM probabilities
)"""


def each(columns: Iterable[str], template: str) -> str:
    """``template`` once per column (written ``{{c}}``), joined by UNION ALL."""
    return "\nUNION ALL ".join(template.replace("{c}", c) for c in columns)


FEATURE_LIST = ", ".join(FEATURES)
NUMERIC = [c for c in FEATURES if c not in ("state", "intl_plan", "vmail_plan")]
MEASURE_LIST = MEASURES
CORRELATED_LIST = CORRELATION_BEFORE
