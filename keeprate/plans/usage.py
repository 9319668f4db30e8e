"""The customer-usage table, derived from the star-schema tables.

Line items are summed per order before the join, so the widest table is reduced
on the map side and then shuffled once, on the key the join needs as well. Orders
are summed per customer the same way; a customer holding a large share of all
orders is merged from partial sums and never gathered row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keeprate.schema import FEATURES, PERIODS
from keeprate.session import table

# Reference day of account age and the churn cutoff.
AS_OF = "2001-08-02"
CHURN_BEFORE = "2000-05-01"


# Lines of the four usage periods.
PERIOD_LINES = {
    "day": "l_returnflag = 'N' AND l_linestatus = 'O'",
    "eve": "l_returnflag = 'N' AND l_linestatus <> 'O'",
    "night": "l_returnflag <> 'N' AND l_linestatus = 'O'",
    "intl": "l_returnflag <> 'N' AND l_linestatus <> 'O'",
}


def _sums_per_order() -> list[Column]:
    return [
        F.expr(text)
        for period, lines in PERIOD_LINES.items()
        for text in (
            f"sum(CASE WHEN {lines} THEN l_quantity END) AS {period}_minutes",
            f"count_if({lines}) AS {period}_calls",
            f"sum(CASE WHEN {lines} THEN l_extendedprice END) AS {period}_charge",
        )
    ]


def customer_usage(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with orders: usage by period, plans, churn and split."""
    per_order = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(*_sums_per_order())
    per_customer = (
        table(spark, folder, "orders")
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_custkey")
        .agg(
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
            F.expr("count_if(o_orderstatus = 'P') AS pending_orders"),
            F.expr("count_if(o_orderpriority = '1-URGENT') AS urgent_orders"),
            *[
                F.expr(f"sum({period}_{kind}) AS {period}_{kind}")
                for period in PERIODS for kind in ("minutes", "calls", "charge")
            ],
        )
    )
    measures = [
        text
        for period in PERIODS
        for text in (
            f"round(coalesce({period}_minutes, 0D), 2) AS {period}_minutes",
            f"cast(coalesce({period}_calls, 0) AS int) AS {period}_calls",
            f"round(coalesce({period}_charge, 0D), 2) AS {period}_charge",
        )
    ]
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
        .selectExpr(
            "c_custkey AS customer_id",
            "n_name AS state",
            f"datediff(DATE '{AS_OF}', cast(first_order AS date)) AS account_length",
            "cast(100 + c_nationkey % 3 AS int) AS area_code",
            "CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'Yes' ELSE 'No' END AS intl_plan",
            "CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS vmail_plan",
            "cast(CASE WHEN c_acctbal > 5000 THEN pending_orders ELSE 0 END AS int) AS vmail_messages",
            *measures,
            "cast(urgent_orders AS int) AS cs_calls",
            f"last_order < TIMESTAMP_NTZ '{CHURN_BEFORE} 00:00:00' AS churn",
            "CASE WHEN c_custkey % 5 < 4 THEN 'train' ELSE 'test' END AS split",
        )
    )


def features_and_label(usage: DataFrame) -> DataFrame:
    return usage.select("customer_id", *FEATURES, "churn")


def train_rows(usage: DataFrame) -> DataFrame:
    return usage.filter(F.col("split") == "train").drop("split")


def held_out_rows(usage: DataFrame) -> DataFrame:
    return usage.filter(F.col("split") == "test").drop("split")
