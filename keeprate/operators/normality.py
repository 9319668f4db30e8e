"""Anderson-Darling normality test on whole columns.

With ``F`` the normal distribution function of the standardised value and ``i`` its
rank, the statistic is ``-n - sum((2i-1) ln F + (2(n-i)+1) ln(1-F)) / n``. In this
form a row needs only its own rank. Equal values are merged first: a value covering
ranks a+1..b contributes ``b^2 - a^2`` to the first weight, and ranks come from
bucketed running totals, so no task ever sorts a whole column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keeprate.functions.normal import log_normal_cdf
from keeprate.operators.ordered import running_totals
from keeprate.operators.profile import _number
from keeprate.operators.project import unpivot

# 5 % point for estimated mean and deviation (Stephens 1974).
CRITICAL_5_PERCENT = 0.787
CORRECTION = (4.0, -25.0)


def anderson_darling(df: DataFrame, columns: list[str], critical: float = CRITICAL_5_PERCENT) -> DataFrame:
    """(column, n, statistic, critical_value, is_normal); null rows are left out.

    A constant column has no defined statistic: it is reported null and not normal.
    """
    values = (
        unpivot(df, columns, "double").filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(values, "value", {"upto": "n"}, by="column")
    moments = df.agg(*[
        F.struct(
            F.count(_number(c)).alias("n"),
            F.avg(_number(c)).alias("mean"),
            F.stddev_samp(_number(c)).alias("std"),
        ).alias(c)
        for c in columns
    ]).first()

    def per_column(field: str):
        pairs = [F.when(F.col("column") == c, F.lit(moments[c][field])) for c in columns]
        return F.coalesce(*pairs) if len(pairs) > 1 else pairs[0]

    scored = (
        ranked.withColumn("total", per_column("n").cast("double"))
        .withColumn("w", F.try_divide(F.col("value") - per_column("mean"), per_column("std")))
        .withColumn("b", F.col("upto").cast("double"))
        .withColumn("a", F.col("b") - F.col("n"))
        .withColumn("low_weight", F.col("b") * F.col("b") - F.col("a") * F.col("a"))
        .withColumn("high_weight", 2 * F.col("total") * F.col("n") - F.col("low_weight"))
        .withColumn(
            "term",
            F.col("low_weight") * F.expr(log_normal_cdf("w")) + F.col("high_weight") * F.expr(log_normal_cdf("w", -1)),
        )
    )
    threshold = F.lit(critical) / (1 + CORRECTION[0] / F.col("n") + CORRECTION[1] / (F.col("n") * F.col("n")))
    return (
        scored.groupBy("column")
        .agg(F.sum("n").alias("n"), F.first("total").alias("total"), F.sum("term").alias("terms"))
        .select(
            "column", "n",
            (-F.col("total") - F.col("terms") / F.col("total")).alias("statistic"),
            threshold.alias("critical_value"),
        )
        .withColumn("is_normal", F.coalesce(F.col("statistic") < F.col("critical_value"), F.lit(False)))
    )


def split_by_normality(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """(normal columns, other columns), each in the given order."""
    normal = {r.column for r in anderson_darling(df, columns).collect() if r.is_normal}
    return [c for c in columns if c in normal], [c for c in columns if c not in normal]
