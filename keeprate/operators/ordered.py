"""Ranks and running totals over a whole table without a one-task window.

A window without ``partitionBy`` sends every row to one task. Here the rows are
range-partitioned by the key and written once, so that every reader sees the same
ranges; one total per range gives each range its starting offset, and a window inside
each range does the rest. The number of ranges is Spark's shuffle partition setting
(AQE may merge small neighbours), so it grows with the cluster's settings and has no limit here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from keeprate.session import settled


def hash_sample(df: DataFrame, column: str, rows: int, size: int) -> DataFrame:
    """About ``size`` of the ``rows`` rows, chosen by the hash of a column: the same ones every time."""
    share = max(1, rows // size)
    return df.filter(F.pmod(F.xxhash64(column), F.lit(share)) == 0)


def ranged(values: DataFrame, key: str, by: str | None = None, buckets: int | None = None) -> DataFrame:
    """The rows with ``_range``, the number of their key range; written once."""
    order = [by, key] if by else [key]
    dealt = values.repartitionByRange(buckets, *order) if buckets else values.repartitionByRange(*order)
    return settled(dealt.withColumn("_range", F.spark_partition_id()), "ranged")


def running_totals(
    values: DataFrame,
    key: str,
    totals: dict[str, str],
    by: str | None = None,
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Inclusive running sums in key order.

    ``values`` holds one row per key (per ``by`` group): group equal keys first, and select the
    needed columns, since the rows are written once. Keys are not null. ``totals`` maps new
    columns to the columns summed, and ``by`` restarts the sums per group. ``buckets`` sets the number of ranges.
    """
    groups = [by] if by else []
    placed = ranged(values, key, by, buckets)
    order = F.col(key).desc() if descending else F.col(key).asc()
    inside = Window.partitionBy(*groups, "_range").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = placed.select("*", *[F.sum(source).over(inside).alias(name) for name, source in totals.items()])
    sums = placed.groupBy(*groups, "_range").agg(
        *[F.sum(source).alias(name) for name, source in totals.items()]
    )
    # One row per group and range; without groups that is one row per range.
    range_order = F.col("_range").desc() if descending else F.col("_range").asc()
    earlier = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(range_order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = sums.select(
        *[F.col(g).alias(f"_of_{g}") for g in groups],
        F.col("_range").alias("_of_range"),
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}") for name in totals],
    )
    same = F.col("_range") == F.col("_of_range")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return running.join(before, same).select(
        *values.columns,
        *[(F.col(name) + F.col(f"_before_{name}")).alias(name) for name in totals],
    )


def with_next(values: DataFrame, key: str, what: Column, name: str) -> DataFrame:
    """Adds ``what`` of the row with the next smaller key, null for the smallest."""
    placed = ranged(values, key).withColumn("_what", what)
    inside = F.lead("_what").over(Window.partitionBy("_range").orderBy(F.desc(key)))
    heads = placed.groupBy("_range").agg(F.max_by("_what", key).alias("_head"))
    # One row per range.
    heads = heads.select(
        F.col("_range").alias("_of"), F.lag("_head").over(Window.partitionBy(F.lit(0)).orderBy("_range")).alias("_head")
    )
    return placed.withColumn("_inside", inside).join(heads, F.col("_range") == F.col("_of")).select(
        *values.columns, F.coalesce("_inside", "_head").alias(name)
    )


def row_numbers(df: DataFrame, key: str, name: str = "row_no", by: str | None = None) -> DataFrame:
    """1-based row number in the order of a unique key; only the key is written and sorted."""
    keys = df.select(*([by] if by else []), key, F.lit(1).cast("long").alias("_one"))
    numbered = running_totals(keys, key, {name: "_one"}, by=by).select(F.col(key).alias("_key"), name)
    return df.join(numbered, F.col(key) == F.col("_key")).drop("_key")


def dense_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """(value, code) with codes 0..n-1 in value order, nulls as the text ``nan``."""
    distinct = df.select(F.coalesce(F.col(column).cast("string"), F.lit("nan")).alias(column)).distinct()
    ones = distinct.withColumn("_one", F.lit(1).cast("long"))
    numbered = running_totals(ones, column, {name: "_one"}).drop("_one")
    return numbered.withColumn(name, (F.col(name) - 1).cast("int"))
