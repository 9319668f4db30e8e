"""Pieces that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keeprate.session import settled, table

# Fixed: the word of the result contracts, everything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have yet, one per wanted name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """crc32 of the id as text, modulo ``parts``, is ``part``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts == part


def numbered(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """0-based row number in the given order, which must be total.

    Rows are range-partitioned and written once, so that the cuts are the same for
    every reader; each partition numbers its own rows from the sum of the earlier
    partitions' counts. No task sees more than its range.
    """
    from pyspark.sql import Window

    part, = fresh(df, "part")
    ranged = settled(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy(part).count()  # a row per partition
    before = sizes.select(
        F.col(part).alias("of_part"),
        F.coalesce(F.sum("count").over(
            Window.partitionBy(F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("n_before"),
    )
    own = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return ranged.withColumn(name, own).join(before, F.col(part) == F.col("of_part")).select(
        *[col(c) for c in df.columns], (F.col(name) + F.col("n_before") - 1).alias(name)
    )
