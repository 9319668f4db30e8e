"""Class rebalancing: synthetic minority rows, then neighbour-based cleaning.

Synthesis follows SMOTE (Chawla et al. 2002), cleaning follows edited nearest
neighbours (Wilson 1972) with the rule that all neighbours must agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from keeprate.operators.neighbors import nearest_neighbors, neighbor_lists
from keeprate.operators.ordered import row_numbers
from keeprate.session import settled


def _draw(seed: int, name: str) -> Column:
    """A hash per draw number: the same draw wherever and whenever it is computed."""
    return F.xxhash64(F.lit(seed), F.lit(name), F.col("draw"))


def rows_to_add(majority: int, minority: int, ratio: float) -> int:
    missing = int(majority * ratio - minority)
    if majority * ratio < minority:
        raise ValueError(f"the classes are {minority}/{majority}, already above the ratio {ratio:.4f}")
    return missing


def synthesize(df: DataFrame, ratio: float = 30 / 70, k: int = 5, seed: int = 42, **options) -> DataFrame:
    """New minority rows (id, label, vector) up to minority/majority = ``ratio``.

    ``df`` has ``id long``, ``label`` (0/1) and ``vector array<double>`` and is read
    several times, so pass a kept table. Every new row lies between a minority row and one of its k nearest minority rows.
    """
    counts = {
        r.label: (r.n, r.top)
        for r in df.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")).collect()
    }
    if len(counts) != 2:
        raise ValueError("rebalancing needs exactly two classes")
    minority, majority = sorted(counts, key=lambda c: counts[c][0])
    n_minority = counts[minority][0]
    n_new = rows_to_add(counts[majority][0], n_minority, ratio)
    if n_minority <= k:
        raise ValueError(f"{n_minority} minority rows are too few for {k} neighbours")
    top_id = max(top for _, top in counts.values())

    rare = df.filter(F.col("label") == F.lit(minority)).select("id", "vector")
    numbered = row_numbers(rare.select("id"), "id", "base_no")
    near = settled(nearest_neighbors(rare, k, **options).select("id", "rank", "neighbor_id"), "near")
    draws = df.sparkSession.range(1, n_new + 1).select(
        F.col("id").alias("draw")
    ).select(
        "draw",
        (F.pmod(_draw(seed, "base"), F.lit(n_minority)) + 1).alias("base_no"),
        (F.pmod(_draw(seed, "neighbor"), F.lit(k)) + 1).cast("int").alias("rank"),
        (F.pmod(_draw(seed, "share"), F.lit(1 << 52)) / F.lit(float(1 << 52))).alias("share"),
    )
    return (
        draws.join(numbered, "base_no")
        .join(near, ["id", "rank"])
        .join(rare, "id")
        .join(rare.select(F.col("id").alias("neighbor_id"), F.col("vector").alias("other")), "neighbor_id")
        .select(
            (F.lit(top_id) + F.col("draw")).alias("id"),
            F.lit(minority).alias("label"),
            F.zip_with("vector", "other", lambda x, y: x + F.col("share") * (y - x)).alias("vector"),
        )
    )


def edited(df: DataFrame, k: int = 3, **options) -> DataFrame:
    """Rows whose k nearest neighbours all have the row's own label."""
    lists = neighbor_lists(df, k, carry="label", **options)
    agree = F.forall("neighbors", lambda n: n["carried"] == F.col("label").cast("double"))
    return lists.filter(agree).drop("neighbors")


def rebalance(
    df: DataFrame, ratio: float = 30 / 70, k: int = 5, clean_k: int = 3, seed: int = 42, **options
) -> DataFrame:
    """Synthesis, then cleaning of all rows: (id, label, vector, synthetic)."""
    rows = settled(df.select("id", "label", "vector"), "rows")
    added = synthesize(rows, ratio, k, seed, **options)
    both = rows.withColumn("synthetic", F.lit(False)).unionByName(
        added.select("id", F.col("label").cast(rows.schema["label"].dataType), "vector", F.lit(True).alias("synthetic"))
    )
    return edited(settled(both, "rows-and-synthetic"), clean_k, **options)
