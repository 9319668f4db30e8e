"""Feature importances of tree models as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keeprate.session import scratch_path


def importances(spark: SparkSession, model, names: list[str]) -> DataFrame:
    """(feature, importance), normalised; one row per feature."""
    values = model.featureImportances.toArray()
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    )


def ranked(table: DataFrame, by: str = "importance", top: int | None = None) -> DataFrame:
    """Largest first, names break ties; ``top`` limits the report."""
    ordered = table.orderBy(F.desc(by), "feature")
    return ordered if top is None else ordered.limit(top)


def split_importances(spark: SparkSession, model, names: list[str], path: str | None = None) -> DataFrame:
    """(feature, weight, gain): number of splits on a feature and their mean gain.

    The node table comes from the saved model, so large ensembles are read in parallel.
    """
    path = path or scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    labels = spark.createDataFrame(list(enumerate(names)), "index int, feature string")
    return (
        nodes.filter(F.col("feature") >= 0)
        .groupBy(F.col("feature").alias("index"))
        .agg(F.count(F.lit(1)).alias("weight"), F.avg("gain").alias("gain"))
        .join(labels, "index")
        .select("feature", "weight", "gain")
    )
