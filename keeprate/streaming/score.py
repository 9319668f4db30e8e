"""Streaming scoring: customer records in, prediction records out. Stateless."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from keeprate.plans.scoring import score, split_scorable
from keeprate.schema import file_schema
from keeprate.sources.files import CORRUPT, to_internal, with_corrupt


def customer_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Customer JSON files as they arrive, with their id; malformed records keep their text in ``_corrupt_record``."""
    reader = spark.readStream.schema(with_corrupt(file_schema(with_label=False, with_id=True)))
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return to_internal(reader.json(path))


def _append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def score_stream(model: PipelineModel, customers: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the predictions of all available customers that the model can take."""
    return _append(score(model, customers), path, checkpoint)


def reject_stream(model: PipelineModel, customers: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the records that ``score_stream`` leaves out, with their faults."""
    return _append(split_scorable(model, customers)[1], path, checkpoint)
