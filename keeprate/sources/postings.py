"""Words in messages of the event log, found without reading all its files.

The index has one row per word and file of the log that holds it, sorted by word. A search
reads the rows of its words, then only the files that hold all of them and files that came
after the last update, and tests the messages there. Updates are committed whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keeprate.schema import LOG_SCHEMA
from keeprate.sources import commits

KIND = "postings"
POSTING = "word string, file string"


def words(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits; none of a null."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(parts, lambda w: w != ""))


def _key(file: str) -> str:
    """One spelling of a file's address: Spark gives it with one slash or three after the scheme."""
    return re.sub(r"^(\w+):/+", r"\1:/", file)


def _files(spark: SparkSession, path: str) -> dict[str, str]:
    return {_key(file): file for file in spark.read.schema(LOG_SCHEMA).parquet(path).inputFiles()}


def _read(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(*files)


def _postings(spark: SparkSession, index: str) -> DataFrame:
    return commits.rows(spark, index, KIND, schema=POSTING)


def update(spark: SparkSession, path: str, index: str) -> int:
    """Adds the files that the index does not have yet; returns their number.

    Each file has a row with the empty word as well, so that files without words count as known.
    """
    known = {_key(r.file) for r in _postings(spark, index).filter("word = ''").select("file").collect()}
    new = [file for key, file in _files(spark, path).items() if key not in known]
    if new:
        held = _read(spark, path, new).select(
            F.explode(F.array_append(words(F.col("message")), "")).alias("word"), F.input_file_name().alias("file")).distinct()
        commits.append(spark, held.repartitionByRange("word", "file").sortWithinPartitions("word", "file"), index, KIND)
    return len(new)


def files_with(spark: SparkSession, path: str, index: str, wanted: list[str]) -> list[str]:
    """Files of the log that hold all the words, or are not in the index."""
    held = _postings(spark, index).filter(F.col("word").isin([*wanted, ""])).groupBy("file").agg(
        (F.count_distinct("word") == len({*wanted, ""})).alias("all")).collect()
    known = {_key(r.file): r["all"] for r in held}
    return [file for key, file in sorted(_files(spark, path).items()) if known.get(key, True)]


def search_messages(spark: SparkSession, path: str, index: str, text: str, days: list[str] | None = None) -> DataFrame:
    """Events whose message holds every word of ``text``, in any order and case; none if it has no word."""
    wanted = spark.range(1).select(words(F.lit(text))).first()[0]
    log = _read(spark, path, files_with(spark, path, index, wanted) if wanted else [])
    if days is not None:
        log = log.filter(F.col("log_date").isin(days))
    return log.filter(F.size(F.array_intersect(words(F.col("message")), F.array(*map(F.lit, wanted)).cast("array<string>"))) == len(wanted))
