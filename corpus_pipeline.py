"""Training-data pipeline over documents: five stages, each reading what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keeprate.llm import decontamination, lines, minhash, mixing, toxicity
from keeprate.session import settled, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score, learned from ``labels``, is below 0.3."""
    return toxicity.keep_clean(spark, docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; ``n_chars`` follows the text."""
    return lines.without_repeats(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles, the smallest id."""
    return minhash.dedup(spark, docs, width=5, least=80, per=100)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is 0.8 similar to an item of ``benchmark``."""
    return decontamination.keep_clean(spark, docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the copies to take of each."""
    return mixing.mixed(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

# Learned scores and MinHash candidates have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again by the next.

    Null or empty texts are documents like others in every stage, and extra columns pass
    through. An empty table gives an empty result with the same columns.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
