"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 60-bit hash of its id and text. Taking a share of a source
means taking the documents below a hash threshold; a second and third copy are
taken in full before the share of the next one, so the thresholds are nested. A
threshold is found without sorting: sizes are summed by (source, hash bucket), the
bucket in which the budget runs out is the only one refined by the next bits, until
one hash value remains, which is taken if that comes nearer to the budget.

Only sums per (source, bucket) are shuffled, at most ``2 ** BITS`` rows a source and
level, after a partial sum in each task. A source with a third of all rows is one
more set of partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from keeprate.llm.common import WORD, col, fresh, numbered
from keeprate.session import settled

BITS, LEVELS = 10, 6  # 60 bits of hash, refined by ten at a time
SALTS = 64


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _position() -> Column:
    """Where a document lies between 0 and 2^60, by its id and text."""
    digest = F.md5(F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")),
    ).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h): size in words, h the position."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), _size().alias("size"), _position().alias("h"))


def targets(spark: SparkSession, sizes: DataFrame, weights=(5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order, null last, take the weights in turn. The total is
    shared by weight; a source whose share exceeds ``most`` times its size stops there,
    and the rest is shared anew until none is above. Each step reads two sums.
    """
    ordered = numbered(sizes, F.col("source").asc_nulls_last(), name="place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = settled(ordered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most), "sources")
    total, all_weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (total or 0) / all_weights if all_weights else 0.0
    while True:
        full = F.col("cap") < F.col("weight") * F.lit(level)
        capped, free = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))
        ).first()
        raised = (total - capped) / free if free else level
        if raised <= level:
            break
        level = raised
    return sources.select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level)).alias("target")
    )


def _joined(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """Rows with their source's values, joined on (source, part of the hash): no task gets a hot source whole."""
    salted = by_source.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(
        salted, F.col("source").eqNullSafe(F.col("of_source")) & ((F.col("h") % SALTS).cast("int") == F.col("salt"))
    ).drop("salt")


def _boundary(rows: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """The state one level down: (source, prefix, rest, unit) of the bucket in which the budget runs out."""
    shift = BITS * (LEVELS - 1 - level)
    inside = _joined(rows, state)
    if level:
        inside = inside.filter(F.shiftright("h", shift + BITS) == F.col("prefix"))
    sums = inside.groupBy("of_source", "rest", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("unit"))
    upto = F.sum("unit").over(Window.partitionBy("of_source").orderBy("bucket"))
    return sums.withColumn("upto", upto).filter(
        (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("unit") <= F.col("rest"))
    ).select("of_source", F.col("bucket").alias("prefix"), (F.col("rest") - F.col("upto") + F.col("unit")).alias("rest"), "unit")


def cuts(spark: SparkSession, rows: DataFrame, weights=(5, 2, 1), most: int = 3) -> DataFrame:
    """(of_source, source_size, target, whole, threshold): documents of a source below the threshold are taken
    ``whole + 1`` times, the others ``whole`` times."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = settled(targets(spark, sizes, weights, most).withColumns({
        "whole": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"),
    }).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "wanted")
    state = wanted.select(F.col("source").alias("of_source"), "rest")
    for level in range(LEVELS):
        state = _boundary(rows, state, level)
    found = wanted.join(state.select("of_source", "prefix", F.col("rest").alias("left_over"), "unit"),
                        F.col("source").eqNullSafe(F.col("of_source")), "left")
    threshold = F.when(F.col("prefix").isNull(), F.lit(1 << 60)).otherwise(
        F.col("prefix") + (F.col("left_over") * 2 > F.col("unit")).cast("long"))
    return found.select(
        F.col("source").alias("of_source"), "source_size", "target", "whole",
        F.when(F.col("whole") < most, threshold).otherwise(F.lit(0)).alias("threshold"))


def _copies() -> Column:
    return F.col("whole") + (F.col("h") < F.col("threshold")).cast("int")


def mix(spark: SparkSession, docs: DataFrame, weights=(5, 2, 1), most: int = 3) -> DataFrame:
    """Copies to take of every document so that sources come near their targets.

    Needs doc_id, source and text; other columns, whatever their names, are not
    read. Returns a row per input row: doc_id, source, size (words), source_size,
    target, copies (0 to ``most``), taken (size times copies).

    Null or empty text: size 0, nothing to take. Null source: a source of its own,
    ordered last. Null doc_id: a document like others. Rows equal in id and text share a
    hash and are taken together. A source without words has target 0. An empty
    table gives an empty result. The taken words of a source differ from its target by
    at most half the unit at its threshold (one document, or its equal rows).
    """
    rows = settled(sized(docs), "sized")
    return _joined(rows, cuts(spark, rows, weights, most)).select(
        "doc_id", "source", "size", "source_size", "target", _copies().alias("copies"), (F.col("size") * _copies()).alias("taken"))


def mixed(spark: SparkSession, docs: DataFrame, weights=(5, 2, 1), most: int = 3) -> DataFrame:
    """The documents of the mix: all columns of those taken at least once, with size, target, copies and taken.

    A column of ``docs`` that has one of these names keeps it; the added one gets a leading underscore. Cases are those of ``mix``.
    """
    found = cuts(spark, settled(sized(docs), "sized"), weights, most)
    size, target, copies, taken = fresh(docs, "size", "target", "copies", "taken")
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("document"), F.col("source").cast("string").alias("source"),
                       _size().alias("size"), _position().alias("h"))
    return _joined(rows, found).filter(_copies() > 0).select(
        *[F.col("document").getField(c).alias(c) for c in docs.columns], F.col("size").alias(size), F.col("target").alias(target),
        _copies().alias(copies), (F.col("size") * _copies()).alias(taken))
