"""Registered queries: each applies an operator to its whole table and derives the result columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from keeprate.llm import (
    blockmax, decontamination, language, lines, minhash, mixing, negatives, neighbours, secrets, spelling, suffixes, toxicity, windows,
)
from keeprate.llm.common import documents, held_out
from keeprate.session import table


def op1_decontamination(spark, folder):
    return decontamination.leaks(spark, documents(spark, folder), table(spark, folder, "benchmark")).drop("text_hash")


def op2_windows(spark, folder):
    return windows.digest(windows.dedup(spark, documents(spark, folder)))


def op3_minhash(spark, folder):
    return minhash.group(spark, documents(spark, folder), 3, 85, 100).drop("text_hash")


def op4_toxicity(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


def op6_mixing(spark, folder):
    return mixing.mix(spark, documents(spark, folder))


def op5_lines(spark, folder):
    return lines.digest(lines.dedup(spark, documents(spark, folder)))


def op7_neighbours(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(spark, vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op8_secrets(spark, folder):
    return secrets.digest(secrets.scan(spark, documents(spark, folder)))


def op9_suffixes(spark, folder):
    return suffixes.digest(suffixes.dedup(spark, documents(spark, folder)))


def op10_language(spark, folder):
    docs = documents(spark, folder)
    return language.identify(docs, language.dictionaries(docs)).withColumn("held_out", held_out("doc_id", 5, 0))


def op11_topk(spark, folder):
    items = blockmax.bags(table(spark, folder, "embeddings"), 1024)
    return blockmax.search(spark, items, items.filter(F.col("id") % 100 == 0), 10)


def op12_negatives(spark, folder):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(spark, negatives.labelled(table(spark, folder, "embeddings"), 256, label), F.col("id") % 100 == 0)


def op13_spelling(spark, folder):
    return spelling.group(spark, spelling.counted(spelling.perturbed_words(documents(spark, folder))))


def queries():
    import corpus_pipeline

    own = {name: value for name, value in globals().items() if name.startswith("op") and name[2].isdigit()}
    return own | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    import corpus_pipeline

    from keeprate.llm.oracles import ORACLES

    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
