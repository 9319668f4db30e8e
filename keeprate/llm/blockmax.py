"""Exact top-k search by block-at-a-time pruning.

Documents are bags of weighted terms (the components of a vector are its terms). They are put in
an order in which documents with the same leading terms stand together, and cut into ranges of
``BLOCK``. A block keeps, for every term, the largest and the smallest weight in it, and a
forward index: its documents' terms and weights, document by document.

For a query, the sum of its weights times a block's extreme weights bounds every score in the block. The
blocks are visited by falling bound, in rounds that grow eightfold: the best ``FIRST`` blocks
give a first k-th score, and of the others only those go on whose bound reaches it; each round
raises it. A query is done when no bound is left that reaches its k-th score. Bounds are
compared with "reaches", not "exceeds", so that ties go to the smaller id.

Bounds and scores are computed in tasks of one block, or ``SUMMARIES`` block summaries, and at most about
``PART`` queries; thresholds, pairs and results stay in tables. Where the vectors have no structure the
bounds exclude nothing, and every query is scored against every block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from keeprate.llm.common import numbered
from keeprate.llm.sparse import Rows, best, products, whole_numbers
from keeprate.session import settled

BLOCK = 512  # documents
PART = 512  # queries that meet a block in one task
SUMMARIES = 256  # block summaries that one task bounds queries with
LEADS = 3  # leading terms that order the documents
FIRST, GROWTH = 2, 8  # blocks a query visits first, and how their number grows
LEAST = np.iinfo(np.int64).min

BLOCKS = ("block long, ids array<long>, starts array<int>, terms array<long>, weights array<long>, "
          "of array<long>, most array<long>, least array<long>")
SCORED = "query_id long, vec_id long, score long"


def bags(vectors: DataFrame, scale: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, terms, weights): vectors as bags of their components, floor(scale * x) each; zeros are left out."""
    rows = whole_numbers(vectors, scale, id_column, vector_column)
    entries = F.filter(F.transform("vector", lambda x, i: F.struct(i.cast("long").alias("term"), x.alias("weight"))), lambda e: e["weight"] != 0)
    return rows.select("id", entries.alias("e")).select("id", F.col("e.term").alias("terms"), F.col("e.weight").alias("weights"))


def blocks_of(items: DataFrame) -> DataFrame:
    """Forward indexes and summaries of ranges of ``BLOCK`` documents."""
    entries = F.arrays_zip("terms", "weights")
    leading = F.slice(F.array_sort(F.transform(entries, lambda e: F.struct(
        -F.abs(e["weights"]), (e["terms"] * 2 + (e["weights"] < 0).cast("long")).alias("lead")))), 1, LEADS)
    placed = numbered(items.withColumn("leads", leading["lead"]), F.col("leads"), F.col("id"), name="number")

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        rows = Rows(frame["terms"].tolist(), frame["weights"].tolist())
        order = np.argsort(rows.term, kind="stable")
        term, first = np.unique(rows.term[order], return_index=True)
        most, least = (np.zeros(0, np.int64),) * 2
        if len(term):
            most, least = (f.reduceat(rows.weight[order], first) for f in (np.maximum, np.minimum))
            some = np.diff(np.append(first, len(order))) < len(frame)  # others hold the term with weight 0
            most[some], least[some] = np.maximum(most[some], 0), np.minimum(least[some], 0)
        starts = np.concatenate([[0], np.cumsum(np.bincount(rows.row, minlength=rows.count))])
        return pd.DataFrame({"block": [key[0]], "ids": [frame["id"].to_numpy()], "starts": [starts.astype(np.int32)], "terms": [rows.term],
                             "weights": [rows.weight], "of": [term], "most": [most], "least": [least]})

    return placed.withColumn("block", F.floor(F.col("number") / BLOCK)).select("block", "id", "terms", "weights").groupBy(
        "block").applyInPandas(build, BLOCKS)


def _bounds(queries: DataFrame, summaries: DataFrame, parts: int, groups: int, first: int | None) -> DataFrame:
    """(query_id, block, bound) of the ``first`` blocks of each query and group, or of all that reach its ``floor``."""

    def bound(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "block": [], "bound": []}).astype("int64")
        asked = Rows(left["terms"].tolist(), left["weights"].tolist())
        most, least = (Rows(right["of"].tolist(), right[c].tolist()) for c in ("most", "least"))
        top = products(asked.part(asked.weight > 0), most) + products(asked.part(asked.weight < 0), least)
        block = right["block"].to_numpy()
        if first is None:
            q, b = np.nonzero(top >= left["floor"].to_numpy()[:, None])
        else:
            chosen = [best(row, block, first) for row in top]
            q, b = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen]), np.concatenate(chosen)
        return pd.DataFrame({"query_id": left["query_id"].to_numpy()[q], "block": block[b], "bound": top[q, b]})

    asked = queries.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    held = summaries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("grp", (F.col("block") % groups).cast("int"))
    return asked.groupBy("part", "grp").cogroup(held.groupBy("part", "grp")).applyInPandas(bound, "query_id long, block long, bound long")


def _scored(pairs: DataFrame, queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Up to k documents a query and block whose score reaches the query's ``floor``; pairs: (query_id, block)."""

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block in right.itertuples() if len(left) else ():
            cuts = np.asarray(block.starts)[1:-1]
            held = Rows(np.split(np.asarray(block.terms), cuts), np.split(np.asarray(block.weights), cuts))
            ids = np.asarray(block.ids)
            scores = products(Rows(left["terms"].tolist(), left["weights"].tolist()), held)
            for query, least, row in zip(left["query_id"], left["floor"], scores):
                able = np.flatnonzero((row >= least) & (ids != query))
                chosen = able[best(row[able], ids[able], k)]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[chosen], "score": row[chosen]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    wanted = pairs.join(queries, "query_id")
    needed = wanted.select(F.col("block").alias("of_block"), F.col("part").alias("of_part")).distinct()
    held = needed.join(blocks.select("block", "ids", "starts", "terms", "weights"), F.col("of_block") == F.col("block")).drop("block")
    return wanted.groupBy("block", "part").cogroup(held.groupBy("of_block", "of_part")).applyInPandas(score, SCORED)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def search(spark: SparkSession, items: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k items of the highest inner product with each query.

    Both sides are (id, terms, weights) with whole numbers, as ``bags`` makes them; terms of one item are distinct, an
    id comes once. An item with a query's own id is no candidate for it. Equal scores go to
    the smaller id; fewer than k candidates: all of them, negative scores too. Empty bags
    score 0. An empty table on either side gives no rows. Scores must fit 64 bits.
    """
    blocks = settled(blocks_of(items), "blocks")
    count, asked_count = blocks.count(), queries.count()
    if not count or not asked_count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parts, groups = math.ceil(asked_count / PART), math.ceil(count / SUMMARIES)
    asked = settled(queries.select(F.col("id").alias("query_id"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "terms", "weights"), "queries")
    summaries = blocks.select("block", "of", "most", "least")
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")

    def with_floor(found: DataFrame | None) -> DataFrame:
        if found is None:
            return asked.withColumn("floor", F.lit(int(LEAST)))
        kth = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
        return asked.join(kth, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(int(LEAST))))

    open_queries = with_floor(None)
    head = _bounds(asked, summaries, parts, groups, FIRST).withColumn("place", F.row_number().over(by_bound)).filter(F.col("place") <= FIRST)
    head = settled(head.select("query_id", "block"), "head")
    found = settled(_ranked(_scored(head, open_queries, blocks, k), k), "found")
    rest = _bounds(with_floor(found), summaries, parts, groups, None).join(head, ["query_id", "block"], "left_anti")
    rest = settled(rest.withColumn("place", F.row_number().over(by_bound)), "rest")
    low, last = 0, rest.agg(F.max("place")).first()[0] or 0
    size = FIRST * GROWTH
    while low < last:
        open_queries = with_floor(found)
        pairs = rest.filter((F.col("place") > low) & (F.col("place") <= low + size)).join(
            open_queries.select("query_id", "floor"), "query_id").filter(F.col("bound") >= F.col("floor")).select("query_id", "block")
        new = _scored(pairs, open_queries, blocks, k)
        found = settled(_ranked(found.drop("rank").unionByName(new), k), "found")
        low, size = low + size, size * GROWTH
    return found.select("query_id", "rank", "vec_id", "score")
