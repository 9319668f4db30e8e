"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a unit vector x by ``floor((a . x + b) / w)`` for a few Gaussian directions a.
A query visits, in every table, its own bucket and then the perturbed buckets in the order
of estimated success: the sum of squared distances to the cell walls that are crossed
(query-directed probing). Candidates of all tables are merged and ranked by exact cosine.

The number of probes is fitted: a bounded set of ``CALIBRATION`` rows is searched exactly,
and as many buckets are visited as it takes to meet ``AIM`` of their true neighbours. Where
``MOST_PROBES`` buckets are too few for that, the tables get fewer projections, so that their cells hold
more points; where even two are too many, every query goes over all points. What was found is then
checked on up to ``CALIBRATION`` of the queries themselves: with a recall below ``LEAST`` all
queries are searched exactly.

Equal vectors are one point that carries its smallest ids, so copies cost nothing. A
bucket is cut into chunks of about ``CHUNK`` points by the hash of the point; each chunk returns
at most k rows a query. The first ``EARLY`` buckets of each table give a k-th score, and the others return
only what reaches it, so what comes back grows with the queries and not with the buckets. Queries that found fewer than k go over all points, block by block.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from keeprate.session import settled

TABLES = 6
BUCKET = 64  # points a bucket, as intended
WIDTH = 1.2  # of a cell, in standard deviations of a projected unit vector
CHUNK = 4_000
CALIBRATION = 128
AIM = 0.96
LEAST = 0.9  # recall of the checked queries
EARLY = 8  # buckets a table that a query visits before its k-th score limits what the others return
MOST_PROBES = 4_096  # a query's buckets in one table


def points(vectors: DataFrame, id_column: str, vector_column: str, k: int) -> DataFrame:
    """(point, vector, ids): different valid vectors with their k + 1 smallest ids."""
    v = F.col("vector")
    valid = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")).filter(
        F.col("id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0))
    first = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    return valid.withColumn("place", first).filter(F.col("place") <= k + 1).groupBy("vector").agg(
        F.sort_array(F.collect_set("id")).alias("ids")).select(
        F.xxhash64("vector").alias("point"), F.size("vector").alias("size"), "vector", "ids")


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # very large or small components would overflow
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class Hashes:
    """The tables' directions and offsets, from a seed; ``size`` directions a table."""

    def __init__(self, dimension: int, size: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.size = size
        self.a = draw.normal(size=(TABLES, dimension, self.size))
        self.b = draw.uniform(0, WIDTH, size=(TABLES, self.size))
        self.mix = draw.integers(1, 1 << 62, size=(TABLES, self.size)) | 1

    def cells(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Whole cells, and how far into them each projection lies."""
        place = (x @ self.a[t] + self.b[t]) / WIDTH
        cell = np.floor(place)
        return cell.astype(np.int64), place - cell

    def keys(self, cells: np.ndarray, t: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells * self.mix[t]).sum(axis=-1)


@lru_cache(maxsize=16)
def _hashes(dimension: int, size: int) -> Hashes:
    return Hashes(dimension, size)


def _intended(count: int) -> int:
    """Directions a table for ``BUCKET`` of ``count`` points a bucket."""
    return max(2, round(math.log(max(count / BUCKET, 1)) / math.log(4)))


def probes(into: np.ndarray, most: int) -> np.ndarray:
    """Perturbations of a cell, nearest walls first: rows of -1, 0 and 1."""
    size = len(into)
    distance = np.concatenate([into, 1 - into]) ** 2
    order = np.argsort(distance, kind="stable")
    cost = distance[order]
    out, heap = [np.zeros(size, np.int64)], [(cost[0], (0,))]
    while heap and len(out) < most:
        value, chosen = heapq.heappop(heap)
        moves = order[list(chosen)]
        if len(set(moves % size)) == len(moves):
            step = np.zeros(size, np.int64)
            step[moves % size] = np.where(moves < size, -1, 1)
            out.append(step)
        last = chosen[-1]
        if last + 1 < 2 * size:
            heapq.heappush(heap, (value - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (value + cost[last + 1], (*chosen, last + 1)))
    return np.array(out)


def _best(query_ids: np.ndarray, queries: np.ndarray, vectors: np.ndarray, ids: list, k: int, floors: np.ndarray) -> list[tuple]:
    """(query, id, score) of the k best per query that reach its floor, ties to the smaller id."""
    norm = lambda x: np.sqrt((x * x).sum(axis=1))
    largest = max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0))
    if largest > 1e100 or largest < 1e-100:
        queries, vectors = _unit(queries), _unit(vectors)
    scores = (queries @ vectors.T) / norm(queries)[:, None] / norm(vectors)[None, :]
    rows = []
    keep = min(k + 1, scores.shape[1])
    least = np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep]
    for q, row, limit in zip(query_ids, scores, np.maximum(least, floors)):
        found = []
        for j in np.flatnonzero(row >= limit):
            found += [(-row[j], i) for i in ids[j] if i != q]
        rows += [(q, i, -s) for s, i in sorted(found)[:k]]
    return rows


def rescored(found: DataFrame, asked: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """The found pairs with their cosine summed in the order of the components, and the ranks that follow."""
    of = index.select(F.explode("ids").alias("vec_id"), "vector")
    pairs = found.select("query_id", "vec_id").join(of, "vec_id").join(asked, "query_id").filter(F.size("q") == F.size("vector"))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)
    # Very large or small components would overflow in their squares.
    unit = lambda v: F.transform(v, lambda x: x / F.array_max(F.transform(v, F.abs)))
    pairs = pairs.select("query_id", "vec_id", unit(F.col("q")).alias("q"), unit(F.col("vector")).alias("v"))
    norm = lambda v: F.sqrt(total(F.transform(v, lambda x: x * x)))
    score = total(F.zip_with("q", "v", lambda x, y: x * y)) / (norm("q") * norm("v"))
    return _ranked(pairs.select("query_id", "vec_id", score.alias("score")), k).select("query_id", "rank", "vec_id", "score")


RESULT = "query_id long, vec_id long, score double"


def _search(queries: DataFrame, index: DataFrame, keys: list[str], k: int) -> DataFrame:
    """k rows a query and group at most; queries: (keys, query_id, q[, floor]), index: (keys, vector, ids)."""

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        vectors, ids, rows = _matrix(right["vector"]), right["ids"].tolist(), []
        for start in range(0, len(left), 512):
            part = left.iloc[start:start + 512]
            # The last bits of a product may depend on what is multiplied with it.
            floors = part["floor"].to_numpy() - 1e-9 if "floor" in part else np.full(len(part), -np.inf)
            rows += _best(part["query_id"].to_numpy(), _matrix(part["q"]), vectors, ids, k, floors)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    return queries.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInPandas(one, RESULT)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", place).filter(F.col("rank") <= k)


def exact(queries: DataFrame, index: DataFrame, k: int, blocks: int) -> DataFrame:
    """Every query against every point of its length, in blocks of points."""
    spread = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return _ranked(_search(spread, index.withColumn("block", F.pmod("point", F.lit(blocks)).cast("int")), ["size", "block"], k), k)


def _true_pairs(index: DataFrame, k: int, blocks: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors of ``CALIBRATION`` points and, row by row, of their true neighbours, by length."""
    chosen = index.orderBy(F.xxhash64("point", F.lit(1)), "point").limit(CALIBRATION).select(
        F.col("ids")[0].alias("query_id"), "size", F.col("vector").alias("q"))
    chosen = settled(chosen, "calibration")
    true = exact(chosen, index, k, blocks).select("query_id", "vec_id")
    members = index.select("vector", "size", F.explode("ids").alias("vec_id"))
    pairs = true.join(members, "vec_id").join(chosen, ["query_id", "size"]).select("size", "q", "vector").collect()  # CALIBRATION times k at most
    lengths = sorted({p["size"] for p in pairs})
    return [tuple(_unit(np.array([p[c] for p in pairs if p["size"] == d], float)) for c in ("q", "vector")) for d in lengths]


def _place(into: np.ndarray, step: np.ndarray) -> int:
    """Where a perturbation stands in the order of ``probes``, from 1."""
    walls = np.stack([into, 1 - into]) ** 2
    costs = np.zeros(1)
    for low, high in walls.T:
        costs = np.concatenate([costs, costs + low, costs + high])
    own = walls[0][step == -1].sum() + walls[1][step == 1].sum()
    return int((costs <= own + 1e-12).sum())


def _fitted(pairs: list[tuple[np.ndarray, np.ndarray]], size: int) -> int | None:
    """How many buckets a query must visit in each table; None if ``MOST_PROBES`` miss the aim."""
    ranks = [np.zeros(0)]
    for q, v in pairs:
        hashes, rank = _hashes(q.shape[1], size), np.full(len(q), math.inf)
        for t in range(TABLES):
            (own, into), (other, _) = hashes.cells(q, t), hashes.cells(v, t)
            for i, step in enumerate(other - own):
                if np.abs(step).max() <= 1:
                    rank[i] = min(rank[i], _place(into[i], step))
        ranks.append(rank)
    rank = np.sort(np.concatenate(ranks))
    if not len(rank):
        return 1
    needed = rank[min(len(rank) - 1, math.ceil(AIM * len(rank)) - 1)]
    return int(needed) if needed <= MOST_PROBES else None


def _recall(asked: DataFrame, found: DataFrame, index: DataFrame, k: int, blocks: int) -> float:
    """Share of the true neighbours of up to ``CALIBRATION`` queries that were found."""
    chosen = settled(asked.orderBy(F.xxhash64("query_id", F.lit(3)), "query_id").limit(CALIBRATION), "checked")
    true = settled(exact(chosen, index, k, blocks).select("query_id", "vec_id"), "true")
    count = true.count()
    return true.join(found, ["query_id", "vec_id"], "left_semi").count() / count if count else 1.0


def nearest(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 5,
            id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, by cosine.

    ``queries`` are rows of the same columns; a query's own id is no candidate. Only
    those two columns are read. Rows with a null id, a null or empty vector, null or non-finite
    components or only zeros take no part. Vectors of different lengths have no cosine: a query's
    candidates are those of its length. An id that comes twice counts once, at its best score, and asks
    with its smallest vector. Equal scores go to the smaller id. Fewer than k candidates: all of them. Empty tables give no rows. Where probing
    does not reach the recall, the search is exact and costs queries times points.
    """
    index = settled(points(vectors, id_column, vector_column, k), "points")
    count = index.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = queries.select(F.col(id_column).cast("long").alias("query_id"), F.col(vector_column).cast("array<double>").alias("q"))
    asked = settled(asked.filter(
        F.col("query_id").isNotNull() & F.col("q").isNotNull()
        & F.forall("q", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("q", lambda x: x != 0)
    ).groupBy("query_id").agg(F.min("q").alias("q")).withColumn("size", F.size("q")), "queries")
    blocks = max(1, math.ceil(count / CHUNK))
    pairs = _true_pairs(index, k, blocks)
    for directions in range(_intended(count), 1, -1):
        visits = _fitted(pairs, directions)
        if visits is not None:
            break
    else:
        return rescored(exact(asked, index, k, blocks), asked, index, k)

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, same in frame.groupby("size"):
                x, hashes = _unit(_matrix(same["vector"])), _hashes(int(size), directions)
                for t in range(TABLES):
                    yield same.assign(table=np.int32(t), bucket=hashes.keys(hashes.cells(x, t)[0], t))

    def visiting(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, same in frame.groupby("size"):
                x, hashes = _unit(_matrix(same["q"])), _hashes(int(size), directions)
                for t in range(TABLES):
                    own, into = hashes.cells(x, t)
                    for i in range(len(same)):
                        buckets = hashes.keys(own[i] + probes(into[i], visits), t)
                        yield pd.DataFrame({"query_id": same["query_id"].iloc[i], "size": np.int32(size), "q": [same["q"].iloc[i]] * len(buckets),
                                            "table": np.int32(t), "bucket": buckets, "turn": np.arange(len(buckets))})

    hashed = settled(index.mapInPandas(placed, "point long, size int, vector array<double>, ids array<long>, table int, bucket long"), "index")
    chunks = hashed.groupBy("table", "size", "bucket").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    chunks = settled(chunks, "chunks")
    held = hashed.join(chunks, ["table", "size", "bucket"]).withColumn("chunk", F.pmod(F.xxhash64("point", F.lit(2)), "chunks").cast("int"))
    spread = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "query_id")  # a query makes many probes
    visited = spread.mapInPandas(visiting, "query_id long, size int, q array<double>, table int, bucket long, turn long")
    ways = chunks.select(*[(F.col(c)).alias(c) for c in ("table", "size", "bucket")], (F.col("chunks") - 1).alias("last"))
    visited = settled(visited.join(ways, ["table", "size", "bucket"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("last")))), "visited")
    keys = ["table", "size", "bucket", "chunk"]
    early = settled(_ranked(_search(visited.filter(F.col("turn") < EARLY), held, keys, k), k).drop("rank"), "early")
    floors = early.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).filter(F.col("n") == k).drop("n")
    late = visited.filter(F.col("turn") >= EARLY).join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0)))
    found = settled(_ranked(_search(late, held, keys, k).unionByName(early.select("query_id", "vec_id", "score")), k), "found")
    served = found.groupBy("query_id").count().filter(F.col("count") >= k).select("query_id")
    if _recall(asked.join(served, "query_id", "left_semi"), found, index, k, blocks) < LEAST:
        return rescored(exact(asked, index, k, blocks), asked, index, k)
    short = asked.join(served, "query_id", "left_anti")
    rest = exact(settled(short, "short"), index, k, blocks)
    full = found.join(rest.select("query_id").distinct(), "query_id", "left_anti")
    return rescored(full.unionByName(rest), asked, index, k)
