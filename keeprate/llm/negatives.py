"""Hard-negative mining with segment summaries.

Vectors are cut into segments of 64, of 16 and of 4 components, and the mean and the deviation of every
segment are stored. For segments x, y of L components, x . y lies within
L * (mean x * mean y +- deviation x * deviation y); the sum over segments bounds the score. An anchor meets the rows in
three refinements: with the bounds of the coarsest segments first, and only rows that these leave open
get finer ones; the rest is scored exactly.

* A positive is open while its upper bound reaches the k-th best lower bound of its label.
* A negative is open while its bounds touch the window of one of the anchor's positives, and its
  upper bound reaches the k-th best lower bound of the rows that surely lie in that window.

Rows are numbered by label and cut into blocks of ``BLOCK``; a task holds one block and at most
about ``PART`` anchors. Blocks are met in rounds that grow eightfold, chosen by hash: what the earlier ones found
raises the least score that can still matter, so that few rows leave the later ones.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from keeprate.llm.common import numbered
from keeprate.llm.sparse import best, product, whole_numbers
from keeprate.session import settled

BLOCK = 2_048  # rows
PART = 256  # anchors that meet a block in one task
SEGMENTS = (64, 16, 4)  # components of a segment, level by level
GROWTH = 8
DENSE = 0.1  # share of open pairs above which whole products are cheaper
LEAST = np.iinfo(np.int64).min

BLOCKS = ("block long, ids array<long>, of array<int>, labels array<long>, width int, vectors binary, means binary, deviations binary")


def matrix(vectors: list, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros to ``width``."""
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def padded(vectors: list) -> int:
    """The width that holds all vectors in whole segments."""
    return max(1, -(-max((len(v) for v in vectors), default=0) // SEGMENTS[0])) * SEGMENTS[0]


def summaries(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every segment of ``size`` components."""
    parts = x.reshape(len(x), x.shape[1] // size, size).astype(float)
    return parts.mean(axis=2), parts.std(axis=2)


def blocks_of(rows: DataFrame) -> DataFrame:
    """Blocks of rows in (label, id) order with their vectors and stored summaries."""
    placed = numbered(rows, F.col("label"), F.col("id"), name="number")

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        vectors = frame["vector"].tolist()
        x = matrix(vectors, padded(vectors))
        means, deviations = zip(*(summaries(x, size) for size in SEGMENTS))
        labels, of = np.unique(frame["label"].to_numpy(), return_inverse=True)
        return pd.DataFrame({
            "block": [key[0]], "ids": [frame["id"].to_numpy()], "of": [of.astype(np.int32)], "labels": [labels], "width": [x.shape[1]],
            "vectors": [x.tobytes()], "means": [np.concatenate(means, axis=1).tobytes()], "deviations": [np.concatenate(deviations, axis=1).tobytes()]})

    return placed.withColumn("block", F.floor(F.col("number") / BLOCK)).groupBy("block").applyInPandas(build, BLOCKS)


class Block:
    """One block's arrays next to the anchors that it meets, all over the same components."""

    def __init__(self, row, anchors: list):
        n, width = len(row.ids), row.width
        self.ids, self.labels = np.asarray(row.ids), np.asarray(row.labels)[np.asarray(row.of)]
        self.vectors = np.frombuffer(row.vectors, np.int64).reshape(n, width)
        held = [np.frombuffer(c, float).reshape(n, -1) for c in (row.means, row.deviations)]
        cuts = np.cumsum([width // size for size in SEGMENTS])[:-1]
        self.levels = list(zip(SEGMENTS, *(np.split(c, cuts, axis=1) for c in held)))
        # Components that one side lacks count as 0 and add nothing.
        self.anchors = matrix([a[:width] for a in anchors], width)

    def open_bounds(self, alive: np.ndarray, keep) -> np.ndarray:
        """Refines level by level; ``keep(low, high, alive)`` says which pairs stay open."""
        for size, mean, deviation in self.levels:
            if not alive.any():
                break
            own_mean, own_deviation = summaries(self.anchors, size)
            middle = size * _pairs(own_mean, mean, alive)
            reach = size * _pairs(own_deviation, deviation, alive)
            slack = 0.5 + 1e-9 * (np.abs(middle) + reach)  # of rounding; scores are whole numbers
            alive = keep(middle - reach - slack, middle + reach + slack, alive)
        return alive

    def scores(self, alive: np.ndarray) -> np.ndarray:
        """Exact scores of the open pairs; others are undefined."""
        return _pairs(self.anchors, self.vectors, alive)


def _pairs(a: np.ndarray, b: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """a @ b.T where ``alive``; few pairs are multiplied one by one."""
    whole = a.dtype.kind == "i"
    if alive.mean() > DENSE:
        return product(a, b.T) if whole else a @ b.T
    out = np.zeros(alive.shape, a.dtype)
    left, right = np.nonzero(alive)
    for start in range(0, len(left), 1 << 14):
        i, j = left[start:start + (1 << 14)], right[start:start + (1 << 14)]
        out[i, j] = (a[i] * b[j]).sum(axis=1)
    return out


def _kth(values: np.ndarray, sure: np.ndarray, k: int) -> np.ndarray:
    """By row the k-th largest of the values that are sure; minus infinity if there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    known = np.where(sure, values, -np.inf)
    return np.partition(known, known.shape[1] - k, axis=1)[:, known.shape[1] - k]


def _meet(pairs: DataFrame, blocks: DataFrame, one, schema: str) -> DataFrame:
    """Applies ``one(anchors, block)`` to each block and part of the anchors that visit it."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [one(left, Block(row, left["vector"].tolist())) for row in right.itertuples()] if len(left) else []
        names = [c.split()[0] for c in schema.split(", ")]
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in names}).astype("int64")

    needed = pairs.select(F.col("block").alias("of_block"), F.col("part").alias("of_part")).distinct()
    held = needed.join(blocks, F.col("of_block") == F.col("block")).drop("block")
    return pairs.groupBy("block", "part").cogroup(held.groupBy("of_block", "of_part")).applyInPandas(run, schema)


def _in_round(block: Column, number: int, rounds: int) -> Column:
    """Whether a block belongs to a round: the last holds most, each before an eighth of the next."""
    share = F.pmod(F.xxhash64(block), F.lit(1 << 20)) / (1 << 20)
    upper, lower = GROWTH ** -(rounds - 1 - number), GROWTH ** -(rounds - number)
    return (share < upper) & (share >= (lower if number else 0))


def _positives(anchors: DataFrame, blocks: DataFrame, rounds: int, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): the k best rows of the anchor's own label."""
    def one(left: pd.DataFrame, block: Block) -> pd.DataFrame:
        known = left["floor"].to_numpy().astype(float)
        same = (left["label"].to_numpy()[:, None] == block.labels) & (left["anchor_id"].to_numpy()[:, None] != block.ids)
        keep = lambda low, high, alive: alive & (high >= np.maximum(known, _kth(low, alive, k))[:, None])
        alive = block.open_bounds(same, keep)
        scores, out = block.scores(alive), []
        for anchor, floor, row, able in zip(left["anchor_id"], left["floor"], scores, alive):
            able = np.flatnonzero(able & (row >= floor))
            chosen = able[best(row[able], block.ids[able], k)]
            out.append(pd.DataFrame({"anchor_id": anchor, "positive_id": block.ids[chosen], "positive_score": row[chosen]}))
        return pd.concat(out)

    places = blocks.select("block", F.explode("labels").alias("label"))
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    found = None
    for number in range(rounds):
        asked = anchors
        if found is not None:
            kth = found.groupBy("anchor_id").agg(F.count("*").alias("n"), F.min("positive_score").alias("floor")).filter(F.col("n") == k).drop("n")
            asked = anchors.join(kth, "anchor_id", "left")
        else:
            asked = anchors.withColumn("floor", F.lit(None).cast("long"))
        asked = asked.withColumn("floor", F.coalesce("floor", F.lit(int(LEAST))))
        pairs = asked.join(places.filter(_in_round(F.col("block"), number, rounds)), "label")
        new = _meet(pairs, blocks, one, "anchor_id long, positive_id long, positive_score long")
        new = new if found is None else new.unionByName(found)
        found = settled(new.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank"), "positives")
    return found


def mine(
    spark: SparkSession, rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, per: int = 100,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` are (id, label, vector) with whole components, an id once, as ``labelled`` makes them; ``anchors`` is a
    condition on them. An anchor's positives are the ``positives`` other rows of its label with
    the highest inner product; for each, the ``negatives`` highest rows of other labels with
    low * positive_score <= per * negative_score <= high * positive_score are returned. Ties go to the
    smaller id; where there are fewer, all come. A positive without negatives gives no row, so a
    negative positive score gives none. Vectors of different lengths are
    filled up with zeros. Empty tables give no rows.
    """
    blocks = settled(blocks_of(rows), "blocks")
    count = blocks.count()
    asked = rows.filter(anchors).select(F.col("id").alias("anchor_id"), F.col("label").cast("long").alias("label"), "vector")
    asked_count = asked.count()
    if not count or not asked_count:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    parts = math.ceil(asked_count / PART)
    asked = settled(asked.withColumn("part", F.pmod(F.xxhash64("anchor_id"), F.lit(parts)).cast("int")), "anchors")
    rounds = 1 + max(0, math.ceil(math.log(count / GROWTH, GROWTH)))
    chosen = _positives(asked, blocks, rounds, positives)
    listed = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("p"))  # ``positives`` at most
    asked = settled(asked.join(listed, "anchor_id"), "anchors")

    def one(left: pd.DataFrame, block: Block) -> pd.DataFrame:
        scores_of = [np.array([p["positive_score"] for p in x], np.int64) for x in left["p"]]
        wide = max(len(s) for s in scores_of)
        windows = np.full((wide, 3, len(left)), np.nan)  # lowest, highest, known k-th; NaN: no such positive
        for i, (s, floors) in enumerate(zip(scores_of, left["floors"])):
            windows[:len(s), :, i] = np.stack([low * s / per, high * s / per, np.asarray(floors, float)], axis=1)
        other = left["label"].to_numpy()[:, None] != block.labels

        def keep(least: np.ndarray, most: np.ndarray, alive: np.ndarray) -> np.ndarray:
            out = np.zeros_like(alive)
            for bottom, top, known in windows[:, :, :, None]:
                sure = alive & (least >= bottom) & (most <= top)
                needed = np.fmax(np.fmax(bottom, known), _kth(least, sure, negatives)[:, None])
                out |= alive & (most >= needed - 0.5) & (least <= top + 0.5)
            return out

        alive = block.open_bounds(other, keep)
        scores, out = block.scores(alive), []
        for anchor, listed, floors, row, able in zip(left["anchor_id"], left["p"], left["floors"], scores, alive):
            able = np.flatnonzero(able)
            row, ids = row[able], block.ids[able]
            for p, floor in zip(listed, floors):
                score = p["positive_score"]
                within = np.flatnonzero((low * score <= per * row) & (per * row <= high * score) & (row >= floor))
                top = within[best(row[within], ids[within], negatives)]
                out.append(pd.DataFrame({"anchor_id": anchor, "positive_id": p["positive_id"], "negative_id": ids[top],
                                         "positive_score": score, "negative_score": row[top]}))
        return pd.concat(out)

    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    found = None
    for number in range(rounds):
        if found is None:
            open_ones = asked.withColumn("floors", F.transform("p", lambda p: F.lit(int(LEAST))))
        else:
            kth = found.filter(F.col("rank") == negatives).groupBy("anchor_id").agg(
                F.map_from_entries(F.collect_list(F.struct("positive_id", "negative_score"))).alias("kth"))
            open_ones = asked.join(kth, "anchor_id", "left").withColumn("floors", F.transform(
                "p", lambda p: F.coalesce(F.get(F.map_values(F.map_filter("kth", lambda k, v: k == p["positive_id"])), F.lit(0)), F.lit(int(LEAST))))).drop("kth")
        visited = open_ones.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))).filter(
            _in_round(F.col("block"), number, rounds))
        new = _meet(visited, blocks, one, schema)
        new = new if found is None else new.unionByName(found.drop("rank"))
        found = settled(new.withColumn("rank", rank).filter(F.col("rank") <= negatives), "negatives")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def labelled(vectors: DataFrame, scale: int, label: Column, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, label, vector): the rows that take part, with floor(scale * x) of each component x."""
    taken = vectors.select(F.col(id_column).alias("id"), label.cast("long").alias("label"), F.col(vector_column).alias("vector"))
    return whole_numbers(taken, scale, "id", "vector", "label")
