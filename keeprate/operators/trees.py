"""Forests and second-order boosted trees, grown from histograms.

Features are cut into at most ``BINS`` bins once; a row is then a short string of codes. What a row adds to a node
(gradient and Hessian, or weighted label and weight, and its count) is kept as whole numbers, so sums do not depend on
their order: the same trees come from any partitioning, any number of tasks and after lost executors.

The open nodes of all trees under way are a frontier. While a node has more than ``SMALL`` rows, each partition
adds up its rows' histograms, they are summed by node in a shuffle, and the best split of each node comes back as one
row; every level is one job. The rows of smaller nodes go to one task each, which grows what is left
of the branch. Both ways take the same splits.

Draws are hashes: a row's share in a tree of (seed, tree, row id), a node's columns of (seed, tree, path). Rows need an
id of their own; without the column ``idCol`` it is the hash of the row's values, and equal rows are drawn alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasSeed, HasStepSize, HasWeightCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, functions as F

from keeprate.session import discard, scratch_path, settled

BINS = 256
SMALL = 65_536  # rows of a node that one task finishes
ALONE = 16  # times SMALL: rows of a boosted model that one task grows, some rounds at a time
ALONE_CODES = 1 << 25  # rows times columns of such a model
SHALLOW = 6  # depth up to which trees with the same columns in all nodes stay with histograms, whose number is bounded then
CELLS = 4_000_000  # histogram cells that a partition adds up at a time
DRAWN_ROWS = 200_000_000  # rows times trees that one job deals out
MOST_NODES = 5_000_000  # of a boosted model; it is held whole where it scores
SORTED = 8_192  # codes of a node whose split is found by sorting, together with other nodes; larger ones have histograms
ENTRIES = 1_000_000  # codes that are sorted at a time
JOINT_CELLS = 1 << 16  # of the columns that a large node's histogram takes together
JOINT_ROWS = 32_768  # of a node whose histogram is taken so
HELD_HISTOGRAMS = 256  # of a level that a task keeps for the next one
GATHERED_ROWS = 1 << 16  # that a task takes together: a node's share of fewer rows costs little but calls
DEALT_BYTES = 1 << 23  # of rows that a task hands on at a time
HELD_NODES = 200_000  # of trees that are sent to all tasks
SCORED_ROWS = 1 << 16  # vectors of a block that walks trees which are not sent to all
SCORED_BYTES = 1 << 26  # of branches and vectors that a task meets, as intended, and of the votes that it holds
VOTE = float(1 << 40)  # a tree's vote is a whole multiple of 1 / VOTE, so that votes add up in any order
UNIT = float(1 << 26)  # statistics are whole multiples of 1 / UNIT
CUT = 8  # boosting rounds after which margins are written
ROUNDS = 100  # boosting rounds that such a task takes in turn


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def draw(seed: int, number: int, ids: np.ndarray) -> np.ndarray:
    """A uniform number in [0, 1) for each id."""
    salt = mixed(mixed(np.array([seed & 0xFFFFFFFF], np.uint64) + np.uint64(1)) + np.uint64(number))
    return (mixed(ids.astype(np.int64).view(np.uint64) ^ salt) >> np.uint64(11)).astype(float) / float(1 << 53)


# ---- bins ----------------------------------------------------------------------------


def bin_edges(df: DataFrame, features: str) -> list[np.ndarray]:
    """Ascending cuts of each feature: every value where there are fewer than ``BINS``, else quantiles of a sketch.

    A value's code is the number of cuts below it. Three aggregates over all features at once;
    NaN counts as larger than every number.
    """
    first = df.select(F.size(vector_to_array(features)).alias("n")).first()
    if first is None:
        raise ValueError("no training rows")
    wide = df.select(vector_to_array(features).alias("v")).select(*[F.get("v", F.lit(i)).alias(f"f{i}") for i in range(first["n"])])
    counts = wide.agg(*[F.approx_count_distinct(c).alias(c) for c in wide.columns]).first()
    # The estimate errs by a few percent, which bounds what is collected here.
    few = [c for c in wide.columns if counts[c] <= 1.2 * BINS]
    sets = wide.agg(*[F.collect_set(c).alias(c) for c in few]).first() if few else {}
    values = {c: np.unique(np.array(sets[c], float)) for c in few}
    values = {c: v[~np.isnan(v)] for c, v in values.items()}
    many = [c for c in wide.columns if c not in values or len(values[c]) >= BINS]
    shares = [i / (BINS - 1) for i in range(1, BINS - 1)]
    sketched = wide.approxQuantile(many, shares, 0.25 / BINS) if many else []
    values |= {c: np.unique(np.array(q, float)) for c, q in zip(many, sketched)}
    return [values[c] for c in wide.columns]


def coded(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    out = np.empty(values.shape, np.uint8)
    for i, c in enumerate(cuts):
        out[:, i] = np.searchsorted(c, values[:, i], "left")
    return out


def binned(df: DataFrame, features: str, label: str, weight: str | None, id_column: str, cuts: list[np.ndarray]) -> DataFrame:
    """(id, label, weight, codes), written once."""
    own_id = F.col(id_column).cast("long") if id_column in df.columns else F.xxhash64(features, label)
    rows = df.select(
        own_id.alias("id"), F.col(label).cast("double").alias("label"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"), vector_to_array(features).alias("values"))
    shared = df.sparkSession.sparkContext.broadcast(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column(3).flatten()).reshape(batch.num_rows, -1)
            codes = coded(values, shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([c.tobytes() for c in codes], pa.binary())], ["id", "label", "weight", "codes"])

    return settled(rows.mapInArrow(run, "id long, label double, weight double, codes binary"), "binned")


def _codes(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    parts = [np.zeros(0, np.uint8)]
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(chunk):
            ends = np.frombuffer(chunk.buffers()[1], np.int64 if pa.types.is_large_binary(chunk.type) else np.int32)
            parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[ends[chunk.offset]:ends[chunk.offset + len(chunk)]])
    return (parts[1] if len(parts) == 2 else np.concatenate(parts)).reshape(-1, size)


# ---- splits --------------------------------------------------------------------------


class Newton:
    """Second-order gain: (sum of gradients)^2 / (sum of Hessians + l2), of both sides less that of the node."""

    least_gain = 1e-6

    def __init__(self, l2: float, gamma: float, least_hessian: float, depth: int):
        self.l2, self.gamma, self.least_hessian, self.depth = l2, gamma, least_hessian, depth

    def score(self, s):
        return s[0] * s[0] / (s[1] + self.l2)

    def allowed(self, left, right):
        return (left[1] >= self.least_hessian) & (right[1] >= self.least_hessian)

    def is_open(self, s, depth: int) -> bool:
        return (depth < self.depth) & (s[1] >= 2 * self.least_hessian) & (s[2] > 1)

    def value(self, s) -> float:
        return -s[0] / (s[1] + self.l2)


class Gini:
    """Decrease of weighted Gini impurity; counts are unweighted rows with their repeats."""

    least_gain = -1e-9  # a split that only divides an impure node may be needed further down
    gamma = 0.0

    def __init__(self, rows_to_split: int, rows_in_leaf: int, depth: int):
        self.rows_to_split, self.rows_in_leaf, self.depth = rows_to_split, rows_in_leaf, depth

    def score(self, s):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(s[1] > 0, -2 * s[0] * (s[1] - s[0]) / s[1], 0.0)

    def allowed(self, left, right):
        return (left[2] >= self.rows_in_leaf) & (right[2] >= self.rows_in_leaf)

    def is_open(self, s, depth: int) -> bool:
        return (depth < self.depth) & (s[2] >= self.rows_to_split) & (0 < s[0]) & (s[0] < s[1])

    def value(self, s) -> float:
        return np.divide(s[0], s[1], out=np.zeros_like(s[0]), where=s[1] > 0)


class Columns:
    """The columns a node may split on: a share drawn for each tree, or a number for each node."""

    def __init__(self, size: int, seed: int, a_tree: float = 1.0, a_node: int | None = None):
        self.size, self.seed, self.a_tree, self.a_node = size, seed, max(1, round(a_tree * size)), a_node

    def of(self, tree: int, key: int) -> np.ndarray:
        columns = np.arange(self.size)
        if self.a_tree < self.size:
            columns = np.sort(np.argsort(draw(self.seed + 1, tree, columns), kind="stable")[:self.a_tree])
        if self.a_node is not None and self.a_node < len(columns):
            columns = np.sort(columns[np.argsort(draw(self.seed + 2, tree, columns ^ key), kind="stable")[:self.a_node]])
        return columns

    def of_each(self, tree: int, keys: np.ndarray) -> np.ndarray:
        """``of`` of many nodes, a row for each."""
        columns = Columns(self.size, self.seed, self.a_tree / self.size).of(tree, 0)
        if self.a_node is None or self.a_node >= len(columns):
            return np.tile(columns, (len(keys), 1))
        drawn = draw(self.seed + 2, tree, columns[None, :] ^ keys[:, None])
        return np.sort(columns[np.argsort(drawn, axis=1, kind="stable")[:, :self.a_node]], axis=1)


def child_key(key: int, side: int) -> int:
    """The name of a node's path, whatever order nodes are made in."""
    return int(child_keys(np.array([key], np.int64), np.array([side]))[0])


def child_keys(keys: np.ndarray, sides: np.ndarray) -> np.ndarray:
    return (mixed(keys.astype(np.uint64) * np.uint64(2) + (sides + 1).astype(np.uint64)) >> np.uint64(2)).astype(np.int64)


def histogram(codes: np.ndarray, columns: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """Sums of the three statistics by column and bin; whole numbers, exact below 2^53."""
    return histograms(codes, columns, stats, np.zeros(len(codes), np.int64), 1)[0]


def histograms(codes: np.ndarray, columns: np.ndarray, stats: np.ndarray, node: np.ndarray, count: int) -> np.ndarray:
    """``histogram`` of several nodes; ``node`` is the number of each row's."""
    out, node, stats = np.empty((count, 3, len(columns), BINS)), node * BINS, stats.astype(float, copy=False)
    for i, column in enumerate(columns):
        at = node + codes[:, column]
        for j, s in enumerate(_summands(stats)):
            out[:, j, i] = np.bincount(at, s, BINS * count).reshape(count, BINS)
    return out


def _summands(stats: np.ndarray) -> tuple:
    """Of the three statistics; two of them where each row counts once."""
    return (*stats, None)[:3]


def scaled(sums: np.ndarray) -> np.ndarray:
    """Statistics in their own units; counts are not scaled."""
    out = np.array(sums, float)
    out[:2] /= UNIT
    return out


def best_split(sums: np.ndarray, rule):
    """(gain, place among the columns, bin, sums on the left) of the best split; ties to the first column and bin."""
    left = sums.cumsum(axis=2)[:, :, :-1]
    right = sums.sum(axis=2)[:, :1, None] - left
    a, b, whole = scaled(left), scaled(right), scaled(sums.sum(axis=2)[:, 0])
    gain = rule.score(a) + rule.score(b) - rule.score(whole)
    gain = np.where(rule.allowed(a, b) & (left[2] > 0) & (right[2] > 0), gain, -np.inf)
    at = int(gain.argmax())
    column, cut = divmod(at, gain.shape[1])
    # A copy: trees keep these sums, and a view would keep the node's whole histogram with them.
    return float(gain[column, cut]), column, cut, left[:, column, cut].copy()


class Joint:
    """Columns with few bins together as one, so that a large node's histogram is few passes over its rows; the sums are those of ``histogram``."""

    def __init__(self, codes: np.ndarray):
        self.counts = codes.max(axis=0).astype(int) + 1
        self.groups, left = [], sorted(range(codes.shape[1]), key=lambda i: self.counts[i])
        while left:
            group = [left.pop()]
            for i in reversed(left.copy()):
                if math.prod(self.counts[[*group, i]].tolist()) <= JOINT_CELLS:
                    group.append(i)
                    left.remove(i)
            self.groups.append(group)
        self.cells = []
        for group in self.groups:
            cell = np.zeros(len(codes), np.uint16)
            for i in group:
                cell = cell * np.uint16(self.counts[i] % JOINT_CELLS) + codes[:, i]
            self.cells.append(cell)

    def take(self, rows: np.ndarray) -> Joint:
        out = object.__new__(Joint)
        out.counts, out.groups, out.cells = self.counts, self.groups, [c.take(rows) for c in self.cells]
        return out

    def histogram(self, rows: np.ndarray, columns: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """Of ``rows``, whose statistics are given."""
        out, place = np.zeros((3, len(columns), BINS)), {c: i for i, c in enumerate(columns.tolist())}
        for group, cells in zip(self.groups, self.cells):
            if not any(c in place for c in group):
                continue
            shape, at = self.counts[group].tolist(), cells.take(rows).astype(np.intp)
            for j, s in enumerate(_summands(stats)):
                sums = np.bincount(at, s, math.prod(shape)).reshape(shape)
                for k, c in enumerate(group):
                    if c in place:
                        out[j, place[c], :shape[k]] = sums.sum(axis=tuple(x for x in range(len(group)) if x != k))
        return out


class Tree:
    """Nodes in lists, the root first; feature -1 is a leaf or a node still open."""

    FIELDS = ("feature", "cut", "left", "right", "gain")

    def __init__(self):
        self.feature, self.cut, self.left, self.right, self.gain = [], [], [], [], []
        self.stats, self.key, self.depth = [], [], []

    def add(self, stats, key: int, depth: int) -> int:
        for field, value in zip(self.FIELDS, (-1, 0, -1, -1, 0.0)):
            getattr(self, field).append(value)
        self.stats.append(np.asarray(stats, float))
        self.key.append(key)
        self.depth.append(depth)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: int, gain: float, left_stats) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        children = (np.asarray(left_stats, float), self.stats[node] - left_stats)
        self.left[node], self.right[node] = (
            self.add(s, child_key(self.key[node], side), self.depth[node] + 1) for side, s in enumerate(children))
        return self.left[node], self.right[node]

    def split_all(self, nodes: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, sums: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
        """Splits many nodes; ``sums``, ``keys`` and the result have the two children of each in turn."""
        children = np.arange(len(self.feature), len(self.feature) + 2 * len(nodes))
        for field, values in zip(self.FIELDS, (feature, cut, children[::2], children[1::2], gain)):
            own = getattr(self, field)
            for node, value in zip(nodes.tolist(), values.tolist()):
                own[node] = value
        for field, value in zip(self.FIELDS, (-1, 0, -1, -1, 0.0)):
            getattr(self, field).extend([value] * len(children))
        self.stats.extend(x.copy() for x in sums.T.astype(float))
        self.key.extend(keys.tolist())
        self.depth.extend([depth] * len(children))
        return children

    def graft(self, node: int, branch: Tree) -> None:
        """Puts a finished branch, whose root is this node, in its place."""
        offset = len(self.feature) - 1
        moved = lambda i: node if i == 0 else i + offset
        for i in range(len(branch.feature)):
            left, right = (moved(x) if x >= 0 else -1 for x in (branch.left[i], branch.right[i]))
            if i == 0:
                self.feature[node], self.cut[node], self.gain[node], self.left[node], self.right[node] = branch.feature[0], branch.cut[0], branch.gain[0], left, right
            else:
                at = self.add(branch.stats[i], branch.key[i], branch.depth[i])
                self.feature[at], self.cut[at], self.gain[at], self.left[at], self.right[at] = branch.feature[i], branch.cut[i], branch.gain[i], left, right

    def pruned(self, gamma: float) -> Tree:
        """From the leaves up, splits of less than ``gamma`` above two leaves are undone."""
        for node in reversed(range(len(self.feature))):  # children come after their parents
            if self.feature[node] >= 0 and self.gain[node] < gamma and self.feature[self.left[node]] < 0 and self.feature[self.right[node]] < 0:
                self.feature[node] = -1
        return self

    def kept(self) -> np.ndarray:
        """The node that is left in the place of each after ``pruned``."""
        out = list(range(len(self.feature)))
        for node, (feature, left, right) in enumerate(zip(self.feature, self.left, self.right)):
            if left >= 0 and feature < 0:
                out[left] = out[right] = out[node]
        return np.array(out)


def place(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The leaf, or open node, of each row of codes or values; a value up to the cut goes left."""
    node = np.zeros(len(values), np.int64)
    moving = np.arange(len(values)) if len(feature) and feature[0] >= 0 else np.zeros(0, np.int64)
    flat, width = np.ascontiguousarray(values).reshape(-1), values.shape[1]
    while len(moving):
        at = node.take(moving)
        at = np.where(flat.take(moving * width + feature.take(at)) <= cut.take(at), left.take(at), right.take(at))
        node[moving] = at
        moving = moving[feature.take(at) >= 0]
    return node


def ordered(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, names in order) of a stable sort of whole numbers; sorting numbers is faster than sorting places by them."""
    bits = max(1, len(names) - 1).bit_length()
    keys = np.sort((names.astype(np.int64) << bits) | np.arange(len(names)))
    return keys & ((1 << bits) - 1), keys >> bits


def _sorted_splits(codes: np.ndarray, stats: np.ndarray, rows: np.ndarray, sizes: np.ndarray, sums: np.ndarray, chosen: np.ndarray, rule) -> tuple:
    """``best_split`` of many small nodes, whose ``rows`` follow each other: (gain, place among the columns, bin, left sums)."""
    count, width = chosen.shape
    node = np.repeat(np.arange(count), sizes)
    own = codes.reshape(-1).take(rows[:, None] * codes.shape[1] + chosen[node])
    order, name = ordered((((node[:, None] * width + np.arange(width)) << 8) + own).ravel())  # node, column, bin
    upto = stats.take(rows.take(order // width), axis=1).cumsum(axis=1)
    last = np.flatnonzero(np.append(name[1:] != name[:-1], True))  # of the rows with one bin
    name = name[last]
    group = name >> 8
    before = np.concatenate([np.zeros((3, 1), np.int64), upto], axis=1)[:, np.repeat(sizes, width).cumsum() - np.repeat(sizes, width)]
    left = upto[:, last] - before[:, group]
    owner = group // width
    whole = sums[:, owner]
    a, b = scaled(left), scaled(whole - left)
    gain = rule.score(a) + rule.score(b) - rule.score(scaled(sums))[owner]
    gain = np.where(rule.allowed(a, b) & (left[2] > 0) & (whole[2] > left[2]), gain, -np.inf)
    best = np.maximum.reduceat(gain, np.searchsorted(owner, np.arange(count)))
    at = np.flatnonzero(gain == best[owner])
    at = at[np.unique(owner[at], return_index=True)[1]]  # the first column and bin
    return best, group[at] % width, name[at] & 255, left[:, at]


def grown(codes: np.ndarray, stats: np.ndarray, rule, columns: Columns, number: int, key: int, depth: int, joint: Joint | None = None, leaf: np.ndarray | None = None) -> Tree:
    """The whole branch over some rows, in one task, level by level.

    ``joint`` are the rows' codes taken together, if known; ``leaf`` gets the node that each row ends in.
    """
    tree, stats, codes = Tree(), stats.astype(np.int64, copy=False), np.ascontiguousarray(codes)
    if joint is None and columns.a_node is None and len(codes) >= JOINT_ROWS:
        joint = Joint(codes)
    floats = stats[:2 if (stats[2] == 1).all() else 3].astype(float)
    by_column = np.ascontiguousarray(codes.T)

    def sums_of(own: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        if joint is not None and len(own) >= JOINT_ROWS:
            return joint.histogram(own, chosen, floats.take(own, axis=1))
        if columns.a_node is None:
            return histogram(by_column.take(own, axis=1).T, chosen, floats.take(own, axis=1))
        return histogram(np.stack([by_column[c].take(own) for c in chosen], axis=1), np.arange(len(chosen)), floats.take(own, axis=1))

    def ended(there: np.ndarray) -> None:
        if leaf is not None:
            at = np.repeat(there, sizes)
            leaf[rows[at]] = np.repeat(nodes[there], sizes[there])

    tree.add(stats.sum(axis=1), key, depth)
    nodes, rows, sizes = np.zeros(1, np.int64), np.arange(codes.shape[0]), np.array([codes.shape[0]])
    sums, keys = stats.sum(axis=1)[:, None], np.array([key], np.int64)
    above: dict[int, np.ndarray] = {}  # histograms of the level above, by their first child's node, where all nodes have the same columns
    while len(nodes):
        is_open = np.asarray(rule.is_open(scaled(sums), depth)) & (sizes > 0)
        ended(~is_open)
        rows = rows[np.repeat(is_open, sizes)]
        nodes, sizes, sums, keys = nodes[is_open], sizes[is_open], sums[:, is_open], keys[is_open]
        if not len(nodes):
            break
        chosen, starts = columns.of_each(number, keys), sizes.cumsum() - sizes
        known, here = {}, {}
        if above:  # the larger child's histogram is the parent's less that of the smaller one
            at_node = dict(zip(nodes.tolist(), range(len(nodes))))
            for first, whole in above.items():
                pair = [at_node[x] for x in (first, first + 1) if x in at_node]
                if len(pair) == 2 and sizes[pair].max() * chosen.shape[1] > SORTED:
                    less, more = sorted(pair, key=lambda i: sizes[i])
                    own = rows[starts[less]:starts[less] + sizes[less]]
                    known[less] = sums_of(own, chosen[less])
                    known[more] = whole - known[less]
        gain, at, cut, left = np.full(len(nodes), -np.inf), np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64), np.zeros((3, len(nodes)), np.int64)
        for i in np.flatnonzero(sizes * chosen.shape[1] > SORTED):
            if i not in known:
                own = rows[starts[i]:starts[i] + sizes[i]]
                known[i] = sums_of(own, chosen[i])
            gain[i], at[i], cut[i], left[:, i] = best_split(known[i], rule)
            if columns.a_node is None and len(here) < HELD_HISTOGRAMS:
                here[i] = known[i]
        few = np.flatnonzero(sizes * chosen.shape[1] <= SORTED)
        portion = (sizes[few].cumsum() * chosen.shape[1]) // ENTRIES
        for some in np.split(few, np.flatnonzero(np.diff(portion)) + 1) if len(few) else ():
            mask = np.zeros(len(nodes), bool)
            mask[some] = True
            gain[some], at[some], cut[some], left[:, some] = _sorted_splits(
                codes, stats, rows[np.repeat(mask, sizes)], sizes[some], sums[:, some], chosen[some], rule)
        split = gain > rule.least_gain
        ended(~split)
        rows = rows[np.repeat(split, sizes)]
        nodes, sizes, sums, keys, gain, cut, left = nodes[split], sizes[split], sums[:, split], keys[split], gain[split], cut[split], left[:, split]
        feature = chosen[split, at[split]]
        depth += 1
        owner = np.repeat(np.arange(len(nodes)), sizes)
        child = 2 * owner + (codes.reshape(-1).take(rows * codes.shape[1] + feature.take(owner)) > cut.take(owner))
        rows, sizes = rows.take(ordered(child)[0]), np.bincount(child, minlength=2 * len(nodes))
        sums = np.stack([left, sums - left], axis=2).reshape(3, -1)
        keys = child_keys(np.repeat(keys, 2), np.tile([0, 1], len(nodes)))
        number_of = np.cumsum(split) - 1
        nodes = tree.split_all(nodes, feature, cut, gain, sums, keys, depth)
        above = {int(nodes[2 * number_of[i]]): whole for i, whole in here.items() if split[i]}
    return tree


# ---- growth on tables ----------------------------------------------------------------

# What rows of (codes, other columns) add to a tree: (chosen rows, statistics as three rows of whole numbers).
Statistics = Callable[[np.ndarray, list[np.ndarray], int], tuple[np.ndarray, np.ndarray]]

LEVEL = "tree int, node int, sums binary"
SPLITS = "tree int, node int, gain double, feature int, cut int, left_stats array<double>, stats array<double>"
ROWS = "tree int, node int, codes binary, stats binary"  # of the rows that one batch has in a node
BRANCH = "tree int, node int, feature array<int>, cut array<int>, left array<int>, right array<int>, gain array<double>, key array<long>, depth array<int>, stats array<double>"
GROWN = "tree int, n int, places binary, gain binary, stats binary"  # a boosted tree of ``n`` nodes


BLOCK = "id binary, label binary, weight binary, codes binary, margin binary"
KINDS = (np.int64, float, float, np.uint8, float)  # of the numbers in a block


def packed_rows(rows: DataFrame) -> DataFrame:
    """Binned rows with margins in blocks of about ``SMALL``, a few for each core: many jobs read them."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= SMALL:
                yield block(held)
                held = []
        if sum(b.num_rows for b in held):
            yield block(held)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        values = [b"".join(table.column(i).to_pylist()) if i == 3 else table.column(i).to_numpy().astype(kind).tobytes() for i, kind in enumerate(KINDS)]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], table.schema.names)

    parts = 4 * rows.sparkSession.sparkContext.defaultParallelism  # placement only
    return settled(rows.mapInArrow(pack, BLOCK).repartition(parts), "blocks")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at least ``GATHERED_ROWS``, but for the last; blocks pass as they come."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if pa.types.is_binary(batch.schema.types[0]):
            yield batch
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= GATHERED_ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _portions(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(codes, the other columns) of a batch of rows, or of each block."""
    if not pa.types.is_binary(batch.schema.types[0]):
        yield _codes(batch.column(3), size), [np.asarray(batch.column(i)) for i in (0, 1, 2)]
        return
    for i in range(batch.num_rows):
        ids, label, weight, codes, margin = (np.frombuffer(batch.column(j)[i].as_buffer(), kind) for j, kind in enumerate(KINDS))
        yield codes.reshape(-1, size), [ids, label, weight, margin]


def _sent(trees: dict[int, Tree], nodes: dict[int, list[int]]) -> dict:
    """What tasks need of the growing trees: arrays and the nodes asked for."""
    return {t: (*(np.array(getattr(trees[t], f)) for f in Tree.FIELDS[:4]), {n: trees[t].key[n] for n in nodes[t]}) for t in nodes}


def grow(rows: DataFrame, statistics: Statistics, rule, columns: Columns, numbers: list[int], count: int) -> dict[int, Tree]:
    """The trees ``numbers`` over the binned rows; ``count`` of rows."""
    trees, branches = grown_apart(rows, statistics, rule, columns, numbers, count)
    for t, n, branch in _collected(branches, rule.depth) if branches is not None else ():
        trees[t].stats[n] = branch.stats[0]
        trees[t].graft(n, branch)
    return trees


def grown_apart(
    rows: DataFrame, statistics: Statistics, rule, columns: Columns, numbers: list[int], count: int, made: tuple | None = None,
) -> tuple[dict[int, Tree], DataFrame | None]:
    """The trees down to their small nodes, and the branches below those, which stay on the executors.

    ``made`` are a schema and what makes a row of it from (tree, node, branch), instead of ``BRANCH``.
    """
    context, trees = rows.sparkSession.sparkContext, {}
    large, small = {}, {}
    few = 0 if rule.depth <= SHALLOW and columns.a_node is None else SMALL
    for t in numbers:
        trees[t] = Tree()
        trees[t].add(np.zeros(3), 1, 0)
        (small if count <= SMALL else large)[t] = [0]
    while large:
        per_node = 3 * BINS * (columns.a_node or columns.a_tree)
        batch, left_over, room = {}, {}, max(1, CELLS // per_node)
        for t, nodes in large.items():
            batch[t], left_over[t] = nodes[:room], nodes[room:]
            room -= len(batch[t])
        batch, left_over = ({t: n for t, n in x.items() if n} for x in (batch, left_over))
        shared = context.broadcast(_sent(trees, batch))
        for r in _level(rows, statistics, rule, columns, shared).collect():  # a row for each node of a batch
            tree = trees[r.tree]
            tree.stats[r.node] = np.array(r.stats)
            if not rule.is_open(scaled(tree.stats[r.node]), tree.depth[r.node]) or r.gain <= rule.least_gain:
                continue
            for child in tree.split(r.node, r.feature, r.cut, r.gain, np.array(r.left_stats)):
                if rule.is_open(scaled(tree.stats[child]), tree.depth[child]):
                    (small if tree.stats[child][2] <= few else left_over).setdefault(r.tree, []).append(child)
        shared.destroy()
        large = left_over
    if not small:
        return trees, None
    shared = context.broadcast(_sent(trees, small))
    branches = _finished(rows, statistics, rule, columns, shared, {t: {n: trees[t].depth[n] for n in nodes} for t, nodes in small.items()}, made or (BRANCH, _branch))
    return trees, branches


def _branch(tree: int, node: int, branch: Tree) -> dict:
    return {"tree": tree, "node": node, **{f: np.array(getattr(branch, f)) for f in (*Tree.FIELDS, "key", "depth")}, "stats": np.concatenate(branch.stats)}


def _level(rows: DataFrame, statistics: Statistics, rule, columns: Columns, shared) -> DataFrame:
    """The best split of each node asked for: histograms by partition, summed by node."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in _gathered(batches):
            for codes, others in _portions(batch, columns.size):
                for t, (feature, cut, left, right, keys) in shared.value.items():
                    chosen, stats = statistics(codes, others, t)
                    own = codes[chosen]
                    number = np.full(len(feature), -1)
                    number[list(keys)] = np.arange(len(keys))
                    node = number[place(feature, cut, left, right, own)]
                    here = np.flatnonzero(node >= 0)
                    if columns.a_node is None:
                        parts = histograms(own[here], columns.of(t, 0), stats[:, here], node[here], len(keys))
                    else:
                        order = here[np.argsort(node[here], kind="stable")]
                        ends = np.bincount(node[here], minlength=len(keys)).cumsum()
                        parts = (histogram(own[rows], columns.of(t, key), stats[:, rows]) for key, rows in zip(keys.values(), np.split(order, ends[:-1])))
                    for n, part in zip(keys, parts):
                        part = part.astype(np.int64)
                        sums[t, n] = sums[t, n] + part if (t, n) in sums else part
        yield pa.RecordBatch.from_arrays([
            pa.array([t for t, _ in sums], pa.int32()), pa.array([n for _, n in sums], pa.int32()),
            pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["tree", "node", "sums"])

    def best(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        t, n = int(key[0]), int(key[1])
        total = sum(np.frombuffer(s, np.int64) for s in frame["sums"]).reshape(3, -1, BINS)
        gain, at, cut, left_stats = best_split(total.astype(float), rule)
        feature = columns.of(t, shared.value[t][4][n])[at]
        return pd.DataFrame({"tree": [t], "node": [n], "gain": [gain], "feature": [feature], "cut": [cut],
                             "left_stats": [left_stats], "stats": [total[:, 0].sum(axis=1).astype(float)]})

    return rows.mapInArrow(add, LEVEL).groupBy("tree", "node").applyInPandas(best, SPLITS)


def _finished(rows: DataFrame, statistics: Statistics, rule, columns: Columns, shared, depths: dict, made: tuple) -> DataFrame:
    """The branches below small nodes, each grown in one task over its rows, which a batch sends together."""
    def packed(held: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*held), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], ["tree", "node", "codes", "stats"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in _gathered(batches):
            for codes, others in _portions(batch, columns.size):
                for t, (feature, cut, left, right, keys) in shared.value.items():
                    chosen, stats = statistics(codes, others, t)
                    own = codes[chosen]
                    number = np.full(len(feature), -1)
                    number[list(keys)] = np.arange(len(keys))
                    node = number[place(feature, cut, left, right, own)]
                    here = np.flatnonzero(node >= 0)
                    size += len(here) * (columns.size + 24)
                    order = here[np.argsort(node[here], kind="stable")]
                    ends = np.bincount(node[here], minlength=len(keys)).cumsum()
                    for n, part in zip(keys, np.split(order, ends[:-1])):
                        if len(part):
                            held.append((t, n, own[part].tobytes(), stats[:, part].astype(np.int64).tobytes()))
                    if size >= DEALT_BYTES:
                        yield packed(held)
                        held, size = [], 0
        if held:
            yield packed(held)

    def finish(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        t, n = int(key[0]), int(key[1])
        codes = np.frombuffer(b"".join(frame["codes"]), np.uint8).reshape(-1, columns.size)
        stats = np.concatenate([np.frombuffer(s, np.int64).reshape(3, -1) for s in frame["stats"]], axis=1)
        tree = grown(codes, stats, rule, columns, t, shared.value[t][4][n], depths[t][n])
        return pd.DataFrame({f: [x] for f, x in made[1](t, n, tree).items()})

    groups = sum(len(nodes) for nodes in depths.values())
    parts = min(groups, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, much work: not to be coalesced
    return rows.mapInArrow(deal, ROWS).repartition(parts, "tree", "node").groupBy("tree", "node").applyInPandas(finish, made[0])


def _collected(branches: DataFrame, depth: int) -> list:
    """Finished branches by (tree, node); their size is checked first where only the rows bound it."""
    if depth > 16:
        branches = settled(branches, "branches")
        _checked(branches.agg(F.sum(F.size("feature"))).first()[0] or 0)
    out = []
    for r in sorted(branches.collect(), key=lambda r: (r.tree, r.node)):
        branch = Tree()
        for field in (*Tree.FIELDS, "key", "depth"):
            setattr(branch, field, list(r[field]))
        branch.stats = list(np.array(r.stats).reshape(-1, 3))
        out.append((r.tree, r.node, branch))
    return out


# ---- models --------------------------------------------------------------------------

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double, cover double"
FIELDS = ("feature", "threshold", "left", "right", "value", "gain", "cover")  # of nodes
SCORING = list(FIELDS[:5])
# The part of a tree down to its small nodes (root -1), or the branch in the place of one of those nodes (root); its nodes are numbered from 0.
PIECE = "tree int, root int, n int, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>, gain array<double>, cover array<double>"
# Rows of pieces are large: files are cut by their bytes, not after a number of rows, so that readers hold few.
PIECES_WRITTEN = {"parquet.block.size": 1 << 24, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
SENT = "tree int, root int, kind int, block long, place binary, data binary"  # branches (kind 0), vectors that meet them (1) and votes of the tops (2)
NODE = np.dtype([("feature", np.int16), ("cut", np.int16), ("left", np.int32), ("right", np.int32), ("votes", np.int64)])


class _NodesWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.saved_rows(self.sparkSession).write.parquet(f"{path}/data")


class _NodesReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        return model.with_saved_rows(self.sparkSession.read.parquet(f"{path}/data"))


def _numbers(values: pd.Series) -> np.ndarray:
    x = np.stack(values.to_numpy()) if len(values) else np.zeros((0, 1))
    return np.where(np.isnan(x), np.inf, x)


class _TreesModel(Model, HasFeaturesCol, MLWritable, MLReadable):
    """Adds ``probability`` and ``prediction``. ``nodes`` has a row for each node of each tree."""

    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", size=0):
        super().__init__()
        self._setDefault(featuresCol="features", size=0)
        self._set(**self._input_kwargs)
        self.nodes = pd.DataFrame()

    def with_nodes(self, nodes: pd.DataFrame):
        self.nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        return self

    def copy(self, extra=None):
        return super().copy(extra).with_nodes(self.nodes)

    def discard(self) -> None:
        """Nothing is written for a model that is held whole."""

    def node_rows(self, spark) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODES)

    def saved_rows(self, spark) -> DataFrame:
        return self.node_rows(spark)

    def with_saved_rows(self, rows: DataFrame):
        return self.with_nodes(rows.toPandas())

    def write(self):
        return _NodesWriter(self)

    @classmethod
    def read(cls):
        return _NodesReader(cls)

    def arrays(self) -> list[tuple]:
        return [tuple(t[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value")) for _, t in self.nodes.groupby("tree")]

    @property
    def getNumTrees(self) -> int:
        return self.nodes["tree"].nunique()

    def _gains(self) -> pd.DataFrame:
        return self.nodes[self.nodes["feature"] >= 0]

    def _transform(self, df: DataFrame) -> DataFrame:
        shared, combine = df.sparkSession.sparkContext.broadcast(self.arrays()), self.combined

        def score(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for values in frames:
                x = _numbers(values)
                yield pd.Series(combine([t[4][place(*t[:4], x)] for t in shared.value], len(x)))

        probability = F.pandas_udf(score, "double")
        return df.withColumn("probability", probability(vector_to_array(self.getFeaturesCol()))).withColumn(
            "prediction", (F.col("probability") > 0.5).cast("double"))


class ForestModel(_TreesModel):
    """The trees are a table of pieces of bounded size, however many nodes they have; ``nodes`` collects them, for a look at small ones.

    Up to ``HELD_NODES`` nodes are sent to all tasks. Beyond, all tasks get the tops of the trees alone: blocks of distinct vectors walk those
    and are dealt to the branches they come to, and the votes are added up by vector.
    """

    packed: DataFrame

    def with_packed(self, packed: DataFrame, cuts: list[np.ndarray] | None = None):
        self.packed, self.written, self.cuts = packed, [packed], cuts
        return self

    def discard(self) -> None:
        """Deletes the model's tables, for a model that has served; neither it nor what it scored can be used then."""
        discard(*self.written)

    @property
    def nodes(self) -> pd.DataFrame:
        return self.node_rows(self.packed.sparkSession).toPandas().sort_values(["tree", "node"], ignore_index=True)

    @nodes.setter
    def nodes(self, nodes: pd.DataFrame) -> None:
        pass

    def copy(self, extra=None):
        return Model.copy(self, extra).with_packed(self.packed, self.cuts)

    def sizes(self) -> dict[int, dict[int, int]]:
        """Nodes of each piece, by tree and root."""
        out: dict[int, dict[int, int]] = {}
        for r in self.packed.select("tree", "root", "n").collect():
            out.setdefault(r.tree, {})[r.root] = r.n
        return out

    def node_rows(self, spark) -> DataFrame:
        first = {}  # of the nodes below each branch's root, numbered as by ``Tree.graft``
        for tree, sizes in self.sizes().items():
            upto = sizes[-1]
            for root in sorted(r for r in sizes if r >= 0):
                first[tree, root], upto = upto, upto + sizes[root] - 1
        roots: dict[int, list[int]] = {}
        for tree, root in first:
            roots.setdefault(tree, []).append(root)
        shared = spark.sparkContext.broadcast((first, roots))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            first, roots = shared.value
            for frame in frames:
                for piece in frame.to_dict("records"):
                    t, root = piece["tree"], piece["root"]
                    out = pd.DataFrame({"tree": t, "node": np.arange(piece["n"]), **{f: piece[f] for f in FIELDS}})
                    if root < 0:
                        yield out[~out["node"].isin(roots.get(t, []))]
                        continue
                    out["node"] = np.append(root, first[t, root] + np.arange(piece["n"] - 1))
                    for side in ("left", "right"):
                        out[side] = np.where(out[side] >= 0, first[t, root] + out[side] - 1, -1)
                    yield out

        return self.packed.mapInPandas(run, NODES)

    def saved_rows(self, spark) -> DataFrame:
        return self.packed

    def with_saved_rows(self, rows: DataFrame):
        """Pieces, or one row a node as older models have them, of which each tree becomes a piece."""
        def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            frame, n = frame.sort_values("node"), len(frame)
            top = dict(zip(FIELDS, (-1, math.nan, -1, -1, 0.0, 0.0, 0.0)))
            return pd.DataFrame({"tree": int(key[0]), "root": [-1, 0], "n": [1, n], **{f: [np.array([top[f]]), frame[f].to_numpy()] for f in FIELDS}})

        pieces = rows if "root" in rows.columns else rows.groupBy("tree").applyInPandas(pack, PIECE)
        path = scratch_path(rows.sparkSession, "trees")
        pieces.write.options(**PIECES_WRITTEN).parquet(path)
        return self.with_packed(rows.sparkSession.read.schema(PIECE).parquet(path))

    @property
    def getNumTrees(self) -> int:
        return self.packed.filter("root < 0").count()

    def _transform(self, df: DataFrame) -> DataFrame:
        sizes = self.sizes()
        values = vector_to_array(self.getFeaturesCol())
        if df.isStreaming or sum(n for pieces in sizes.values() for n in pieces.values()) <= HELD_NODES:
            shared = df.sparkSession.sparkContext.broadcast([(*t[:4], np.rint(t[4] * VOTE).astype(np.int64)) for t in self.arrays()])

            def score(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
                for rows in frames:
                    x, out = _numbers(rows), np.zeros(len(rows), np.int64)
                    for *nodes, votes in shared.value:
                        out += votes[place(*nodes, x)]
                    yield pd.Series(out)

            out = df.withColumn("probability", F.pandas_udf(score, "long")(values))
        else:
            keys = ["_hash", "_values"]  # arrays are compared only where hashes are equal
            asked = df.withColumn("_values", values).withColumn("_hash", F.xxhash64("_values"))
            out = asked.join(self._voted(asked.select(*keys).distinct(), sizes), keys, "left").drop(*keys)
        return out.withColumn("probability", F.col("probability") / F.lit(VOTE * len(sizes))).withColumn(
            "prediction", (F.col("probability") > 0.5).cast("double"))

    def _thresholds(self) -> list[np.ndarray]:
        """The cuts that the trees use, where those of the training are not known."""
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for feature, threshold in zip(frame["feature"], frame["threshold"]):
                    inner = np.isfinite(threshold) & (feature >= 0)
                    yield pd.DataFrame({"feature": feature[inner], "threshold": threshold[inner]}).drop_duplicates()

        out: list[list] = [[] for _ in range(self.getOrDefault(self.size))]
        for r in self.packed.select("feature", "threshold").mapInPandas(run, "feature int, threshold double").distinct().collect():
            out[r.feature].append(r.threshold)
        return [np.array(sorted(x)) for x in out]

    def _voted(self, vectors: DataFrame, sizes: dict[int, dict[int, int]]) -> DataFrame:
        """(_hash, _values, probability: sum of votes) of distinct vectors."""
        context, width = vectors.sparkSession.sparkContext, self.getOrDefault(self.size)
        rows = settled(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")  # written: the numbers stay
        cuts = context.broadcast(self._thresholds() if self.cuts is None else self.cuts)
        limit = SCORED_ROWS

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _gathered(batches):
                for start in range(0, batch.num_rows, limit):
                    part = batch.slice(start, limit)
                    ids, x = part.column(0).to_numpy(), np.asarray(part.column(1).flatten()).reshape(part.num_rows, -1)
                    codes = coded(np.where(np.isnan(x), np.inf, x), cuts.value)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[:1]), pa.array([ids.tobytes()], pa.binary()), pa.array([codes.tobytes()], pa.binary())],
                                                     ["block", "ids", "codes"])

        blocks = settled(rows.select("row", "_values").mapInArrow(pack, "block long, ids binary, codes binary"), "vector-blocks")
        self.written += [rows, blocks]
        rows_of = {r.block: r.n // 8 for r in blocks.select("block", F.length("ids").alias("n")).collect()}
        tops = {r.tree: tuple(np.array(r[f]) for f in SCORING) for r in self.packed.filter("root < 0").select("tree", *SCORING).collect()}
        shared = context.broadcast((rows_of, {t: (np.array(sorted(r for r in sizes[t] if r >= 0), np.int64), _sent_nodes(*tops[t], cuts.value)) for t in tops}))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in batches:
                for i in range(batch.num_rows):
                    block, codes = batch.column(0)[i].as_py(), np.frombuffer(batch.column(1)[i].as_buffer(), np.uint8).reshape(-1, width)
                    direct = np.zeros(len(codes), np.int64)
                    for t, (roots, nodes) in shared.value[1].items():
                        node, number = _reached(nodes, codes), np.full(len(nodes), -1)
                        number[roots] = np.arange(len(roots))
                        branch = number[node]
                        direct += np.where(branch < 0, nodes["votes"][node], 0)
                        here = np.flatnonzero(branch >= 0)
                        order = here[np.argsort(branch[here], kind="stable")]
                        ends = np.bincount(branch[here], minlength=len(roots)).cumsum()
                        for root, part in zip(roots.tolist(), np.split(order, ends[:-1])):
                            if len(part):
                                held.append((t, root, 1, block, part.astype(np.int32).tobytes(), codes[part].tobytes()))
                        size += len(here) * (width + 4)
                        if size >= DEALT_BYTES:
                            yield _sent_rows(held)
                            held, size = [], 0
                    held.append((-1, block % (1 << 31), 2, block, b"", direct.tobytes()))
            if held:
                yield _sent_rows(held)

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    t, root, *fields = (batch.column(j)[i] for j in range(batch.num_columns))
                    nodes = _sent_nodes(*(f.values.to_numpy(zero_copy_only=False) for f in fields), cuts.value)
                    yield _sent_rows([(t.as_py(), root.as_py(), 0, 0, b"", nodes.tobytes())])

        def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            nodes = None
            for batch in batches:
                for i, (kind, block) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                    at, data = (batch.column(j)[i].as_buffer() for j in (4, 5))
                    if kind == 0:
                        nodes = np.frombuffer(bytes(data), NODE)
                        continue
                    if block not in sums:
                        if sum(x.nbytes for x in sums.values()) >= SCORED_BYTES:
                            yield from map(summed, sums.items())
                            sums = {}
                        sums[block] = np.zeros(shared.value[0][block], np.int64)
                    if kind == 1:
                        found = nodes["votes"][_reached(nodes, np.frombuffer(data, np.uint8).reshape(-1, width))]
                        sums[block][np.frombuffer(at, np.int32)] += found
                    else:
                        sums[block] += np.frombuffer(data, np.int64)
            yield from map(summed, sums.items())

        def summed(item: tuple[int, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([item[0]], pa.int64()), pa.array([False]), pa.array([item[1].tobytes()], pa.binary())], ["block", "ids", "data"])

        def total(frame: pd.DataFrame) -> pd.DataFrame:
            ids = np.frombuffer(frame.loc[frame["ids"], "data"].iloc[0], np.int64)
            votes = sum((np.frombuffer(x, np.int64) for x in frame.loc[~frame["ids"], "data"]), np.zeros(len(ids), np.int64))
            return pd.DataFrame({"row": ids, "probability": votes})

        pieces = sum(len(x) for x in sizes.values())
        sent = sum(rows_of.values()) * len(sizes) * (width + 4) + sum(n for x in sizes.values() for n in x.values()) * NODE.itemsize
        tasks = max(min(pieces, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))), sent // SCORED_BYTES)
        met = blocks.select("block", "codes").mapInArrow(deal, SENT).unionByName(
            self.packed.filter("root >= 0").select("tree", "root", *SCORING).mapInArrow(send, SENT))
        voted = met.repartition(int(tasks), "tree", "root").sortWithinPartitions("tree", "root", "kind").mapInArrow(vote, "block long, ids boolean, data binary")
        own = blocks.select("block", F.lit(True).alias("ids"), F.col("ids").alias("data"))
        sums = own.unionByName(voted).groupBy("block").applyInPandas(total, "row long, probability long")
        return rows.join(sums, "row").drop("row")

    @property
    def featureImportances(self) -> DenseVector:
        """Impurity decrease by feature, normalised in each tree, then over the trees."""
        size = self.getOrDefault(self.size)

        def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                own = [np.bincount(f[f >= 0], np.maximum(g[f >= 0], 0), size) for f, g in zip(frame["feature"], frame["gain"])]
                yield pd.DataFrame({"tree": frame["tree"], "root": frame["root"], "own": own})

        out = np.zeros(size)
        def joined(frame: pd.DataFrame) -> pd.DataFrame:
            own = np.sum(np.stack(frame.sort_values("root")["own"].to_numpy()), axis=0)
            return pd.DataFrame({"tree": frame["tree"].iloc[:1], "own": [own]})

        kind = "tree int, root int, own array<double>"
        pieces = self.packed.select("tree", "root", "feature", "gain").mapInPandas(sums, kind)
        for r in pieces.groupBy("tree").applyInPandas(joined, kind.replace(" root int,", "")).orderBy("tree").collect():
            own = np.array(r.own)
            out += own / own.sum() if own.sum() else 0
        return DenseVector(out / out.sum() if out.sum() else out)


class BoostedModel(_TreesModel):
    @staticmethod
    def combined(values: list[np.ndarray], count: int) -> np.ndarray:
        return 1 / (1 + np.exp(-sum(values, np.zeros(count))))

    @property
    def featureImportances(self) -> DenseVector:
        """Mean gain of a feature's splits, normalised."""
        out = np.zeros(self.getOrDefault(self.size))
        for f, t in self._gains().groupby("feature"):
            out[f] = t["gain"].mean()
        return DenseVector(out / out.sum() if out.sum() else out)


def _table(trees: dict[int, Tree], cuts: list[np.ndarray], rule, rate: float = 1.0) -> pd.DataFrame:
    parts = []
    for number, tree in trees.items():
        fields = _fields({f: np.array(getattr(tree, f)) for f in (*Tree.FIELDS, "stats")}, cuts, rule, rate)
        parts.append(pd.DataFrame({"tree": number, "node": np.arange(len(tree.feature)), **fields}))
    return pd.concat(parts, ignore_index=True)


def _fields(tree: dict, cuts: list[np.ndarray], rule, rate: float = 1.0) -> dict:
    """The columns of a tree's nodes."""
    feature, inner = tree["feature"], tree["feature"] >= 0
    limits = np.full((len(cuts), BINS), np.inf)
    for limit, c in zip(limits, cuts):
        limit[:len(c)] = c
    stats = scaled(np.asarray(tree["stats"]).reshape(-1, 3).T)
    return {"feature": feature, "threshold": np.where(inner, limits[feature, tree["cut"]], np.nan), "left": tree["left"], "right": tree["right"],
            "value": rate * rule.value(stats), "gain": np.where(inner, tree["gain"], 0.0), "cover": stats[1]}


def _piece(number: int, root: int, tree: Tree, cuts: list[np.ndarray], rule) -> dict:
    """A row of ``PIECE``."""
    fields = _fields({f: np.array(getattr(tree, f)) for f in (*Tree.FIELDS, "stats")}, cuts, rule)
    return {"tree": number, "root": root, "n": len(tree.feature), **fields}


def _sent_nodes(feature, threshold, left, right, value, cuts: list[np.ndarray]) -> np.ndarray:
    """A piece as tasks get it, with codes in place of thresholds and votes in place of values."""
    out = np.zeros(len(feature), NODE)
    for f in np.unique(feature[feature >= 0]):
        own = feature == f
        out["cut"][own] = np.searchsorted(cuts[f], threshold[own], "left")
    out["feature"], out["left"], out["right"], out["votes"] = feature, left, right, np.rint(value * VOTE).astype(np.int64)
    return out


def _reached(nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return place(*(np.ascontiguousarray(nodes[f]) for f in ("feature", "cut", "left", "right")), codes)


def _sent_rows(held: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*held), kinds)], ["tree", "root", "kind", "block", "place", "data"])


class _Trees(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed):
    maxDepth = Param(Params._dummy(), "maxDepth", "splits above a leaf at most", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "the rows' own id, which draws follow", TypeConverters.toString)

    def getMaxDepth(self) -> int:
        return self.getOrDefault(self.maxDepth)

    def binned(self, train: DataFrame) -> tuple[DataFrame, list[np.ndarray], int]:
        """(rows, cuts, number of rows) for ``fit_binned``; one table serves many fits."""
        weight = self.getWeightCol() if self.isDefined(self.weightCol) and self.getWeightCol() else None
        cuts = bin_edges(train, self.getFeaturesCol())
        rows = binned(train, self.getFeaturesCol(), self.getLabelCol(), weight, self.getOrDefault(self.idCol), cuts)
        return rows, cuts, rows.count()


class Forest(_Trees):
    """Random forest for a 0/1 label: Gini splits, bootstrap rows (Poisson counts), columns drawn for each node.

    ``bootstrap`` False and ``featureSubsetStrategy`` "all" with one tree make a plain decision tree.
    """

    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows that a leaf needs", TypeConverters.toInt)
    minRowsToSplit = Param(Params._dummy(), "minRowsToSplit", "rows that a node needs to be split", TypeConverters.toInt)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "columns drawn for a node: sqrt, log2 or all", TypeConverters.toString)
    bootstrap = Param(Params._dummy(), "bootstrap", "draw rows with repeats", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, idCol="customer_id", numTrees=100, maxDepth=1_000,
                 minInstancesPerNode=1, minRowsToSplit=2, featureSubsetStrategy="sqrt", bootstrap=True, seed=42):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", idCol="customer_id", numTrees=100, maxDepth=1_000, minInstancesPerNode=1,
                         minRowsToSplit=2, featureSubsetStrategy="sqrt", bootstrap=True, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def getNumTrees(self) -> int:
        return self.getOrDefault(self.numTrees)

    def getMinInstancesPerNode(self) -> int:
        return self.getOrDefault(self.minInstancesPerNode)

    def _fit(self, train: DataFrame) -> ForestModel:
        return self.fit_binned(*self.binned(train))

    def fit_binned(self, rows: DataFrame, cuts: list[np.ndarray], count: int):
        strategies = {"sqrt": max(1, int(math.sqrt(len(cuts)))), "log2": max(1, int(math.log2(len(cuts)))), "all": None}
        strategy = self.getOrDefault(self.featureSubsetStrategy)
        if strategy not in strategies:
            raise ValueError(f"unsupported featureSubsetStrategy: {strategy}")
        seed, bootstrap = self.getSeed(), self.getOrDefault(self.bootstrap)
        columns = Columns(len(cuts), seed, a_node=strategies[strategy])
        rule = Gini(self.getOrDefault(self.minRowsToSplit), self.getMinInstancesPerNode(), self.getMaxDepth())
        upto = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])  # Poisson with mean 1

        def statistics(codes: np.ndarray, others: list[np.ndarray], tree: int):
            ids, label, weight = others[:3]
            times = np.searchsorted(upto, draw(seed, tree, ids), "right") if bootstrap else np.ones(len(ids), np.int64)
            chosen = np.flatnonzero(times)
            whole = np.rint(weight[chosen] * UNIT).astype(np.int64) * times[chosen]
            return chosen, np.stack([whole * (label[chosen] > 0), whole, times[chosen]])

        spark, at_once = rows.sparkSession, max(1, DRAWN_ROWS // max(count, 1))
        shared, path = spark.sparkContext.broadcast(cuts), scratch_path(spark, "trees")
        made = PIECE, lambda tree, node, branch: _piece(tree, node, branch, shared.value, rule)
        for start in range(0, self.getNumTrees(), at_once):
            numbers = list(range(start, min(start + at_once, self.getNumTrees())))
            tops, below = grown_apart(rows, statistics, rule, columns, numbers, count, made)
            tops = (_piece(t, -1, tree, cuts, rule) for t, tree in tops.items())
            pieces = spark.createDataFrame([tuple(x.tolist() if isinstance(x, np.ndarray) else x for x in top.values()) for top in tops], PIECE)
            pieces = pieces if below is None else pieces.unionByName(below)
            pieces.write.mode("append").options(**PIECES_WRITTEN).parquet(path)
        return ForestModel(featuresCol=self.getFeaturesCol(), size=len(cuts)).with_packed(spark.read.schema(PIECE).parquet(path), cuts)


class SecondOrderBoosting(_Trees, HasMaxIter, HasStepSize):
    """Boosted trees for a 0/1 label by gradients and Hessians of the log loss, starting from probability one half.

    ``subsamplingRate`` rows and ``featureShare`` columns are drawn for each tree. ``gamma`` is the gain that a split
    must bring (splits above leaves are undone below it), ``minHessian`` the Hessian sum that each side needs.
    A level of a large tree is one job over packed rows; up to ``ALONE`` times ``SMALL`` rows, trees are grown several in turn by one task.
    """

    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows drawn for a tree", TypeConverters.toFloat)
    featureShare = Param(Params._dummy(), "featureShare", "share of columns drawn for a tree", TypeConverters.toFloat)
    minHessian = Param(Params._dummy(), "minHessian", "Hessian sum that a child needs", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "least gain of a split", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "L2 regularisation of leaf values", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, idCol="customer_id", maxIter=100, maxDepth=6, stepSize=0.3,
                 subsamplingRate=1.0, featureShare=1.0, minHessian=1.0, gamma=0.0, l2=1.0, seed=42):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", idCol="customer_id", maxIter=100, maxDepth=6, stepSize=0.3, subsamplingRate=1.0,
                         featureShare=1.0, minHessian=1.0, gamma=0.0, l2=1.0, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, train: DataFrame) -> BoostedModel:
        return self.fit_binned(*self.binned(train))

    def fit_binned(self, rows: DataFrame, cuts: list[np.ndarray], count: int):
        value = lambda name: self.getOrDefault(getattr(self, name))
        seed, share, rate = self.getSeed(), value("subsamplingRate"), self.getStepSize()
        columns = Columns(len(cuts), seed, a_tree=value("featureShare"))
        rule = Newton(value("l2"), value("gamma"), value("minHessian"), self.getMaxDepth())

        def gradients(ids, label, weight, margin, tree: int):
            chosen = np.flatnonzero(draw(seed, tree, ids) < share) if share < 1 else np.arange(len(ids))
            p = 1 / (1 + np.exp(-margin[chosen]))
            w = weight[chosen] * UNIT
            return chosen, np.stack([np.rint((p - (label[chosen] > 0)) * w).astype(np.int64), np.rint(
                np.maximum(p * (1 - p), 1e-16) * w).astype(np.int64), np.ones(len(chosen), np.int64)])

        rounds = _successive if count <= ALONE * SMALL and count * len(cuts) <= ALONE_CODES else _distributed
        trees = rounds(rows.withColumn("margin", F.lit(0.0)), gradients, rule, columns, self.getMaxIter(), rate, count)
        return BoostedModel(featuresCol=self.getFeaturesCol(), size=len(cuts)).with_nodes(_table(trees, cuts, rule, rate))


def _scoring(tree: Tree, rule, rate: float) -> tuple:
    """The arrays that add a tree to a margin."""
    return (*(np.array(getattr(tree, f)) for f in Tree.FIELDS[:4]), rate * rule.value(scaled(np.asarray(tree.stats).T)))


def _distributed(rows: DataFrame, gradients, rule, columns: Columns, count: int, rate: float, n_rows: int) -> dict[int, Tree]:
    """``count`` rounds, each grown by ``grow``; margins follow from the last trees and are written every few rounds."""
    trees: dict[int, Tree] = {}
    recent: list[tuple] = []
    blocks = packed_rows(rows)
    for number in range(count):
        shared = rows.sparkSession.sparkContext.broadcast(list(recent))

        def statistics(codes: np.ndarray, others: list[np.ndarray], tree: int, shared=shared):
            ids, label, weight, margin = others
            return gradients(ids, label, weight, _added(codes, margin, shared.value), tree)

        trees[number] = grow(blocks, statistics, rule, columns, [number], n_rows)[number].pruned(rule.gamma)
        recent.append(_scoring(trees[number], rule, rate))
        shared.destroy()
        if len(recent) == CUT and number + 1 < count:
            before, blocks, recent = blocks, settled(_advanced(blocks, recent, columns.size), "margins"), []
            discard(before)
    discard(blocks)
    return trees


def _successive(rows: DataFrame, gradients, rule, columns: Columns, count: int, rate: float, n_rows: int) -> dict[int, Tree]:
    """The same trees where one task holds all rows: it grows ``ROUNDS`` of them in turn."""
    trees: dict[int, Tree] = {}
    for start in range(0, count, ROUNDS):
        before, numbers = [_scoring(t, rule, rate) for t in trees.values()], range(start, min(start + ROUNDS, count))

        def run(batches: Iterator[pa.RecordBatch], before=before, numbers=numbers) -> Iterator[pa.RecordBatch]:
            batch = pa.Table.from_batches(batches).combine_chunks()
            codes, margin = _codes(batch.column(3), columns.size), _margins(batch, columns.size, before)
            ids, label, weight = (batch.column(i).to_numpy() for i in range(3))
            joint = Joint(codes) if len(codes) >= JOINT_ROWS else None
            for t in numbers:
                chosen, stats = gradients(ids, label, weight, margin, t)
                leaf, others = np.empty(len(codes), np.int64), np.ones(len(codes), bool)
                own = np.empty(len(chosen), np.int64)
                tree = grown(codes.take(chosen, axis=0), stats, rule, columns, t, 1, 0, joint and joint.take(chosen), own).pruned(rule.gamma)
                *nodes, values = _scoring(tree, rule, rate)
                leaf[chosen], others[chosen] = tree.kept()[own], False
                leaf[others] = place(*nodes, codes[others])
                margin = margin + values[leaf]
                nodes = np.stack([getattr(tree, f) for f in Tree.FIELDS[:4]]).astype(np.int32), np.array(tree.gain), np.concatenate(tree.stats)
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([len(tree.feature)], pa.int32()),
                                                  *(pa.array([x.tobytes()], pa.binary()) for x in nodes)], ["tree", "n", "places", "gain", "stats"])

        found = rows.coalesce(1).mapInArrow(run, GROWN)
        if rule.depth > 16:  # only the rows bound the size
            found = settled(found, "grown")
            _checked(found.agg(F.sum("n")).first()[0] or 0)
        for r in found.collect():
            tree = trees[r.tree] = Tree()
            tree.feature, tree.cut, tree.left, tree.right = np.frombuffer(r.places, np.int32).reshape(4, -1)
            tree.gain, tree.stats = np.frombuffer(r.gain), np.frombuffer(r.stats).reshape(-1, 3)
    return trees


def _checked(nodes: int) -> None:
    if nodes > MOST_NODES:
        raise ValueError(f"{nodes} nodes; raise the rows a leaf or a split needs, or bound the depth")


def _margins(table: pa.Table, size: int, trees: list[tuple]) -> np.ndarray:
    return _added(_codes(table.column(3), size), np.array(table.column(4)), trees)


def _added(codes: np.ndarray, margin: np.ndarray, trees: list[tuple]) -> np.ndarray:
    for *nodes, values in trees:
        margin = margin + values[place(*nodes, codes)]
    return margin


def _advanced(blocks: DataFrame, trees: list[tuple], size: int) -> DataFrame:
    """The blocks with the margins after the last trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [_added(codes, others[3], trees).tobytes() for codes, others in _portions(batch, size)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margins, pa.binary())], batch.schema.names)

    return blocks.mapInArrow(run, blocks.schema)
