"""A tree of pivots over the points of a table, for exact neighbour search.

Each node has a pivot, a point of the data. A node with too many points gets children,
whose pivots are the points of smallest hash in it; a point belongs to the child with the
nearest pivot. Levels are added until cells have about the wanted size, so the number of
pivots that a point is compared with grows with the depth and not with the number of
cells. The tree is sent to all tasks; its size is checked against ``TREE_BYTES``, and
cells that it has no room to split stay whole.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

FAN = 256  # children of a node at most
MAX_LEVELS = 8
TREE_BYTES = 256 << 20  # pivots of the whole tree
REACH_SLICE = 1 << 22  # pairs of row and leaf that are looked at together


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


class PivotTree:
    """Nodes as arrays; node 0 is the root, children of a node are neighbours in the arrays."""

    def __init__(self, centre: np.ndarray):
        self.centre = centre
        self.pivots = np.zeros((1, len(centre)))
        self.parent = np.full(1, -1)
        self.first = np.zeros(1, "int64")
        self.children = np.zeros(1, "int64")
        self.radius = self.bound = None
        self.slack = 0.0

    def __len__(self) -> int:
        return len(self.parent)

    def shifted(self, vectors: pd.Series) -> np.ndarray:
        """Vectors relative to the centre: far from the origin the product form loses digits."""
        return np.stack(vectors.to_numpy()) - self.centre

    def split(self, node: int, pivots: np.ndarray) -> None:
        self.first[node], self.children[node] = len(self), len(pivots)
        none = np.zeros(len(pivots), "int64")
        self.pivots = np.concatenate([self.pivots, pivots - self.centre])
        self.parent = np.concatenate([self.parent, none + node])
        self.first = np.concatenate([self.first, none])
        self.children = np.concatenate([self.children, none])

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), "int64")
        moving = np.flatnonzero(self.children[at])
        while len(moving):
            for node in np.unique(at[moving]):
                mine = moving[at[moving] == node]
                low = self.first[node]
                at[mine] = low + distances(rows[mine], self.pivots[low:low + self.children[node]]).argmin(1)
            moving = moving[self.children[at[moving]] > 0]
        return at

    def leaves_below(self, node: int) -> np.ndarray:
        out, level = [], np.array([node])
        while len(level):
            inner = self.children[level] > 0
            out.append(level[~inner])
            level = np.concatenate(
                [np.arange(self.first[n], self.first[n] + self.children[n]) for n in level[inner]] or [level[:0]]
            )
        return np.concatenate(out)

    def measure(self, queries: dict, base: dict, keep: int) -> None:
        """Radii of the queries of each node, and how far neighbours of a query in it can be at most.

        Both arguments map nodes to (rows, radius, smallest distances of rows to a leaf's pivot).
        """
        size = len(self)
        self.radius, self.bound = np.zeros(size), np.full(size, -np.inf)
        self.query_rows, self.base_rows, self.base_radius = np.zeros(size, "int64"), np.zeros(size, "int64"), np.zeros(size)
        smallest = np.full((size, keep), np.inf)
        for node, (rows, radius, _) in queries.items():
            self.query_rows[node], self.radius[node] = rows, radius
        for node, (rows, radius, near) in base.items():
            self.base_rows[node], self.base_radius[node] = rows, radius
            smallest[node, :len(near)] = near
        largest = np.sqrt((self.pivots**2).sum(1).max()) + max(self.radius.max(), self.base_radius.max())
        self.slack = 1e-6 * (1 + largest)
        below = {}
        for leaf in np.flatnonzero((self.children == 0) & (self.query_rows > 0)):
            # The rows of the nearest subtree that has enough of them are near enough to bound by.
            top = self.parent[leaf]
            while top > 0 and self.base_rows[top] < keep:
                top = self.parent[top]
            if top < 0:
                self.bound[leaf] = np.inf
                continue
            if top not in below:
                below[top] = self.leaves_below(top)
            others = below[top]
            reach = (distances(self.pivots[leaf:leaf + 1], self.pivots[others])[0][:, None] + smallest[others]).ravel()
            if np.isfinite(reach).sum() >= keep:
                self.bound[leaf] = self.radius[leaf] + np.partition(reach, keep - 1)[keep - 1]
            else:
                self.bound[leaf] = np.inf
        for node in range(size - 1, 0, -1):  # children come after their parents
            self.bound[self.parent[node]] = max(self.bound[self.parent[node]], self.bound[node])

    def reached(self, rows: np.ndarray, wider: np.ndarray | None = None):
        """Yields (row, leaf) pairs, in slices: leaves with a query that may have the row as a neighbour.

        ``wider`` are radii, for rows that stand for all points around them.
        """
        step = max(1, REACH_SLICE // len(self))
        wider = np.zeros(len(rows)) if wider is None else wider
        for low in range(0, len(rows), step):
            found_rows, found_leaves = [], []
            todo = [(0, np.arange(low, min(low + step, len(rows))))]
            while todo:
                node, mine = todo.pop()
                if not self.children[node]:
                    found_rows.append(mine)
                    found_leaves.append(np.full(len(mine), node))
                    continue
                under = slice(self.first[node], self.first[node] + self.children[node])
                least = distances(rows[mine], self.pivots[under]) - self.radius[under] - wider[mine][:, None]
                is_open = least <= self.bound[under] + self.slack
                leaf = self.children[under] == 0
                row, child = np.nonzero(is_open & leaf)
                found_rows.append(mine[row])
                found_leaves.append(under.start + child)
                for child in np.flatnonzero(is_open.any(0) & ~leaf):
                    todo.append((under.start + child, mine[is_open[:, child]]))
            yield np.concatenate(found_rows), np.concatenate(found_leaves)

    def reach(self) -> np.ndarray:
        """Base rows that may be sent to each leaf, counted by whole cells: an upper limit."""
        leaves = np.flatnonzero((self.children == 0) & (self.base_rows > 0))
        out = np.zeros(len(self))
        for row, leaf in self.reached(self.pivots[leaves], self.base_radius[leaves]):
            out += np.bincount(leaf, self.base_rows[leaves[row]], len(self))
        return out.astype("int64")

    def surround(self, base: dict) -> None:
        """Rows and radii of the base, by node: what ``regions`` and ``within`` need."""
        self.base_rows, self.base_radius = np.zeros(len(self), "int64"), np.zeros(len(self))
        for node, (rows, radius, _) in base.items():
            self.base_rows[node], self.base_radius[node] = rows, radius
        self.scale = (np.sqrt((self.pivots**2).sum(1).max()) + self.base_radius.max()) ** 2
        self.between = {node: np.sqrt(((own[:, None] - own[None, :]) ** 2).sum(2)) for node in np.flatnonzero(self.children)
                        for own in [self.pivots[self.first[node]:self.first[node] + self.children[node]]]}

    def regions(self, rows: int) -> np.ndarray:
        """The region of each leaf, of about ``rows`` base rows; leaves near each other share one. -1 for inner nodes."""
        leaves = np.flatnonzero(self.children == 0)
        order, todo = [], [leaves]
        while todo:
            part = todo.pop()
            if len(part) == 1 or self.base_rows[part].sum() <= rows:
                order.append(part)
                continue
            side = np.argsort(self.pivots[part, int(np.ptp(self.pivots[part], axis=0).argmax())], kind="stable")
            half = min(max(1, int(np.searchsorted(self.base_rows[part[side]].cumsum(), self.base_rows[part].sum() / 2))), len(part) - 1)
            todo += [part[side[half:]], part[side[:half]]]
        out = np.full(len(self), -1)
        for number, part in enumerate(order):
            out[part] = number
        return out

    def within(self, rows: np.ndarray, limits: np.ndarray):
        """Yields (row, leaf) pairs, in slices: leaves that may hold a base row within ``limits`` of the row.

        A base row is nearest to the pivot of its own child, so it lies behind the plane halfway to any sibling's pivot;
        it also lies within its node's radius.
        """
        step = max(1, REACH_SLICE // len(self))
        for low in range(0, len(rows), step):
            found_rows, found_leaves = [], []
            todo = [(0, np.arange(low, min(low + step, len(rows))))]
            while todo:
                node, mine = todo.pop()
                if not self.children[node]:
                    found_rows.append(mine)
                    found_leaves.append(np.full(len(mine), node))
                    continue
                under, is_open = self._open(node, rows[mine], limits[mine])
                leaf = self.children[under] == 0
                row, child = np.nonzero(is_open & leaf)
                found_rows.append(mine[row])
                found_leaves.append(under.start + child)
                for child in np.flatnonzero(is_open.any(0) & ~leaf):
                    todo.append((under.start + child, mine[is_open[:, child]]))
            yield np.concatenate(found_rows), np.concatenate(found_leaves)

    def _open(self, node: int, rows: np.ndarray, limits: np.ndarray) -> tuple[slice, np.ndarray]:
        """The children of a node, and which of them may hold a base row within its limit of each row."""
        under = slice(self.first[node], self.first[node] + self.children[node])
        far = distances(rows, self.pivots[under])
        nearest = far.argmin(1)
        loss = 1e-11 * (self.scale + (rows ** 2).sum(1))[:, None]  # of squares, in the product form
        ahead = far**2 - far[np.arange(len(rows)), nearest][:, None] ** 2 - loss
        between = self.between[node][nearest]
        least = np.divide(ahead, 2 * between, out=np.zeros_like(ahead), where=between > 0)
        least = np.maximum(least, np.sqrt(np.maximum(far**2 - loss, 0)) - self.base_radius[under] * (1 + 1e-9))
        return under, (least <= limits[:, None] * (1 + 1e-9)) & (self.base_rows[under] > 0)

    def regions_within(self, rows: np.ndarray, limits: np.ndarray, region: np.ndarray, own: np.ndarray):
        """Yields (row, region) pairs, in slices: the regions of the leaves of ``within``, each once for a row, but for its ``own``.

        Branches are left out for a row that has all their regions already: where bounds exclude little, few leaves are tried.
        """
        count = int(region.max()) + 1
        below: list[set] = [{int(r)} if r >= 0 else set() for r in region]
        for node in range(len(self) - 1, 0, -1):  # children come after their parents
            below[self.parent[node]] |= below[node]
        below = [np.array(sorted(x), np.int64) for x in below]
        step = max(1, REACH_SLICE // max(count, FAN))
        for low in range(0, len(rows), step):
            upto = min(low + step, len(rows))
            seen, here = np.zeros((upto - low, count), bool), np.arange(upto - low)
            seen[here, own[low:upto]] = True
            todo = [(0, here)]
            while todo:
                node, mine = todo.pop()
                mine = mine[~seen[mine[:, None], below[node]].all(1)]
                if not len(mine):
                    continue
                if not self.children[node]:
                    seen[mine, region[node]] = True
                    continue
                under, is_open = self._open(node, rows[low + mine], limits[low + mine])
                leaf = self.children[under] == 0
                row, child = np.nonzero(is_open & leaf)
                seen[mine[row], region[under.start + child]] = True
                for child in np.flatnonzero(is_open.any(0) & ~leaf):
                    todo.append((under.start + child, mine[is_open[:, child]]))
            seen[here, own[low:upto]] = False
            row, there = np.nonzero(seen)
            yield low + row, there


def placed(points: DataFrame, tree: PivotTree, columns: str = "point long, vector array<double>") -> DataFrame:
    """``leaf`` of every point, and its columns."""
    shared = points.sparkSession.sparkContext.broadcast(tree)

    def place(batches):
        for batch in filter(len, batches):
            leaf = shared.value.leaf_of(shared.value.shifted(batch["vector"]))
            yield batch.assign(leaf=leaf.astype("int32"))[["leaf", *batch.columns]]

    names = [c.split()[0] for c in columns.split(", ")]
    return points.select(*names).mapInPandas(place, f"leaf int, {columns}")


def statistics(rows: DataFrame, tree: PivotTree, keep: int) -> dict:
    """Node to (rows, largest distance to its pivot, the ``keep`` smallest ones for leaves) of placed rows.

    Batches are summed before the shuffle; one row per node reaches the driver.
    """
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def sums(batches):
        tree = shared.value
        for batch in filter(len, batches):
            vectors, node, depth = tree.shifted(batch["vector"]), batch["leaf"].to_numpy().astype("int64"), 0
            index = np.arange(len(node))
            while len(index):
                far = np.sqrt(((vectors[index] - tree.pivots[node]) ** 2).sum(1))
                grouped = pd.DataFrame({"node": node, "far": far}).sort_values("far").groupby("node")["far"]
                yield pd.DataFrame({
                    "node": grouped.size().index.astype("int32"), "n": grouped.size().to_numpy(),
                    "radius": grouped.max().to_numpy(),
                    "near": [g.to_numpy()[:keep] if depth == 0 else [] for _, g in grouped],
                })
                up = tree.parent[node] >= 0
                index, node, depth = index[up], tree.parent[node][up], depth + 1

    found = rows.mapInPandas(sums, "node int, n long, radius double, near array<double>").groupBy("node").agg(
        F.sum("n").alias("n"), F.max("radius").alias("radius"),
        F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, keep).alias("near"),
    )
    return {r.node: (r.n, r.radius, r.near) for r in found.collect()}


def grown(base: DataFrame, n_base: int, cell_rows: int, fan: int = FAN, tree_bytes: int = TREE_BYTES) -> PivotTree:
    """The tree over (point, vector) rows; it depends on the vectors alone, not on their partitions."""
    dims = len(base.first()["vector"]) if n_base else 0
    most = tree_bytes // (8 * (dims + 8))
    tree, sizes = PivotTree(np.zeros(dims)), {0: n_base}
    for level in range(MAX_LEVELS):
        wanted, room = {}, most - len(tree)
        for node, n in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
            children = min(fan, math.ceil(n / cell_rows))
            if n > (cell_rows if level == 0 else 2 * cell_rows) and children <= room:
                wanted[node] = children
                room -= children
        if not wanted:
            break
        by_hash = Window.partitionBy("leaf").orderBy(F.xxhash64("vector"), "vector")
        rows = placed(base, tree) if level else base.select(F.lit(0).alias("leaf"), "vector")
        drawn = rows.withColumn("_rank", F.row_number().over(by_hash)).filter(F.col("_rank") <= fan)
        counts = base.sparkSession.createDataFrame(list(wanted.items()), "leaf int, children int")
        drawn = drawn.join(counts, "leaf").filter(F.col("_rank") <= F.col("children")).select("leaf", "_rank", "vector")
        pivots = {}
        for row in sorted(drawn.collect(), key=lambda r: (r.leaf, r._rank)):
            pivots.setdefault(row.leaf, []).append(row.vector)
        if level == 0:
            tree.centre = np.mean(pivots[0], axis=0)
        for node, vectors in sorted(pivots.items()):
            tree.split(node, np.array(vectors))
        sizes = {r.leaf: r["count"] for r in placed(base, tree).groupBy("leaf").count().collect()}
    return tree
