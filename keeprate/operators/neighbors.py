"""Exact k-nearest-neighbour join, without a cross join.

Rows with equal vectors are merged to one point that keeps its ``k + 1`` smallest
ids, so a large group of copies costs one point. Points are assigned to the cells of
a tree of pivots (``pivots.py``); cells near each other make a region, the part that one task holds.
A query first meets the points of its own region, which tells how far its neighbours can be at most.
With that distance it is sent only to regions with a cell that bounds leave a chance to be nearer, tried from the
root of the tree down. Regions and the queries sent to them are cut into blocks of bounded size; a task tells its own
groups of rows apart by their boxes, so a row is not sent again for each cell. A ranked merge reduces what the blocks
find. No candidate is cut off, so the result equals the brute-force one, with ties broken by id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from keeprate.operators.pivots import grown, placed, statistics
from keeprate.session import settled

CELL_ROWS = 4_096  # rows a cell, as intended
REGION_ROWS = 16_384  # rows a region, as intended, and queries that meet it in one task
GROUP_ROWS = 128  # rows with a box of their own inside a task
SENT_ROWS = 65_536  # rows that a task hands on at a time
SLACK = 1e-9  # of squared lengths: what the product form may lose
PAIRS = 1 << 20  # measured at a time
PAIR_SLICE = 262_144
TASKS_A_CORE = 4  # at most, that pairs of blocks are dealt to: their work is uneven


def _merge_copies(points: DataFrame, keep: int, carry: str | None) -> DataFrame:
    """One row per distinct vector: (point, vector, ids[, carried]).

    The ranked filter is applied before the shuffle as well, so a vector shared by
    a large part of all rows sends only ``keep`` rows per input partition. Rows are sorted by
    the vector's hash first, so that arrays are compared only where hashes are equal.
    """
    first = Window.partitionBy("_hash", "vector").orderBy("id")
    member = F.struct(F.col("id"), (F.col(carry).cast("double") if carry else F.lit(0.0)).alias("carried"))
    return (
        points.withColumn("_hash", F.xxhash64("vector"))
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= keep)
        .groupBy("_hash", "vector")
        .agg(F.array_sort(F.collect_list(member)).alias("members"))
        .select(
            F.element_at("members", 1)["id"].alias("point"),
            "vector",
            F.transform("members", lambda m: m["id"]).alias("ids"),
            F.transform("members", lambda m: m["carried"]).alias("carried"),
        )
    )


def _hash(points: np.ndarray) -> np.ndarray:
    mixed = points.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


class _Groups:
    """Rows in groups of at most ``size`` by halving the widest side, with the box of each."""

    def __init__(self, vectors: np.ndarray, size: int):
        parts, todo = [], [np.arange(len(vectors))]
        while todo:
            rows = todo.pop()
            if len(rows) <= size:
                parts.append(rows)
                continue
            own = vectors[rows]
            side = int(np.ptp(own, axis=0).argmax()) if own.shape[1] else 0
            order, half = np.argpartition(own[:, side], len(rows) // 2) if own.shape[1] else np.arange(len(rows)), len(rows) // 2
            todo += [rows[order[half:]], rows[order[:half]]]
        self.order = np.concatenate(parts)
        self.ends = np.cumsum([len(p) for p in parts])
        self.starts = self.ends - [len(p) for p in parts]
        self.low = np.stack([vectors[p].min(0) for p in parts])
        self.high = np.stack([vectors[p].max(0) for p in parts])

    def gaps(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How far each box is from another at least."""
        return np.sqrt((np.maximum(np.maximum(self.low - high, low - self.high), 0) ** 2).sum(1))

    def rows(self, groups: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *(np.arange(self.starts[g], self.ends[g]) for g in groups)])


def _best(query: pd.DataFrame, base: pd.DataFrame, keep: int, group_rows: int = GROUP_ROWS) -> pd.DataFrame:
    """The ``keep`` nearest base rows of each query in one pair of blocks; of those within its ``limit``, where it has one."""
    columns = ["point", "distance", "neighbor_id", "carried"]
    if query.empty or base.empty:
        return pd.DataFrame({c: [] for c in columns}).astype(
            {"point": "int64", "distance": "float64", "neighbor_id": "int64", "carried": "float64"}
        )
    vectors = np.stack(base["vector"].to_numpy())
    groups = _Groups(vectors, group_rows)
    base, vectors = base.iloc[groups.order], vectors[groups.order]
    centre = vectors.mean(0)  # far from the origin the product form loses digits
    near = vectors - centre
    squares = (near**2).sum(1)
    sizes = base["ids"].map(len).to_numpy()
    ids = np.concatenate(base["ids"].to_numpy())
    carried = np.concatenate(base["carried"].to_numpy())
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    points = query["point"].to_numpy()
    query_vectors = np.stack(query["vector"].to_numpy())
    limits = query["limit"].to_numpy() if "limit" in query else np.full(len(query), np.inf)
    middle = (groups.low + groups.high) / 2
    out = []

    beside = np.concatenate([near, squares[:, None]], axis=1)

    def rough(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Squared distances less the query's own square, as one product."""
        doubled = np.concatenate([-2 * q, np.ones((len(q), 1))], axis=1)
        return doubled @ (beside if len(rows) == len(beside) else beside[rows]).T

    def add(asked: np.ndarray, rows: np.ndarray, most: np.ndarray) -> None:
        """Measures some queries and base rows; ``most`` bounds the squared distance."""
        q, exactly = query_vectors[asked] - centre, query_vectors[asked]
        q_squares = (q**2).sum(1)
        found = rough(q, rows)
        loss = SLACK * (q_squares + squares.max())
        edge = most - q_squares + loss
        pairs = np.flatnonzero(found <= edge[:, None])
        if len(pairs) > 4 * keep * len(asked) and len(rows) > keep:
            edge = np.minimum(edge, np.partition(found, keep - 1, axis=1)[:, keep - 1] + loss)
            pairs = np.flatnonzero(found <= edge[:, None])
        if not len(pairs):
            return
        row, col = np.divmod(pairs, len(rows))
        col = rows[col]
        exact = np.concatenate([
            np.sqrt(((exactly[row[i:i + PAIR_SLICE]] - vectors[col[i:i + PAIR_SLICE]]) ** 2).sum(1))
            for i in range(0, len(row), PAIR_SLICE)
        ])
        times = sizes[col]
        pair = np.repeat(np.arange(len(row)), times)
        inner = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
        slot = starts[col][pair] + inner
        who, distance, neighbor = row[pair], exact[pair], ids[slot]
        order = np.lexsort((neighbor, distance, who))
        who, slot = who[order], slot[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        chosen = rank < keep
        out.append(pd.DataFrame({
            "point": points[asked[who[chosen]]],
            "distance": distance[order][chosen],
            "neighbor_id": ids[slot[chosen]],
            "carried": carried[slot[chosen]],
        }))

    asking = _Groups(query_vectors, group_rows)
    for start, end, low, high in zip(asking.starts, asking.ends, asking.low, asking.high):
        asked = asking.order[start:end]
        most = limits[asked] ** 2
        if np.isinf(most).any() and len(base) > keep:  # the groups around give a first bound
            nearest = np.argsort(((middle - (low + high) / 2) ** 2).sum(1), kind="stable")
            some = groups.rows(nearest[:1 + int(np.searchsorted((groups.ends - groups.starts)[nearest].cumsum(), 2 * keep))])
            q = query_vectors[asked] - centre
            q_squares = (q**2).sum(1)
            if len(some) >= keep:
                most = np.minimum(most, np.partition(rough(q, some), keep - 1, axis=1)[:, keep - 1] + q_squares + 2 * SLACK * (q_squares + squares.max()))
        gap = groups.gaps(low, high)
        rows = groups.rows(np.flatnonzero(gap**2 <= most.max() + SLACK * (1 + gap**2))) if np.isfinite(most).all() else np.arange(len(base))
        step = max(1, PAIRS // max(1, len(rows)))
        for i in range(0, len(asked) if len(rows) else 0, step):
            add(asked[i:i + step], rows, most[i:i + step])
    return pd.concat(out, ignore_index=True) if out else _best(query.iloc[:0], base, keep)


def _measured_tree(queries: DataFrame, base: DataFrame, keep: int, cell_rows: int):
    """The tree with all its bounds, and the queries with their leaves.

    Where there are several, the queries' leaves are written: computed anew, a near tie could fall to another leaf,
    whose radius does not hold the query.
    """
    n_base = base.count()
    tree = grown(base, n_base, cell_rows)
    if len(tree) == 1:  # nothing to tell apart: no pass over the rows is needed
        tree.measure({0: (n_base if queries is base else queries.count(), 0.0, [])}, {0: (n_base, 0.0, [])}, keep)
        return tree, queries.select(F.lit(0).alias("leaf"), "point", "vector")
    asked = settled(placed(queries, tree), "placed")
    of_queries = statistics(asked, tree, keep)
    tree.measure(of_queries, of_queries if queries is base else statistics(placed(base, tree), tree, keep), keep)
    return tree, asked


def _sent(batch: pd.DataFrame, row: np.ndarray, region: np.ndarray, first: str, second: str, blocks: np.ndarray, others: np.ndarray):
    """Repeats each row once per block of the other side, in frames of bounded size."""
    times = others[region]
    ends = np.cumsum(times)
    mine = (_hash(batch["point"].to_numpy()[row]) % blocks[region].astype("uint64")).astype("int32")
    for low in range(0, int(ends[-1]) if len(ends) else 0, SENT_ROWS):
        slots = np.arange(low, min(low + SENT_ROWS, int(ends[-1])))
        at = np.searchsorted(ends, slots, "right")
        frame = batch.iloc[row[at]].reset_index(drop=True)
        frame.insert(0, "region", region[at].astype("int32"))
        frame[first] = mine[at]
        frame[second] = (slots - (ends - times)[at]).astype("int32")
        yield frame


BLOCKS = "query_block int, base_block int"
QUERY = "point long, vector array<double>, limit double"
POINT = "point long, vector array<double>, ids array<long>, carried array<double>"
FOUND = "point long, distance double, neighbor_id long, carried double"


def _measured(queries: DataFrame, base: DataFrame, keep: int, group_rows: int, pairs: int) -> DataFrame:
    """The best of each of the ``pairs`` of blocks, per query point."""
    keys = ["region", "query_block", "base_block"]
    tasks = min(pairs, TASKS_A_CORE * queries.sparkSession.sparkContext.defaultParallelism)  # much work for few bytes: not to be coalesced
    tasks = max(tasks, min(pairs, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    queries, base = (df.repartition(tasks, *keys) for df in (queries, base))
    return queries.groupBy(*keys).cogroup(base.groupBy(*keys)).applyInPandas(lambda q, b: _best(q, b, keep, group_rows), FOUND)


def _candidates(queries: DataFrame, base: DataFrame, keep: int, cell_rows: int, block_rows: int) -> DataFrame:
    """(point, distance, neighbor_id, carried): neighbours of each query point, the ``keep`` nearest among them."""
    context, group_rows = queries.sparkSession.sparkContext, min(block_rows, GROUP_ROWS)
    n_base, own = base.count(), queries is base
    tree = grown(base, n_base, cell_rows)
    if len(tree) == 1:  # nothing to tell apart: no pass over the rows is needed
        n_queries = n_base if own else queries.count()
        kept, asked = base.withColumn("leaf", F.lit(0)), queries.withColumn("leaf", F.lit(0))
        tree.surround({0: (n_base, np.inf, [])})
        of_queries = {0: n_queries}
    else:
        # Written: computed anew, a near tie could fall to another leaf, whose radius does not hold the point.
        kept = settled(placed(base, tree, POINT), "placed")
        tree.surround(statistics(kept, tree, 1))
        asked = kept if own else settled(placed(queries, tree, POINT), "placed-queries")
        of_queries = {leaf: int(tree.base_rows[leaf]) for leaf in range(len(tree)) if not tree.children[leaf]} if own else {
            r.leaf: r["count"] for r in asked.groupBy("leaf").count().collect()}
    region = tree.regions(REGION_ROWS)
    n_regions = int(region.max()) + 1
    base_blocks = np.maximum(1, -(-np.bincount(region[region >= 0], tree.base_rows[region >= 0], n_regions).astype("int64") // (2 * REGION_ROWS)))
    n_of = np.zeros(n_regions, "int64")
    for leaf, n in of_queries.items():
        n_of[region[leaf]] += n
    # Query blocks are also small enough to occupy all cores.
    query_rows = max(256, min(REGION_ROWS, math.ceil(n_of.sum() / context.defaultParallelism)))  # placement only
    shared = context.broadcast((tree, region, base_blocks))

    def met(asked: DataFrame, n_of: np.ndarray, ways) -> DataFrame:
        query_blocks = np.maximum(1, -(-n_of // query_rows))

        def send_queries(batches):
            for batch in filter(len, batches):
                for row, there in ways(batch, shared.value):
                    yield from _sent(batch[["point", "vector", "limit"]], row, there, "query_block", "base_block", query_blocks, shared.value[2])

        def send_base(batches):
            for batch in filter(len, batches):
                there = shared.value[1][batch.pop("leaf").to_numpy()]
                asked_for = np.flatnonzero(n_of[there])
                yield from _sent(batch, asked_for, there[asked_for], "base_block", "query_block", shared.value[2], query_blocks)

        return _measured(
            asked.mapInPandas(send_queries, f"region int, {QUERY}, {BLOCKS}"),
            kept.select("leaf", "point", "vector", "ids", "carried").mapInPandas(send_base, f"region int, {POINT}, {BLOCKS}"), keep, group_rows,
            max(1, int((query_blocks * base_blocks)[n_of > 0].sum())))

    def home(batch, plan):
        yield np.arange(len(batch)), plan[1][batch["leaf"].to_numpy()]

    first = met(asked.select("leaf", "point", "vector", F.lit(float("inf")).alias("limit")), n_of, home)
    if n_regions == 1:
        return first
    first = settled(first, "own-region")
    limits = first.groupBy("point").agg(F.when(F.count(F.lit(1)) >= keep, F.max("distance")).alias("limit"))
    asked = asked.select("leaf", "point", "vector").join(limits, "point", "left").select(
        "leaf", "point", "vector", F.coalesce("limit", F.lit(float("inf"))).alias("limit"))

    def others(batches):
        """Queries with the other regions that may hold a nearer point, each once for a query."""
        tree, region, _ = shared.value
        for batch in filter(len, batches):
            own = region[batch["leaf"].to_numpy()]
            pairs = tree.regions_within(tree.shifted(batch["vector"]), batch["limit"].to_numpy(), region, own)
            row, there = (np.concatenate(x) for x in zip(*pairs))
            lists = np.split(there.astype("int32"), np.bincount(row, minlength=len(batch)).cumsum()[:-1])
            yield batch[["point", "vector", "limit"]].assign(regions=lists)

    # Written: the bounds are tried once, and not again to count the queries of each region.
    asked = settled(asked.mapInPandas(others, f"{QUERY}, regions array<int>").filter(F.size("regions") > 0), "asked-away")

    def away(batch, plan):
        yield np.repeat(np.arange(len(batch)), batch["regions"].map(len)), np.concatenate(batch["regions"].to_numpy()).astype(np.int64)

    n_away = np.zeros(n_regions, "int64")
    for r in asked.select(F.explode("regions").alias("region")).groupBy("region").count().collect():
        n_away[r.region] = r["count"]
    return first.unionByName(met(asked, n_away, away)) if n_away.any() else first


def pair_share(base: DataFrame, k: int, cell_rows: int = CELL_ROWS) -> float:
    """The share of all pairs of distinct vectors that the bounds leave to compare, at most.

    One tree is built to tell; a share near 1 means that the data has no structure to use.
    """
    merged = settled(_merge_copies(base, k + 1, None), "points")
    tree, _ = _measured_tree(merged, merged, k + 1, cell_rows)
    return float(tree.query_rows @ np.where(tree.children, 0, tree.reach())) / max(1, int(tree.query_rows[0])) ** 2


def neighbor_lists(
    base: DataFrame,
    k: int,
    queries: DataFrame | None = None,
    carry: str | None = None,
    cell_rows: int = CELL_ROWS,
    block_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Query rows with ``neighbors``: the k nearest base rows by Euclidean distance.

    ``base`` and ``queries`` have ``id long`` and ``vector array<double>`` without
    nulls; both are read more than once, so pass kept tables. Without ``queries`` every base row is a query and is not its own
    neighbour. ``carry`` names a numeric base column brought along. A neighbour is
    struct(distance, neighbor_id, carried), in that order of sorting. ``block_rows`` are told apart
    by a box inside a task, ``GROUP_ROWS`` at most.
    """
    own = queries is None
    keep = k + 1 if own else k
    merged = settled(_merge_copies(base, keep, carry), "points")
    asked = merged if own else settled(_merge_copies(queries, 1, None), "queries")
    best = Window.partitionBy("point").orderBy("distance", "neighbor_id")
    lists = (
        _candidates(asked, merged, keep, cell_rows, block_rows)
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") <= keep)
        .groupBy("point")
        .agg(F.array_sort(F.collect_list(F.struct("distance", "neighbor_id", "carried"))).alias("neighbors"))
        .join(asked.select("point", "vector"), "point")
        .drop("point")
    )
    found = F.col("neighbors")
    if own:
        found = F.filter(found, lambda n: n["neighbor_id"] != F.col("id"))
    rows = base if own else queries
    hashed = [df.withColumn("_hash", F.xxhash64("vector")) for df in (rows, lists)]
    return hashed[0].join(hashed[1], ["_hash", "vector"]).select(*rows.columns, F.slice(found, 1, k).alias("neighbors"))


def nearest_neighbors(base: DataFrame, k: int, queries: DataFrame | None = None, **options) -> DataFrame:
    """(id, rank, neighbor_id, distance), one row per neighbour."""
    return neighbor_lists(base, k, queries, **options).select("id", F.posexplode("neighbors")).select(
        "id", (F.col("pos") + 1).alias("rank"), "col.neighbor_id", "col.distance"
    )


def knn_vote(base: DataFrame, k: int = 5, queries: DataFrame | None = None, label: str = "label", **options) -> DataFrame:
    """Query rows with ``prediction`` (majority label, the smaller one on ties) and ``votes``."""
    lists = neighbor_lists(base, k, queries, carry=label, **options)
    said = F.transform("neighbors", lambda n: n["carried"].cast("int"))
    tally = F.transform(
        F.array_distinct(said),
        lambda c: F.struct(F.size(F.filter(said, lambda x: x == c)).alias("votes"), (-c).alias("minus")),
    )
    return lists.withColumn("_best", F.array_max(tally)).select(
        *[c for c in lists.columns if c != "neighbors"],
        (-F.col("_best.minus")).alias("prediction"),
        F.col("_best.votes").alias("votes"),
    )


def knn_probability(base: DataFrame, queries: DataFrame, k: int = 5, label: str = "label", **options) -> DataFrame:
    """Query rows with ``probability``: the share of neighbours of class 1, for a 0/1 label."""
    lists = neighbor_lists(base, k, queries, carry=label, **options)
    total = F.aggregate("neighbors", F.lit(0.0), lambda so_far, n: so_far + n["carried"])
    return lists.withColumn("probability", F.try_divide(total, F.size("neighbors"))).drop("neighbors")
