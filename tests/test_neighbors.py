from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from keeprate.operators import neighbors
from keeprate.operators.neighbors import knn_probability, knn_vote, nearest_neighbors, pair_share
from keeprate.operators.pivots import grown, placed, statistics
from keeprate.operators.resample import edited, rebalance, rows_to_add, synthesize


def points(spark, vectors, labels=None, first=0):
    labels = [0] * len(vectors) if labels is None else labels
    return spark.createDataFrame(
        [(first + i, [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(vectors, labels))],
        "id long, vector array<double>, label int",
    )


def brute(base, k, queries=None, first=0):
    out = {}
    for i, q in enumerate(base if queries is None else queries):
        distance = np.sqrt(((base - q) ** 2).sum(1))
        order = [j for j in np.lexsort((np.arange(len(base)), distance)) if queries is not None or j != i]
        out[i + (0 if queries is None else first)] = [(int(j), round(float(distance[j]), 9)) for j in order[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["id"], r["rank"])):
        out.setdefault(r["id"], []).append((r.neighbor_id, round(r.distance, 9)))
    return out


@pytest.mark.parametrize("options", [{}, dict(cell_rows=30), dict(cell_rows=30, block_rows=11)])
def test_equals_brute_force(spark, options):
    rng = np.random.default_rng(0)
    vectors = np.concatenate([rng.normal(size=(150, 5)), rng.normal(size=(150, 5)) + 8])
    assert found(nearest_neighbors(points(spark, vectors), 4, **options)) == brute(vectors, 4)


def test_equals_brute_force_over_many_regions(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "REGION_ROWS", 40)
    rng = np.random.default_rng(11)
    vectors = np.concatenate([rng.normal(size=(300, 3)), rng.integers(0, 3, size=(100, 3)), rng.normal(size=(100, 3)) * 50])
    assert found(nearest_neighbors(points(spark, vectors), 4, cell_rows=10, block_rows=7)) == brute(vectors, 4)
    asked = rng.normal(size=(80, 3)) * 10
    got = nearest_neighbors(points(spark, vectors), 4, points(spark, asked, first=1000), cell_rows=10, block_rows=7)
    assert found(got) == brute(vectors, 4, asked, 1000)


def test_vectors_are_sorted_by_their_hash(spark, monkeypatch):
    """Sorting and joining by arrays alone compares them value by value for every pair of rows."""
    df = points(spark, [[0.0, 1.0], [-0.0, 1.0], [0.0, 1.0], [2.0, 3.0], [float("nan"), 0.0], [float("nan"), -0.0]])
    merged = neighbors._merge_copies(df, 4, None)
    assert sorted(sorted(r.ids) for r in merged.collect()) == [[0, 1, 2], [3], [4, 5]]
    assert found(nearest_neighbors(df.filter("id < 4"), 2)) == {0: [(1, 0.0), (2, 0.0)], 1: [(0, 0.0), (2, 0.0)], 2: [(0, 0.0), (1, 0.0)], 3: [(0, 2.828427125), (1, 2.828427125)]}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (merged, neighbors.neighbor_lists(df, 2))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for plan in plans:
        by_vector = [line for line in plan.splitlines() if " Sort [" in line and "vector#" in line.split("Sort [", 1)[1]]
        assert by_vector and all(line.split("Sort [", 1)[1].startswith("_hash#") for line in by_vector)


def test_pairs_of_blocks_go_to_more_tasks_than_cores(spark, monkeypatch):
    """Their work is uneven: with a task a core, or a few, all wait for the slowest."""
    monkeypatch.setattr(neighbors, "REGION_ROWS", 40)
    dealt, run = [], neighbors._measured

    def watched(*args):
        dealt.append(run(*args))
        return dealt[-1]

    monkeypatch.setattr(neighbors, "_measured", watched)
    vectors = np.random.default_rng(11).normal(size=(2_000, 3))
    assert found(nearest_neighbors(points(spark, vectors), 2, cell_rows=10)) == brute(vectors, 2)
    assert all(r.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism for r in dealt) and dealt


def test_a_pair_of_blocks_needs_little_memory():
    vectors = np.random.default_rng(2).normal(size=(4_096, 4))
    frame = pd.DataFrame({"point": np.arange(4_096), "vector": list(vectors), "ids": [np.array([i]) for i in range(4_096)], "carried": [np.zeros(1)] * 4_096})
    tracemalloc.start()
    best = neighbors._best(frame[["point", "vector"]], frame, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(best) == 3 * 4_096 and peak < 64 << 20


def clustered(rows, clusters, dims=3, seed=7, centre=0.0):
    rng = np.random.default_rng(seed)
    return centre + rng.uniform(-100, 100, size=(clusters, dims)).repeat(rows // clusters, 0) + rng.normal(size=(rows, dims))


def test_tree_of_many_levels(spark, monkeypatch):
    monkeypatch.setattr("keeprate.operators.pivots.grown.__defaults__", (3, 256 << 20))
    vectors = clustered(600, 20)
    df = points(spark, vectors).withColumnRenamed("id", "point")
    tree = grown(df, 600, 20)
    levels, node = 0, len(tree) - 1
    while node > 0:
        levels, node = levels + 1, tree.parent[node]
    assert levels >= 3 and tree.children.max() == 3
    sizes = [r["count"] for r in placed(df, tree).groupBy("leaf").count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 40
    assert found(nearest_neighbors(points(spark, vectors), 4, cell_rows=20)) == brute(vectors, 4)
    asked = clustered(60, 20, seed=8) * 1.5
    got = nearest_neighbors(points(spark, vectors), 4, points(spark, asked, first=1000), cell_rows=20)
    assert found(got) == brute(vectors, 4, asked, 1000)


def test_tree_without_room_keeps_larger_cells(spark, monkeypatch):
    monkeypatch.setattr("keeprate.operators.pivots.grown.__defaults__", (4, 8 * (3 + 8) * 9))
    vectors = clustered(400, 10)
    assert len(grown(points(spark, vectors).withColumnRenamed("id", "point"), 400, 5)) <= 9
    assert found(nearest_neighbors(points(spark, vectors), 3, cell_rows=5, block_rows=50)) == brute(vectors, 3)


def test_far_from_the_origin(spark):
    vectors = clustered(300, 10, centre=1e7)
    got, want = found(nearest_neighbors(points(spark, vectors), 3, cell_rows=20)), brute(vectors, 3)
    assert {i: [j for j, _ in near] for i, near in got.items()} == {i: [j for j, _ in near] for i, near in want.items()}


def test_queries_are_sent_to_few_cells(spark):
    """By the distance they know, over points without clusters; no cell with a neighbour is left out."""
    vectors = np.random.default_rng(9).uniform(size=(3_000, 3))
    df = points(spark, vectors).withColumnRenamed("id", "point")
    tree = grown(df, 3_000, 30)
    tree.surround(statistics(placed(df, tree), tree, 1))
    rows = vectors - tree.centre
    leaf = tree.leaf_of(rows)
    squares = (vectors**2).sum(1)
    near = np.argsort(squares[:, None] + squares[None, :] - 2 * vectors @ vectors.T, axis=1)[:, :5]
    limits = np.sqrt(((vectors[near[:, 4]] - vectors) ** 2).sum(1))
    sent = {(int(r), int(n)) for some in tree.within(rows, limits) for r, n in zip(*some)}
    assert sent >= {(i, int(leaf[j])) for i in range(3_000) for j in near[i]}
    assert len(sent) < 12 * 3_000


def test_small_cells_share_a_region(spark):
    """A row goes to a region once, however small its cells are."""
    vectors = np.random.default_rng(10).normal(size=(2_000, 16))
    df = points(spark, vectors).withColumnRenamed("id", "point")
    tree = grown(df, 2_000, 10)
    tree.surround(statistics(placed(df, tree), tree, 1))
    leaf = tree.leaf_of(vectors - tree.centre)
    region = tree.regions(500)
    sizes = np.bincount(region[leaf])
    assert (tree.children == 0).sum() > 100 and len(sizes) <= 8 and sizes.max() <= 500 and sizes.sum() == 2_000


@pytest.mark.parametrize("dims, share", [(16, 0.5), (2, 1.01)])
def test_regions_are_found_without_trying_all_cells(spark, dims, share):
    """The same regions as by all cells; where bounds exclude little, a row tries few of the cells of a region that it goes to anyway."""
    vectors = np.random.default_rng(12).normal(size=(3_000, dims))
    df = points(spark, vectors).withColumnRenamed("id", "point")
    tree = grown(df, 3_000, 10)
    deep = [n for n in range(1, len(tree)) if not tree.children[n]][:40]
    for node in deep:  # a level more
        own = vectors[tree.leaf_of(vectors - tree.centre) == node]
        if len(own) > 4:
            tree.split(node, own[:4])
    tree.surround(statistics(placed(df, tree), tree, 1))
    rows, region = vectors - tree.centre, tree.regions(500)
    own = region[tree.leaf_of(rows)]
    limits = np.full(3_000, 0.25 * np.sqrt(dims) * (2 if dims > 2 else 1))
    tried, opened = [], tree._open
    tree._open = lambda node, some, *args: tried.append(len(some) * tree.children[node]) or opened(node, some, *args)
    wanted = {(int(r), int(region[n])) for some in tree.within(rows, limits) for r, n in zip(*some) if region[n] != own[r]}
    before, _ = sum(tried), tried.clear()
    got = [(int(r), int(n)) for some in tree.regions_within(rows, limits, region, own) for r, n in zip(*some)]
    assert len(got) == len(set(got)) and set(got) == wanted and len(got) > 3_000 * (dims > 2)
    assert sum(tried) < share * before


def test_share_of_pairs_falls_with_size(spark):
    shares = [pair_share(points(spark, clustered(n, n // 50)), 3, cell_rows=50) for n in (500, 2000, 8000)]
    assert shares[0] > 1.5 * shares[1] > 2 * shares[2]


def test_no_rows(spark):
    empty = points(spark, [])
    assert nearest_neighbors(empty, 3).count() == 0
    some = points(spark, [[1.0], [2.0]])
    assert nearest_neighbors(some, 3, empty).count() == 0 and nearest_neighbors(empty, 3, some).count() == 0
    assert found(nearest_neighbors(points(spark, [[1.0], [2.0], [5.0]]), 9)) == brute(np.array([[1.0], [2.0], [5.0]]), 9)


@pytest.mark.parametrize("options", [{}, dict(cell_rows=4, block_rows=3)])
def test_copies_and_ties(spark, options):
    rng = np.random.default_rng(1)
    vectors = rng.integers(0, 5, size=(300, 2)).astype(float)
    vectors[:100] = 2.0  # a third of all rows are one point
    assert found(nearest_neighbors(points(spark, vectors), 3, **options)) == brute(vectors, 3)


def test_other_queries(spark):
    rng = np.random.default_rng(2)
    base, asked = rng.normal(size=(200, 3)), rng.normal(size=(50, 3))
    got = nearest_neighbors(points(spark, base), 5, points(spark, asked, first=1000), cell_rows=40)
    assert found(got) == brute(base, 5, asked, 1000)


def test_votes(spark):
    base = points(spark, [[0.0], [1.0], [2.0], [10.0], [11.0]], [0, 0, 1, 1, 1])
    asked = points(spark, [[0.5], [10.5]], [0, 0], first=100)
    votes = {r.id: (r.prediction, r.votes) for r in knn_vote(base, 3, asked).collect()}
    assert votes == {100: (0, 2), 101: (1, 3)}
    shares = {r.id: r.probability for r in knn_probability(base, asked, 3).collect()}
    assert shares == {100: pytest.approx(1 / 3), 101: pytest.approx(1.0)}


def test_rows_to_add():
    assert rows_to_add(1018, 182, 30 / 70) == 254
    with pytest.raises(ValueError):
        rows_to_add(888, 612, 30 / 70)


def test_synthetic_rows_lie_between_minority_neighbours(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(220, 3))
    labels = [1] * 20 + [0] * 200
    df = points(spark, vectors, labels)
    rows = synthesize(df, k=5).collect()
    assert len(rows) == int(200 * 30 / 70 - 20)
    assert len({r.id for r in rows}) == len(rows) and min(r.id for r in rows) > 219
    near = brute(vectors[:20], 5)
    for r in rows:
        x = np.array(r.vector)
        assert any(
            abs(np.linalg.norm(x - vectors[i]) + np.linalg.norm(x - vectors[j]) - np.linalg.norm(vectors[i] - vectors[j])) < 1e-9
            for i in range(20) for j, _ in near[i]
        )
    again = synthesize(df.repartition(7), k=5).collect()
    assert sorted(rows) == sorted(again)


def test_synthesis_refuses_bad_input(spark):
    rng = np.random.default_rng(4)
    with pytest.raises(ValueError):
        synthesize(points(spark, rng.normal(size=(20, 2)), [0] * 20))
    with pytest.raises(ValueError):
        synthesize(points(spark, rng.normal(size=(20, 2)), [0] * 10 + [1] * 10))


def test_cleaning_keeps_rows_whose_neighbours_agree(spark):
    rng = np.random.default_rng(5)
    vectors, labels = rng.normal(size=(200, 2)), rng.integers(0, 2, 200)
    near = brute(vectors, 3)
    want = {i for i in range(200) if all(labels[j] == labels[i] for j, _ in near[i])}
    assert {r.id for r in edited(points(spark, vectors, labels)).collect()} == want


def test_rebalance_marks_synthetic_rows(spark):
    rng = np.random.default_rng(6)
    vectors = np.concatenate([rng.normal(size=(30, 2)) + 20, rng.normal(size=(300, 2))])
    out = rebalance(points(spark, vectors, [1] * 30 + [0] * 300))
    counts = {(r.label, r.synthetic): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert counts == {(1, False): 30, (0, False): 300, (1, True): 98}
    assert out.filter(F.size("vector") != 2).count() == 0
