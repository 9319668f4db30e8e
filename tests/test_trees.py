"""Forests and second-order boosting: one result however it is computed, and the settings' effects."""

from __future__ import annotations

import pathlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from keeprate.operators import trees
from keeprate.plans import models, search


def frame(spark, x, y, **more):
    rows = [(i, float(label), [float(v) for v in values]) for i, (values, label) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "customer_id long, label double, v array<double>")
    return df.select("customer_id", "label", array_to_vector("v").alias("features"), *[F.lit(v).alias(k) for k, v in more.items()])


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 5)), 2)
    x[:, 4] = rng.integers(0, 3, 400)
    y = (x[:, 0] + x[:, 1] * (x[:, 4] - 1) + 0.5 * rng.normal(size=400)) > 0.2
    return frame(spark, x, y)


def nodes(model) -> pd.DataFrame:
    """Nodes by path, since node numbers follow the order of growth."""
    out = []
    for number, tree in model.nodes.groupby("tree"):
        rows = tree.set_index("node")
        todo = [(0, "")]
        while todo:
            node, path = todo.pop()
            r = rows.loc[node]
            out.append((number, path, int(r.feature), r.threshold, round(r.value, 12), round(r.gain, 6), round(r["cover"], 6)))
            if r.feature >= 0:
                todo += [(int(r.left), path + "l"), (int(r.right), path + "r")]
    return pd.DataFrame(sorted(out), columns=["tree", "path", "feature", "threshold", "value", "gain", "cover"])


ESTIMATORS = {
    "boosted": lambda: trees.SecondOrderBoosting(maxIter=5, maxDepth=4, subsamplingRate=0.8, featureShare=0.6, gamma=0.5, stepSize=0.5),
    "forest": lambda: trees.Forest(numTrees=4, minRowsToSplit=5, minInstancesPerNode=2),
    "bounded": lambda: trees.Forest(numTrees=3, maxDepth=3, featureSubsetStrategy="log2"),
}


@pytest.mark.parametrize("name", list(ESTIMATORS))
def test_levels_tasks_and_partitions_grow_the_same_trees(noisy, monkeypatch, name):
    whole = nodes(ESTIMATORS[name]().fit(noisy))
    assert len(whole) > 20
    monkeypatch.setattr(trees, "CUT", 2)
    for small, cells, parts in ((60, 4_000_000, 4), (1, 2_000, 8), (100_000, 1, 1)):
        monkeypatch.setattr(trees, "SMALL", small)  # nodes above go level by level
        monkeypatch.setattr(trees, "CELLS", cells)  # few cells: many batches a level
        pd.testing.assert_frame_equal(whole, nodes(ESTIMATORS[name]().fit(noisy.repartition(parts))))


def test_rows_of_a_branch_travel_together(noisy, monkeypatch):
    """A task sends a node's rows as one, not a row of the table for each of them in each tree."""
    dealt, run = [], type(noisy).mapInArrow

    def watched(df, *args, **kwargs):
        out = run(df, *args, **kwargs)
        if {"tree", "node", "codes"} <= set(out.columns):
            dealt.append(out)
        return out

    estimator = trees.Forest(numTrees=4)
    binned = estimator.binned(noisy.repartition(2))
    whole = nodes(estimator.fit_binned(*binned))
    monkeypatch.setattr(trees, "SMALL", 150)
    monkeypatch.setattr(type(noisy), "mapInArrow", watched)
    pd.testing.assert_frame_equal(whole, nodes(estimator.fit_binned(*binned)))
    assert len(dealt) == 1
    found, tasks = dealt[0].toPandas(), binned[0].rdd.getNumPartitions()
    per_node = found.groupby(["tree", "node"]).size()
    assert len(per_node) >= 8 and per_node.max() <= tasks
    assert found["codes"].map(len).sum() > 4 * 400 * 5 / 2  # about 63 of 100 rows are drawn for a tree


def test_deep_boosted_trees_from_blocks(noisy, monkeypatch):
    """Levels over packed rows, and tasks below, grow the trees that one task grows."""
    estimator = trees.SecondOrderBoosting(maxIter=4, maxDepth=8, subsamplingRate=0.9, minHessian=0.1)
    whole = nodes(estimator.fit(noisy))
    monkeypatch.setattr(trees, "SMALL", 60)
    monkeypatch.setattr(trees, "CUT", 3)
    pd.testing.assert_frame_equal(whole, nodes(estimator.fit(noisy)))


def test_one_task_grows_boosted_trees_of_some_more_rows(noisy, monkeypatch):
    """No job for each level of each round where the whole table is a few small nodes."""
    monkeypatch.setattr(trees, "SMALL", 150)
    monkeypatch.setattr(trees, "_distributed", None)
    assert trees.SecondOrderBoosting(maxIter=2, maxDepth=3).fit(noisy).getNumTrees == 2


def test_one_task_grows_boosted_trees_of_a_million_rows(noisy, monkeypatch):
    """As many rows as a task holds need no job for each level of each round; more rows, or many columns, grow the same trees level by level."""
    estimator = trees.SecondOrderBoosting(maxIter=5, maxDepth=8, subsamplingRate=0.9, featureShare=0.7, minHessian=0.1, gamma=0.3)
    monkeypatch.setattr(trees, "SMALL", 40)  # a tenth of the rows
    with monkeypatch.context() as m:
        m.setattr(trees, "_distributed", None)
        m.setattr(trees, "JOINT_ROWS", 50, raising=False)
        whole = nodes(estimator.fit(noisy))
    for name in ("ALONE", "ALONE_CODES"):
        with monkeypatch.context() as m:
            m.setattr(trees, name, 1)
            m.setattr(trees, "_successive", None)
            pd.testing.assert_frame_equal(whole, nodes(estimator.fit(noisy)))


def test_joint_histograms_equal_plain_ones():
    rng = np.random.default_rng(8)
    codes = np.stack([rng.integers(0, n, 900) for n in (256, 3, 200, 1, 40, 256, 2)], axis=1).astype(np.uint8)
    stats = np.stack([rng.integers(-9, 9, 900), rng.integers(0, 9, 900), rng.integers(1, 4, 900)])
    rows, columns = np.sort(rng.permutation(900)[:500]), np.array([0, 2, 3, 5, 6])
    joint = trees.Joint(codes)
    assert len(joint.groups) < 5
    for own in (stats, np.stack([*stats[:2], np.ones(900, int)])):
        plain = trees.histogram(codes[rows], columns, own[:, rows])
        assert (joint.histogram(rows, columns, own[:, rows].astype(float)) == plain).all()
        assert (joint.take(rows).histogram(np.arange(500), columns, own[:, rows].astype(float)) == plain).all()


def test_a_branch_keeps_its_sums_and_no_histograms():
    rng = np.random.default_rng(5)
    codes, ones = rng.integers(0, 200, (3_000, 4)).astype(np.uint8), np.full(3_000, 1 << 26)
    stats = np.stack([ones * rng.integers(0, 2, 3_000), ones, np.ones(3_000, np.int64)])
    tree = trees.grown(codes, stats, trees.Gini(2, 1, 1_000), trees.Columns(4, 1), 0, 1, 0)
    assert len(tree.stats) > 500
    assert sum((s if s.base is None else s.base).nbytes for s in tree.stats) == 24 * len(tree.stats)


def test_forests_beyond_what_tasks_hold(noisy, monkeypatch, tmp_path):
    """Trees stay on the executors, however many nodes; they score alike dealt out and sent to all."""
    whole = trees.Forest(numTrees=5).fit(noisy)
    sent = {r.customer_id: (r.probability, r.prediction) for r in whole.transform(noisy).collect()}
    assert len(sent) == 400 and 0 <= min(sent.values())[0] < 0.2 and max(sent.values())[0] > 0.8
    for name, limit in (("MOST_NODES", 50), ("HELD_NODES", 100), ("SCORED_ROWS", 150)):
        monkeypatch.setattr(trees, name, limit)
    model = trees.Forest(numTrees=5).fit(noisy)
    pd.testing.assert_frame_equal(nodes(whole), nodes(model))
    model.write().save(f"{tmp_path}/forest")
    for dealt in (model, trees.ForestModel.read().load(f"{tmp_path}/forest"), model.copy()):
        found = dealt.transform(noisy.union(noisy.limit(3))).collect()
        assert len(found) == 403 and {r.customer_id: (r.probability, r.prediction) for r in found} == sent
        assert dealt.getNumTrees == 5 and dealt.featureImportances == whole.featureImportances


def test_no_row_of_a_forest_holds_a_whole_tree(noisy, monkeypatch, tmp_path):
    """Rows are branches of small nodes, and a vector goes to a branch as bytes, not to every part of the forest as numbers."""
    whole = nodes(trees.Forest(numTrees=3).fit(noisy))
    monkeypatch.setattr(trees, "SMALL", 60)
    monkeypatch.setattr(trees, "HELD_NODES", 50)
    monkeypatch.setattr(trees, "DRAWN_ROWS", 800)  # two trees at once
    model = trees.Forest(numTrees=3).fit(noisy)
    pd.testing.assert_frame_equal(whole, nodes(model))
    sizes = [r.n for r in model.packed.select(F.size("feature").alias("n")).collect()]
    assert max(sizes) < min(whole.groupby("tree").size())
    model.write().save(f"{tmp_path}/forest")
    dealt, run = [], type(noisy).repartition

    def watched(df, *args):
        dealt.append(df)
        return run(df, *args)

    monkeypatch.setattr(type(noisy), "repartition", watched)
    odd = noisy.unionByName(noisy.limit(2).withColumn("features", array_to_vector(F.array(*[F.lit(x) for x in (float("nan"), -0.0, float("inf"), 9.0, 1.0)]))))
    found = [sorted((r.customer_id, r.probability) for r in m.transform(odd).collect()) for m in (model, trees.ForestModel.load(f"{tmp_path}/forest"))]
    assert len(found[0]) == 402 and found[0] == found[1]
    met = [df.filter("kind = 1").toPandas() for df in dealt if "kind" in df.columns]
    assert met and all(sum(map(len, m["data"])) <= 401 * 5 * 3 for m in met)
    monkeypatch.setattr(trees, "HELD_NODES", 10**6)
    assert found[0] == sorted((r.customer_id, r.probability) for r in model.transform(odd).collect())


def test_trials_leave_no_trees_behind(spark, noisy, monkeypatch):
    """A search keeps the winner's tables alone, whatever the number of trials."""
    from keeprate.session import run_folder

    monkeypatch.setattr(trees, "HELD_NODES", 20)  # scored by dealing
    folder = pathlib.Path(run_folder(spark).removeprefix("file:"))
    before = {f.name for f in folder.glob("*")}
    settings = [{"numTrees": n, "maxDepth": 20} for n in (2, 3, 4)]
    found, trials = search.search(noisy, trees.Forest(), {}, settings=settings)
    left = sorted(f.name.rsplit("-", 1)[0] for f in folder.glob("*") if f.name not in before)
    assert left == ["binned", "binned", "fitted", "trees", "validated"]
    assert trials.count() == 3 and found.bestModel.transform(noisy).count() == 400


def test_a_round_equals_the_formulas(spark):
    """One split of one feature, by hand: gradients 1/2 - y, Hessians 1/4."""
    df = frame(spark, [[0], [0], [1], [1], [1], [2], [2], [2]], [0, 0, 0, 1, 0, 1, 1, 1])
    model = trees.SecondOrderBoosting(maxIter=1, maxDepth=1, minHessian=0.5, l2=1.0, stepSize=0.3).fit(df)
    root, left, right = (model.nodes.iloc[i] for i in range(3))
    assert (root.feature, root.threshold) == (0, 1.0)
    g, h = (5 * 0.5 - 1, 1.25), (3 * 0.5 - 3, 0.75)
    assert left.value == pytest.approx(-0.3 * g[0] / (g[1] + 1)) and right.value == pytest.approx(-0.3 * h[0] / (h[1] + 1))
    assert root.gain == pytest.approx(g[0] ** 2 / (g[1] + 1) + h[0] ** 2 / (h[1] + 1) - (g[0] + h[0]) ** 2 / 3)


def test_gamma_and_hessian_limits(noisy):
    def count(**settings):
        return len(trees.SecondOrderBoosting(maxIter=1, maxDepth=5, **settings).fit(noisy).nodes.query("feature >= 0"))

    def kept(**settings):
        model = trees.SecondOrderBoosting(maxIter=1, maxDepth=5, **settings).fit(noisy)
        return nodes(model)

    assert count(gamma=1e9) == 0 and 0 < count(minHessian=20.0) < count()
    leaves_above = kept(gamma=3.0)
    inner = leaves_above[leaves_above.feature >= 0]
    for _, r in inner.iterrows():  # a weak split stays only above a kept one
        below = inner[inner.path.str.startswith(r.path) & (inner.path != r.path)]
        assert r.gain >= 3.0 or len(below)


def test_columns_are_drawn_for_a_tree_and_for_a_node(noisy):
    boosted = trees.SecondOrderBoosting(maxIter=6, maxDepth=5, featureShare=0.4).fit(noisy).nodes.query("feature >= 0")
    assert boosted.groupby("tree")["feature"].nunique().max() <= 2 and boosted["feature"].nunique() > 2
    forest = trees.Forest(numTrees=1).fit(noisy).nodes.query("feature >= 0")
    assert forest["feature"].nunique() == 5


def test_limits_of_rows(noisy):
    model = trees.Forest(numTrees=3, minRowsToSplit=30, minInstancesPerNode=7, bootstrap=False).fit(noisy)
    inner, leaves = model.nodes.query("feature >= 0"), model.nodes.query("feature < 0")
    assert inner["cover"].min() >= 30 and leaves["cover"].min() >= 7


def test_trees_deeper_than_thirty(spark):
    df = frame(spark, [[i] for i in range(120)], [i % 2 for i in range(120)])
    model = trees.Forest(numTrees=1, bootstrap=False, featureSubsetStrategy="all").fit(df)
    assert nodes(model).path.str.len().max() > 30
    assert all(r.prediction == r.label for r in model.transform(df).collect())


def test_missing_numbers_and_many_values(spark):
    rng = random.Random(1)
    values = [float("nan") if i % 7 == 0 else rng.random() for i in range(3_000)]
    df = frame(spark, [[v] for v in values], [1.0 if np.isnan(v) or v > 0.5 else 0.0 for v in values])
    cuts = trees.bin_edges(df, "features")[0]
    assert len(cuts) < trees.BINS and not np.isnan(cuts).any()
    model = trees.SecondOrderBoosting(maxIter=3, maxDepth=2).fit(df)
    assert models.area_under_roc(model.transform(df)) > 0.99


def test_few_values_are_all_cuts(spark):
    df = frame(spark, [[i % 200] for i in range(2_000)], [i % 2 for i in range(2_000)])
    assert trees.bin_edges(df, "features")[0].tolist() == list(range(200))


def test_one_class_and_no_rows(spark, noisy):
    one = noisy.withColumn("label", F.lit(1.0))
    assert len(trees.Forest(numTrees=2).fit(one).nodes) == 2
    assert {r.prediction for r in trees.SecondOrderBoosting(maxIter=2).fit(one).transform(noisy).collect()} == {1.0}
    with pytest.raises(ValueError, match="no training rows"):
        trees.Forest().fit(noisy.limit(0))
    with pytest.raises(ValueError, match="featureSubsetStrategy"):
        trees.Forest(featureSubsetStrategy="some").fit(noisy)


def test_weights_and_rows_without_an_id(noisy):
    heavy = noisy.withColumn("weight", F.when(F.col("label") == 1, 50.0).otherwise(1.0))
    settings = dict(numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=2)
    plain, weighted = (trees.Forest(**settings, weightCol=w).fit(heavy).transform(noisy).agg(F.avg("probability")).first()[0] for w in (None, "weight"))
    assert weighted > plain + 0.2
    again = [nodes(trees.Forest(numTrees=2, maxDepth=3).fit(noisy.drop("customer_id").repartition(n))) for n in (1, 5)]
    pd.testing.assert_frame_equal(*again)


def test_models_save_and_load(noisy, tmp_path):
    for name, kind in (("forest", trees.ForestModel), ("boosted", trees.BoostedModel)):
        model = ESTIMATORS[name]().fit(noisy)
        model.write().overwrite().save(str(tmp_path / name))
        again = kind.load(str(tmp_path / name))
        assert sorted(model.transform(noisy).collect()) == sorted(again.transform(noisy).collect())
        assert again.featureImportances == model.featureImportances
        assert sum(model.featureImportances) == pytest.approx(1)


# ---- search --------------------------------------------------------------------------

SPACE = {"a": ("range", 0.0, 1.0), "b": ("log", 1e-3, 1.0), "c": ("steps", 0, 20, 2), "d": ("choice", "x", "y", "z")}


def surface(s: dict) -> float:
    return -((s["a"] - 0.3) ** 2) - (np.log10(s["b"]) + 2) ** 2 / 9 - (s["c"] - 14) ** 2 / 400 - 0.3 * (s["d"] != "y")


def test_search_beats_random_draws():
    rng = random.Random(5)
    ours, theirs = [], []
    for seed in range(12):
        ours.append(max(v for _, v in search.sequential(SPACE, 50, surface, seed)))
        theirs.append(max(surface({n: search.drawn(k, tuple(x), rng) for n, (k, *x) in SPACE.items()}) for _ in range(50)))
    assert np.mean(ours) > np.mean(theirs) and sum(a > b for a, b in zip(ours, theirs)) >= 8


def test_search_is_repeatable_and_within_its_space():
    found = search.sequential(SPACE, 30, surface, 1)
    assert found == search.sequential(SPACE, 30, surface, 1) and len(found) == 30
    for s, _ in found:
        assert 0 <= s["a"] <= 1 and 1e-3 <= s["b"] <= 1 and s["c"] in range(0, 21, 2) and s["d"] in "xyz"


def test_pending_trials_push_proposals_away():
    done = [({"a": x / 20}, -abs(x / 20 - 0.5)) for x in range(20)]
    space = {"a": ("range", 0.0, 1.0)}
    alone = [search.propose(space, done, [], random.Random(i))["a"] for i in range(60)]
    crowd = [search.propose(space, done, [{"a": 0.5}] * 12, random.Random(i))["a"] for i in range(60)]
    assert np.mean(np.abs(np.array(crowd) - 0.5)) > np.mean(np.abs(np.array(alone) - 0.5))


def test_search_bins_once_and_refits_the_best(spark, noisy, monkeypatch):
    count, real = [], trees.bin_edges
    monkeypatch.setattr(trees, "bin_edges", lambda *a: count.append(1) or real(*a))
    found, table = models.search_parameters(noisy, "boosted_trees", trials=3)
    assert len(count) == 2  # for all trials, and for the winner on all rows
    rows = table.orderBy("trial").collect()
    assert [r.accuracy for r in rows] == found.validationMetrics and len(rows) == 3
    best = max(rows, key=lambda r: r.accuracy)
    assert best.settings == {k: str(v) for k, v in found.bestSettings.items()}
    assert found.bestModel.getNumTrees == int(best.settings["maxIter"])


def test_larger_children_take_their_histograms_from_above(monkeypatch):
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 256, (4_000, 6), dtype=np.uint8)
    label = (codes[:, 0] > 200) ^ (codes[:, 1] < 90) ^ (rng.random(4_000) < 0.2)
    stats = np.stack([np.rint((0.5 - label) * trees.UNIT), np.full(4_000, trees.UNIT / 4), np.ones(4_000)]).astype(np.int64)
    read, histogram = [], trees.histogram
    monkeypatch.setattr(trees, "histogram", lambda codes, *others: read.append(len(codes)) or histogram(codes, *others))
    monkeypatch.setattr(trees, "SORTED", 60)

    def grown():
        read.clear()
        tree = trees.grown(codes, stats, trees.Newton(1.0, 0.0, 1.0, 7), trees.Columns(6, 42, a_tree=0.8), 0, 1, 0)
        return [getattr(tree, f) for f in (*tree.FIELDS, "key", "depth")], np.concatenate(tree.stats), sum(read)

    tree, sums, rows = grown()
    monkeypatch.setattr(trees, "HELD_HISTOGRAMS", 0, raising=False)
    plain, plain_sums, plain_rows = grown()
    assert tree == plain and (sums == plain_sums).all()
    assert rows < 0.75 * plain_rows
