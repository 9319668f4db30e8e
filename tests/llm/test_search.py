"""Exact top-k search and hard-negative mining against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keeprate.llm import blockmax, negatives, sparse

SCHEMA = "vec_id long, embedding array<float>, label int, block string, score string, part string"
ODD = [None, [0.5, None], [float("nan"), 0.0], [float("inf"), 1.0], [1e30, 0.0]]  # take no part


def vectors(count: int, seed: int, size: int = 6) -> list[tuple]:
    """Clustered vectors with ties, copies, empty and shorter ones, odd ones, repeated and null ids."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(4)]
    rows = [[round(c + rng.gauss(0, 0.3), 2) for c in rng.choice(centres)] for _ in range(count)]
    rows += [rows[0]] * 6 + [[], [0.0] * size, [0.25] * (size - 2), *ODD]
    out = [(7 * i, v, rng.choice([0, 0, 1, 2, None])) for i, v in enumerate(rows)]
    out += [out[3], (out[5][0], rows[8], 1), (None, rows[2], 0), (-100, rows[1], 0)]
    return [(i, v, label, "x", "x", "x") for i, v, label in out]


def whole(rows, scale, labelled=False):
    """id: (label, vector) as the operators define them."""
    out = {}
    for i, v, label, *_ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) or abs(x * scale) >= sparse.LARGEST for x in v) or labelled and label is None:
            continue
        key = [int(np.floor(scale * float(np.float32(x)))) for x in v]
        row = (label if labelled else None, key)
        if i not in out or (row[0] or 0, row[1]) < (out[i][0] or 0, out[i][1]):
            out[i] = row
    return out


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_topk(rows, scale, k, step):
    held = whole(rows, scale)
    out = []
    for q, (_, v) in held.items():
        if q % step == 0:
            near = sorted((-inner(v, w), i) for i, (_, w) in held.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


def brute_negatives(rows, scale, step, positives=5, most=5):
    held, out = whole(rows, scale, labelled=True), []
    for a, (label, v) in held.items():
        if a % step:
            continue
        scored = sorted((-inner(v, w), i, other) for i, (other, w) in held.items() if i != a)
        for p, i, _ in [x for x in scored if x[2] == label][:positives]:
            within = [(s, j) for s, j, other in scored if other != label and 80 * -p <= 100 * -s <= 100 * -p][:most]
            out += [(a, i, r + 1, j, -p, -s) for r, (s, j) in enumerate(within)]
    return sorted(out)


def search(spark, df, scale, k, step):
    bags = blockmax.bags(df, scale)
    return sorted(map(tuple, blockmax.search(spark, bags, bags.filter(F.col("id") % step == 0), k).collect()))


def mined(spark, df, scale, step, **options):
    return sorted(map(tuple, negatives.mine(spark, negatives.labelled(df, scale, F.col("label")), F.col("id") % step == 0, **options).collect()))


@pytest.mark.parametrize("block", [6, 512])
def test_topk(spark, monkeypatch, block):
    monkeypatch.setattr(blockmax, "BLOCK", block)
    monkeypatch.setattr(blockmax, "SUMMARIES", 7)
    monkeypatch.setattr(blockmax, "PART", 20)
    rows = vectors(90, 1)
    got = search(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), 1024, 10, 2)
    assert got == brute_topk(rows, 1024, 10, 2)


def test_topk_of_few(spark):
    rows = [*vectors(90, 2)[:4], (70, [-9.0] * 6, 0, "", "", ""), (77, [9.0] * 6, 0, "", "", "")]
    assert any(r[3] < 0 for r in brute_topk(rows, 16, 10, 1))
    assert search(spark, spark.createDataFrame(rows, SCHEMA), 16, 10, 1) == brute_topk(rows, 16, 10, 1)
    for none in ([], [r for r in vectors(3, 3) if r[1] in ODD[:3]]):
        assert search(spark, spark.createDataFrame(none, SCHEMA), 16, 10, 1) == []
    # A table without a query gives no rows.
    assert search(spark, spark.createDataFrame([(1, [1.0], 0, "", "", "")], SCHEMA), 16, 10, 2) == []


def test_topk_of_wide_bags(spark, monkeypatch):
    """Terms with wide numbers, most absent from a document."""
    monkeypatch.setattr(blockmax, "BLOCK", 4)
    monkeypatch.setattr(sparse, "PIECE", 5)
    rng = random.Random(4)
    bags = [(i, sorted(rng.sample(range(0, 10**12, 10**10), 6)), [rng.randint(-9, 9) for _ in range(6)]) for i in range(40)]
    df = spark.createDataFrame(bags, "id long, terms array<long>, weights array<long>")
    got = sorted(map(tuple, blockmax.search(spark, df, df, 3).collect()))
    of = {i: dict(zip(t, w)) for i, t, w in bags}
    want = []
    for q in of:
        near = sorted((-sum(w * of[i].get(t, 0) for t, w in of[q].items()), i) for i in of if i != q)[:3]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    assert got == sorted(want)


def test_blocks_are_skipped(spark, monkeypatch):
    """Separate clusters: bounds leave out most pairs of query and block."""
    monkeypatch.setattr(blockmax, "BLOCK", 10)
    rows = [(i, [float(x == i % 20) * (1 + i / 1e4) for x in range(20)], 0, "", "", "") for i in range(400)]
    seen, real = [], blockmax._scored

    def counting(pairs, *more):
        seen.append(pairs.count())
        return real(pairs, *more)

    monkeypatch.setattr(blockmax, "_scored", counting)
    assert search(spark, spark.createDataFrame(rows, SCHEMA), 1024, 5, 5) == brute_topk(rows, 1024, 5, 5)
    assert sum(seen) < 0.2 * 80 * 40


@pytest.mark.parametrize("block", [5, 2048])
def test_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "PART", 11)
    rows = vectors(120, 5)
    got = mined(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), 256, 2)
    assert got == brute_negatives(rows, 256, 2) and len(got) > 100


def test_negatives_of_wide_vectors(spark, monkeypatch):
    """Several segments a level, few open pairs, vectors of different lengths."""
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "DENSE", 0.9)
    rows = vectors(100, 6, size=150)
    got = mined(spark, spark.createDataFrame(rows, SCHEMA), 256, 3, positives=2, negatives=3)
    assert got == brute_negatives(rows, 256, 3, 2, 3)


def test_negatives_of_few(spark):
    rows = [(0, [1.0, 0.0], 0, "", "", ""), (1, [-1.0, 0.0], 0, "", "", ""), (2, [1.0, 0.0], 1, "", "", ""), (3, [0.0, 0.0], None, "", "", "")]
    assert mined(spark, spark.createDataFrame(rows, SCHEMA), 256, 1) == brute_negatives(rows, 256, 1) == []
    rows[1] = (1, [1.0, 0.5], 0, "", "", "")
    assert mined(spark, spark.createDataFrame(rows, SCHEMA), 256, 1) == brute_negatives(rows, 256, 1) != []
    assert mined(spark, spark.createDataFrame([], SCHEMA), 256, 1) == []


def test_segment_bounds_hold():
    rng = np.random.default_rng(1)
    x = rng.integers(-300, 300, (40, 128))
    for size in negatives.SEGMENTS:
        m, d = negatives.summaries(x, size)
        middle, reach = size * (m @ m.T), size * (d @ d.T)
        assert (x @ x.T <= middle + reach + 1e-6).all() and (x @ x.T >= middle - reach - 1e-6).all()


def test_products_are_exact_beyond_doubles():
    a = np.array([[sparse.LARGEST - 1, 1]] * 2)
    assert sparse.product(a, a.T).tolist() == [[(sparse.LARGEST - 1) ** 2 + 1] * 2] * 2
