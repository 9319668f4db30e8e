from __future__ import annotations

import math

import numpy as np
import pytest

from keeprate.llm import neighbours, queries
from keeprate.session import table


def exact(vectors, queries, k):
    out = {}
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    norm = np.sqrt((x * x).sum(1))
    for i, q in queries:
        q = np.array(q, float)
        s = x @ q / norm / math.sqrt(q @ q)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_registered_query(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").collect()]
    wanted = exact(rows, [r for r in rows if r[0] % 50 == 0], 5)
    found = {}
    for r in queries.op7_neighbours(spark, folder).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r)
    assert found.keys() == wanted.keys()
    met = 0
    for q, list_ in found.items():
        assert [r.rank for r in list_] == [1, 2, 3, 4, 5]
        assert [r.score for r in list_] == sorted((r.score for r in list_), reverse=True)
        true = dict(wanted[q])
        met += sum(r.vec_id in true for r in list_)
        assert all(abs(true[r.vec_id] - r.score) < 1e-12 for r in list_ if r.vec_id in true)
    assert met >= 0.9 * sum(map(len, wanted.values()))


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
        (8, [1.0, inf]), (9, [None, 1.0]), (10, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (3, [0.0, 1.0]), (11, [1e38, 1e38]), (12, [-1.0, 0.0]),
    ]
    vectors = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, bucket string")
    found = neighbours.nearest(spark, vectors, vectors, k=5).orderBy("query_id", "rank").collect()
    lists = {}
    for r in found:
        lists.setdefault(r.query_id, []).append(r.vec_id)
    assert set(lists) == {0, 1, 2, 3, 11, 12}
    assert lists[0] == [1, 2, 11, 3, 12] and lists[1] == [0, 2, 11, 3, 12]  # ties to the smaller id
    assert lists[12] == [3, 11, 0, 1, 2]


def test_one_vector_in_many_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8))
    x[200:500] = x[0]  # half of all rows are one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = vectors.filter("vec_id % 50 = 0")
    found = {}
    for r in neighbours.nearest(spark, vectors, asked).collect():
        found.setdefault(r.query_id, {})[r.rank] = r.vec_id
    wanted = exact(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert [found[0][i] for i in range(1, 6)] == [200, 201, 202, 203, 204]
    met = sum(len(set(found[q].values()) & {i for i, _ in wanted[q]}) for q in wanted)
    assert met >= 0.9 * 5 * len(wanted)


def recall(found, wanted):
    lists = {}
    for r in found.collect():
        lists.setdefault(r.query_id, set()).add(r.vec_id)
    return sum(len(lists[q] & {i for i, _ in w}) for q, w in wanted.items()) / sum(map(len, wanted.values()))


@pytest.mark.parametrize("most", [1, 8])
def test_too_few_probes_do_not_lose_neighbours(spark, monkeypatch, most):
    monkeypatch.setattr(neighbours, "BUCKET", 4)  # five directions a table: 243 perturbations, as 6561 meet the limit in a large one
    monkeypatch.setattr(neighbours, "MOST_PROBES", most)
    x = np.random.default_rng(2).normal(size=(4000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(spark, vectors, vectors.filter("vec_id % 20 = 0"))
    assert recall(found, exact(rows, [r for r in rows if r[0] % 20 == 0], 5)) >= 0.9


def test_queries_unlike_the_points_are_checked(spark):
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(300, 16)), 10, axis=0) + 1e-4 * rng.normal(size=(3000, 16))  # close groups: few probes meet them
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    asked = [(10_000 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 16)))]
    schema = "vec_id long, embedding array<double>"
    found = neighbours.nearest(spark, spark.createDataFrame(rows, schema), spark.createDataFrame(asked, schema))
    assert recall(found, exact(rows, asked, 5)) >= 0.9


def test_places_follow_the_probes():
    into = np.random.default_rng(4).uniform(size=4)
    steps = neighbours.probes(into, 81)
    assert [neighbours._place(into, s) for s in steps] == list(range(1, 82))


def test_probes_come_by_estimated_success():
    steps = neighbours.probes(np.array([0.1, 0.6]), 9)
    assert len(steps) == 9 and len({tuple(s) for s in steps}) == 9
    assert [tuple(s) for s in steps[:3]] == [(0, 0), (-1, 0), (0, 1)]


def test_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(spark, none, none).count() == 0


def test_each_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=(8, 8, 3, 8, 5)[i % 5]).tolist()) for i in range(900)]
    rows += [(900, [1.0, 2.0]), (901, [3.0] * 4), (902, [1.0] * 4), (7, [2.0, 1.0])]  # few of a length, an id of two lengths
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = vectors.filter("vec_id % 20 = 0 OR vec_id > 900")
    lists = {}
    for r in neighbours.nearest(spark, vectors, asked).collect():
        lists.setdefault(r.query_id, []).append((r.vec_id, r.score))
    met = total = 0
    for q, x in [r for r in rows if r[0] % 20 == 0 or r[0] > 900]:
        wanted = exact([r for r in rows if len(r[1]) == len(x)], [(q, x)], 5)[q]
        total += len(wanted)
        true = dict(wanted)
        assert len(lists[q]) == len(wanted)
        met += sum(i in true and abs(true[i] - s) < 1e-9 for i, s in lists[q])
    assert met >= 0.9 * total and lists[901] == [(902, pytest.approx(1.0))] and lists[900] == [(7, pytest.approx(0.8))]
