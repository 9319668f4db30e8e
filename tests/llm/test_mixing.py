from __future__ import annotations

import collections

from keeprate.llm import mixing


def test_targets_share_by_weight_and_stop_at_the_limit(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 1000), ("e", 0)], "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(spark, sizes).collect()}
    # Weights 5, 2, 1, 5 (for e) and 2 (null, last): a stops at 30, e at 0; 2980 is shared by 2, 1 and 2.
    assert found["a"] == 30 and found["e"] == 0
    assert abs(found["b"] - 1192) < 1e-9 and abs(found["c"] - 596) < 1e-9 and abs(found[None] - 1192) < 1e-9


def test_mix_comes_near_its_targets(spark, corpus):
    rows = mixing.mix(spark, corpus).collect()
    assert len(rows) == corpus.count()
    taken, target, largest = collections.Counter(), {}, collections.Counter()
    for r in rows:
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], 2 * r.size)  # one row may be repeated
    assert abs(sum(target.values()) - sum(r.size for r in rows)) < 1e-6
    for source, goal in target.items():
        assert abs(taken[source] - goal) <= largest[source]


def test_runs_agree(spark, corpus):
    once = sorted(map(str, mixing.mix(spark, corpus).collect()))
    assert once == sorted(map(str, mixing.mix(spark, corpus.repartition(5)).collect()))


def test_mixed_documents_keep_their_columns(spark, corpus):
    found = mixing.mixed(spark, corpus)
    assert found.columns[:len(corpus.columns)] == corpus.columns
    assert {r["copies"] for r in found.select("copies").collect()} == {"extra"}
    copies = {(r.doc_id, r.size): r.copies for r in mixing.mix(spark, corpus).collect()}
    assert all(r["_copies"] == copies[r.doc_id, r["_size"]] > 0 for r in found.collect())


def test_no_words_and_no_rows(spark, nothing):
    assert mixing.mix(spark, nothing).count() == 0 and mixing.mixed(spark, nothing).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(spark, blank).collect()] == [(0, 0.0, 0)] * 2
