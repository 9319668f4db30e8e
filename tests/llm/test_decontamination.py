from __future__ import annotations

import collections
import re

import pytest
from pyspark.sql import functions as F

from keeprate.llm import decontamination


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(rows, items, least=0.8):
    out = {}
    for doc_id, text, *_ in rows:
        w = words(text)
        for item_id, item in items:
            v = words(item)
            if not v:
                continue
            size, width = len(v), min(5, len(v))
            bag = collections.Counter(tuple(v[i:i + width]) for i in range(size - width + 1))
            for start in range(max(0, len(w) - size) + 1):
                part = w[start:start + size]
                if len(part) < width:
                    continue
                own = collections.Counter(tuple(part[i:i + width]) for i in range(len(part) - width + 1))
                s = sum((own & bag).values()) / sum((own | bag).values())
                if s >= least and s > out.get((doc_id, item_id), (0, 0))[0]:
                    out[doc_id, item_id] = (s, start)
    return out


@pytest.fixture(scope="module")
def items():
    from conftest import texts

    prose = [t for _, t, *_ in texts() if t and 30 < len(t.split()) < 200]
    cut = [" ".join(t.split()[3:3 + n]) for t, n in zip(prose, (20, 14, 40, 25, 60, 33, 18))]
    return [*enumerate(cut), (7, "unrelated words that stand nowhere in the corpus at all"), (8, None), (9, "!!!"), (10, "two words"), (0, cut[0])]


def test_leaks_match_brute_force(spark, corpus, rows, items):
    tests = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    found = decontamination.leaks(spark, corpus, tests).collect()
    wanted = {}
    for (doc_id, item), best in brute(rows, items).items():
        wanted[doc_id, item] = best
    assert len(wanted) > 12
    assert {(r.doc_id, r.item_id) for r in found} == set(wanted)
    for r in found:
        s, start = wanted[r.doc_id, r.item_id]
        assert abs(r.similarity - s) < 1e-12 or r.similarity < s  # rows may share an id
        assert r.start_word == start or r.similarity != s


def test_edited_leaks_are_found(spark, items):
    long_item = items[4][1].split()
    edited = [*long_item[:30], "changed", *long_item[31:]]
    docs = spark.createDataFrame([
        (1, "before all that " + " ".join(long_item).upper() + " after"), (2, "x y " + " ".join(edited)), (3, " ".join(long_item[:40])),
        (4, " ".join(long_item[:56])), (5, " ".join(reversed(long_item))), (6, None), (7, "")], "doc_id long, text string")
    tests = spark.createDataFrame([(1, " ".join(long_item))], "item_id long, text string")
    assert sorted(r.doc_id for r in decontamination.leaks(spark, docs, tests).collect()) == [1, 2, 4]


def test_very_long_items_are_found(spark):
    item = " ".join(f"w{i}" for i in range(70_000))  # about half of the shingles vote for each bit: over 32,767 votes
    docs = spark.createDataFrame([(1, f"before {item}"), (2, "w1 w2 w3 w4 w5 w6")], "doc_id long, text string")
    tests = spark.createDataFrame([(1, item), (2, "w1 w2 w3 w4 w5 w6")], "item_id long, text string")
    found = decontamination.leaks(spark, docs, tests).collect()
    assert sorted((r.doc_id, r.item_id, r.similarity, r.start_word) for r in found) == [(1, 1, 1.0, 1), (1, 2, 1.0, 2), (2, 2, 1.0, 0)]


def test_clean_documents_stay(spark, corpus, rows, items, nothing):
    tests = spark.createDataFrame(items, "item_id long, text string")
    kept = decontamination.keep_clean(spark, corpus, tests)
    assert kept.columns == corpus.columns
    wanted = collections.Counter((r[0], r[1]) for r in rows if not brute([r], items))
    assert collections.Counter((r.doc_id, r.text) for r in kept.collect()) == wanted
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.keep_clean(spark, corpus, none).count() == corpus.count()
    assert decontamination.leaks(spark, nothing, tests).count() == 0


def test_blocks_guarantee_the_radius():
    assert len(decontamination.TURNS) == 37
    assert decontamination.RADIUS < decontamination.BLOCKS * (decontamination.FLIPS + 1)
