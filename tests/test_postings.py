from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keeprate.schema import EVENT_SCHEMA
from keeprate.sources import events, postings


def log(spark, rows):
    """Events of (day, run, message)."""
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 12), r, m) for d, r, m in rows], "ts timestamp, run_id string, message string")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])


@pytest.fixture
def kept(spark, tmp_path):
    path, index = str(tmp_path / "log"), str(tmp_path / "index")
    rows = [(d, f"r{d}", f"Step {d} finished") for d in range(1, 9)]
    rows += [(3, "x", "disk FULL, step 4"), (5, "y", None), (6, "z", ""), (7, "u", "größe: 5"), (8, None, "step full")]
    events.append(log(spark, rows), path)
    assert postings.update(spark, path, index) == 8
    return path, index


def messages(df):
    return sorted(r.message for r in df.collect())


def test_all_words_in_any_order_and_case(spark, kept):
    assert messages(postings.search_messages(spark, *kept, "full STEP")) == ["disk FULL, step 4", "step full"]
    assert messages(postings.search_messages(spark, *kept, "Größe")) == ["größe: 5"]
    assert postings.search_messages(spark, *kept, "finished").count() == 8
    assert messages(postings.search_messages(spark, *kept, "full", days=["2024.01.08"])) == ["step full"]
    for text in ("ful", "absent", "", "  ,"):
        assert postings.search_messages(spark, *kept, text).count() == 0


def test_only_files_with_the_words_are_read(spark, kept):
    found = postings.search_messages(spark, *kept, "disk")
    assert len(found.inputFiles()) == 1 and "2024.01.03" in found.inputFiles()[0]
    assert len(postings.search_messages(spark, *kept, "step").inputFiles()) == 8


def test_files_after_the_update_are_read(spark, kept):
    path, index = kept
    events.append(log(spark, [(3, "new", "disk gone"), (20, "new", "nothing")]), path)
    found = postings.search_messages(spark, path, index, "disk")
    assert messages(found) == ["disk FULL, step 4", "disk gone"] and len(found.inputFiles()) == 3
    assert postings.update(spark, path, index) == 2 and postings.update(spark, path, index) == 0
    found = postings.search_messages(spark, path, index, "disk")
    assert messages(found) == ["disk FULL, step 4", "disk gone"] and len(found.inputFiles()) == 2


def test_runs_keep_their_order_in_files(spark, tmp_path):
    events.append(log(spark, [(1, f"r{i * 7 % 10}", "m") for i in range(10)]), str(tmp_path / "log"))
    assert [r.run_id for r in spark.read.parquet(str(tmp_path / "log")).collect()] == [f"r{i}" for i in range(10)]
