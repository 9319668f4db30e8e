from __future__ import annotations

from multiprocessing.pool import ThreadPool

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler

from keeprate.sources import commits


def test_ten_parallel_runs_get_ten_versions(spark, tmp_path):
    folder = str(tmp_path / "registry")
    with ThreadPool(10) as pool:
        given = pool.map(lambda i: commits.reserve_version(spark, folder, f"run-{i}"), range(10))
    assert sorted(given) == sorted(f"1.{i}" for i in range(10))
    assert commits.last_commit(spark, folder) == 10
    assert commits.reserve_version(spark, folder, "run-3") == given[3] and commits.last_commit(spark, folder) == 10
    assert commits.reserve_version(spark, folder, "run-10") == "1.10"


def test_a_taken_name_is_not_overwritten(spark, tmp_path):
    path = str(tmp_path / "one.json")
    with ThreadPool(8) as pool:
        won = pool.map(lambda i: commits.put_if_absent(spark, path, f"text {i}"), range(8))
    assert sum(won) == 1 and (tmp_path / "one.json").read_text() == f"text {won.index(True)}"
    assert [p.name for p in tmp_path.iterdir()] == ["one.json"]


def test_half_written_tables_are_invisible(spark, tmp_path):
    folder = str(tmp_path / "registry")
    first = commits.append(spark, spark.range(3), folder, "scores")
    spark.range(100).write.parquet(f"{folder}/data/scores-unfinished")
    commits.append(spark, spark.range(3, 5), folder, "scores", run_id="b")
    commits.append(spark, spark.range(7), folder, "other")
    assert sorted(r.id for r in commits.rows(spark, folder, "scores").collect()) == [0, 1, 2, 3, 4]
    # A reader of an earlier state keeps seeing it.
    assert commits.rows(spark, folder, "scores", upto=first).count() == 3
    assert [r.run_id for r in commits.entries(spark, folder).filter("kind = 'scores'").orderBy("number").collect()] == [None, "b"]


def test_models_by_version(spark, tmp_path):
    folder = str(tmp_path / "registry")
    with pytest.raises(LookupError):
        commits.load_model(spark, folder, "1.0")
    for name in ("a", "b"):
        commits.save_model(spark, folder, PipelineModel([VectorAssembler(inputCols=["x"], outputCol=name)]), "1.0", "run")
    PipelineModel([VectorAssembler(inputCols=["x"], outputCol="c")]).save(f"{folder}/versions/v1.0-unfinished")
    assert commits.load_model(spark, folder, "1.0").stages[0].getOutputCol() == "b"
    assert [r.version for r in commits.history(spark, folder).collect()] == ["1.0", "1.0"]
    assert commits.reserve_version(spark, folder, "next") == "1.1"


def test_nothing_committed(spark, tmp_path):
    folder = str(tmp_path / "registry")
    assert commits.entries(spark, folder).count() == 0 and commits.last_commit(spark, folder) == 0
    assert commits.rows(spark, folder, "scores", schema="id long").count() == 0
    with pytest.raises(LookupError):
        commits.rows(spark, folder, "scores")


def test_other_errors_are_raised(spark, tmp_path):
    (tmp_path / "file").write_text("no folder")
    with pytest.raises(Exception):
        commits.append(spark, spark.range(1), str(tmp_path / "file"), "scores")
