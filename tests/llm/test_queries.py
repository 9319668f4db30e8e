"""Registered queries next to their SQL, and the pipeline's stages."""

from __future__ import annotations

import pytest
from compare import difference, open_tables

import corpus_pipeline
from keeprate.llm import decontamination, lines, minhash, queries
from keeprate.llm.common import documents
from keeprate.session import table

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"  # where every stage has something to do


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, name):
    df = queries.queries()[name](spark, FOLDER)
    assert difference(df, open_tables(FOLDER), queries.oracle_sql()[name]) is None


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.queries()


def test_driver_contract():
    import __spark_entry__ as entry

    assert queries.queries().keys() <= entry.queries().keys()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_pipeline_stages(spark):
    """Each stage against its predecessor's rows."""
    docs, seen = documents(spark, LARGER), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, LARGER)
        path = corpus_pipeline.settled(out, name)
        seen.append((name, docs, path))
        docs = path
    columns = documents(spark, LARGER).columns
    assert [n for n, *_ in seen] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    for name, before, after in seen[:-1]:
        assert after.columns == columns and 0 < after.count() < before.count(), name
    ids = [{r.doc_id for r in after.collect()} for _, _, after in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    by = {name: (before, after) for name, before, after in seen}

    before, after = by["line_dedup"]
    wanted = {r.doc_id: r.kept for r in lines.dedup(spark, before).collect() if not r.removed or r.kept.strip()}
    assert {r.doc_id: r.text for r in after.collect()} == wanted
    assert all(r.n_chars == len(r.text) for r in after.collect())

    before, after = by["near_dedup"]
    kept = {r.doc_id for r in minhash.group(spark, before).collect() if r.kept}
    assert {r.doc_id for r in after.collect()} == kept

    before, after = by["decontamination"]
    leaked = {r.doc_id for r in decontamination.leaks(spark, before, table(spark, LARGER, "benchmark")).collect()}
    assert leaked and {r.doc_id for r in before.collect()} - leaked == {r.doc_id for r in after.collect()}

    _, after = by["mixing"]
    assert all(1 <= r.copies <= 3 and r.taken == r.size * r.copies for r in after.collect())
    assert sorted(map(str, corpus_pipeline.run(spark, LARGER).collect())) == sorted(map(str, after.collect()))


def test_pipeline_of_odd_documents(spark, corpus, nothing, tmp_path):
    for name, docs in (("odd", corpus), ("none", nothing)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1), (None, 1), (3, None), *((i, 0) for i in range(4, 60))], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "a b c d e f g"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.columns[:len(docs.columns)] == docs.columns
        assert out.count() == 0 if name == "none" else out.count() > 10
