"""Classifiers by their accuracy on documents that they did not learn from."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest
import zstandard

from keeprate.llm import language, queries, toxicity
from keeprate.llm.common import documents
from keeprate.session import table

FOLDER = "/root/testdata/sf0.1"


def test_toxicity_of_held_out_documents(spark):
    found = {r.doc_id: r for r in queries.op4_toxicity(spark, FOLDER).collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, FOLDER, "labels").collect()}
    assert len(found) == documents(spark, FOLDER).count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    held = [(found[i].score, y) for i, y in labels.items() if i in found and found[i].held_out]
    bad, good = np.array([s for s, y in held if y]), np.array([s for s, y in held if not y])
    assert (bad >= 0.3).mean() > 0.85 and (good < 0.3).mean() > 0.97
    assert (bad[:, None] > good[None, :]).mean() > 0.95


def test_offending_sentences_are_located(spark, corpus):
    rows = [(i, f"all is well here. you {'idiot' if i % 2 else 'friend'} of mine! and more {i}") for i in range(200)]
    docs = spark.createDataFrame([*rows, (500, None), (501, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    text = dict(rows)[1]
    assert [text[s.start:s.end] for s in found[1].offending] == [" you idiot of mine"]
    assert found[1].score > 0.9 > 0.1 > found[2].score and found[500].score == found[501].score < 0.3
    out = toxicity.scored(corpus, model)
    assert out.columns == [*corpus.columns, "_score", "offending"] and out.count() == corpus.count()
    assert toxicity.keep_clean(spark, corpus, labels).columns == corpus.columns


def test_labels_that_teach_nothing(spark, corpus, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(i, 0) for i in range(9)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    for labels in (none, one):
        scores = {r["_score"] for r in toxicity.scored(corpus, toxicity.fit(corpus, labels)).collect()}
        assert max(scores) - min(scores) < 1e-6 and max(scores) < 0.3
    assert toxicity.keep_clean(spark, nothing, one).count() == 0


def test_language_of_held_out_documents(spark):
    found = {r.doc_id: r for r in queries.op10_language(spark, FOLDER).collect()}
    docs = documents(spark, FOLDER).collect()
    assert len(found) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 5 == 0]
    assert all(found[d.doc_id].held_out for d in held)
    assert np.mean([found[d.doc_id].lang_pred == d.lang for d in held]) > 0.96
    sure = [d for d in held if not found[d.doc_id].rejected]
    assert np.mean([found[d.doc_id].lang_pred == d.lang for d in sure]) > 0.985


def test_language_of_odd_texts(spark, corpus, nothing):
    content = {"en": b"the house and the garden of the old man", "de": "das haus und der garten von dem alten mann".encode()}
    rows = [(1, None), (2, ""), (3, "123 --- 456"), (4, "THE GARDEN and the house"), (5, "der garten und das haus"), (5, "der garten und das haus"), (None, "der garten von dem alten mann")]
    found = [tuple(r) for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), content).collect()]
    assert [(i, lang) for i, lang, *_ in found] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (5, "de"), (None, "de")]
    assert all(0 <= s <= 1 for _, _, s, _ in found)
    assert language.identify(corpus, {}).select("lang_pred").distinct().collect()[0][0] == "und"
    assert set(language.dictionaries(corpus)) == {"en", "de"} and language.dictionaries(nothing) == {}
    assert language.identify(nothing, content).count() == 0


def test_scores_equal_a_plain_scorer_of_the_same_model(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = docs.select("doc_id", "text").collect()
    model = toxicity.fit(docs, table(spark, "/root/testdata/sf0.01", "labels"))
    theta = dict(zip(model["words"], model["theta"]))
    p = lambda z: 1 / (1 + math.exp(-z))

    def toxic(text):
        clean = 1 - p(model["leak"])
        for sentence in re.split(r"[.!?\n]+", text or ""):
            words = set(re.findall(r"\w+", sentence.lower()))
            known = {f for w in words for f in [w, *("^" + w[:k] for k in (4, 5, 6, 7) if len(w) > k)]}
            clean *= 1 - p(model["bias"] + sum(theta.get(f, 0.0) for f in known)) if sentence else 1
        return 1 - clean

    found = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert len(theta) > 10 and all(abs(found[r.doc_id] - toxic(r.text)) < 1e-9 for r in rows)

    content = language.dictionaries(docs)

    def sizes(text):
        raw, out = language.letters(text), []
        for lang in content:
            words = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(level=3, dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False)
            out.append(sum(len(coder.compress(raw[i:i + 2_000])) for i in range(0, len(raw), 2_000)))
        return out

    guessed = {r.doc_id: r.lang_pred for r in language.identify(docs, content).collect()}
    for r in rows[::9]:
        if r.text and any(map(str.isalpha, r.text)):
            of = sizes(r.text)
            assert guessed[r.doc_id] == list(content)[of.index(min(of))]
        else:
            assert guessed[r.doc_id] == "und"


def test_each_sampled_document_teaches_alike(spark):
    assert language.even_limit([5, 1, 9], 100) == 9 and language.even_limit([], 7) == 0
    assert language.even_limit([10, 1, 10, 10], 22) == 7 and language.even_limit([4, 4], 3) == 1
    # Three hundred long texts, a short one, one text in many rows, and languages beyond the limit.
    rows = [(i, f"word{'abcdefghij'[i % 10] * 9}{chr(97 + i // 10 % 26)} " * 2000, "xx") for i in range(300)] + [(900, "short", "xx")]
    rows += [(901, "same words everywhere", "yy")] * 500 + [(None, None, "zz"), (5, "text", None)]
    rows += [(1000 + i, "more", f"lang{i:03d}") for i in range(250)]
    content = language.dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(content) <= language.LANGUAGES and {"xx", "yy"} <= set(content) and list(content)[0] == "yy"
    assert content["yy"] == b"same words everywhere"
    parts = content["xx"].split(b"\n")
    assert 200 <= len(parts) and 0.95 * language.DICTIONARY < len(content["xx"]) <= language.DICTIONARY
    assert len({len(p) for p in parts if p != b"short"}) == 1


@pytest.mark.parametrize("texts", [["x"] * 4, [""] * 4, ["a.b!c\nd"] * 4])
def test_training_on_texts_without_signal(texts):
    model = toxicity.train(texts, np.array([0, 1, 0, 1]), np.ones(4))
    assert model["words"] == [] and 0 < toxicity.scorer(model)("anything", 0.3)[0] < 1
