"""Toxicity by multiple-instance learning.

A document is a bag of sentences; it is toxic if at least one of them is. Each sentence
has a probability from a logistic model of its words
and word beginnings, and a document's score is the noisy-or
``1 - (1 - leak) * prod(1 - p_sentence)``. Only documents carry labels; the gradient of
the noisy-or shares a document's label among its sentences, so the trained model
also tells which sentences offend.

Training reads a bounded sample: of each label at most ``SAMPLE`` documents, the ones
whose hashed ids are smallest, weighted back to the label's count over all labelled rows.
It runs in one executor task on that sample. Scoring reads every document whole, in
Arrow batches, and needs no shuffle; the model that goes to the tasks has at most
``VOCABULARY`` words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from keeprate.llm.common import col, fresh, held_out

SAMPLE = 4_000
VOCABULARY = 20_000
ROUNDS = 200
SLOTS = 1 << 21
CACHED = 100_000  # words whose features a task remembers
SENTENCE = re.compile(r"[^.!?\n]+")
TOKEN = re.compile(r"\w+")
PREFIXES = (4, 5, 6, 7)  # inflected and compound words share their beginning


def features(word: str) -> list[str]:
    """The word itself and its beginnings, marked by ``^``."""
    return [word, *(f"^{word[:k]}" for k in PREFIXES if len(word) > k)]


def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % SLOTS


def sentences(text: str | None) -> Iterator[set[str]]:
    """The features of each sentence."""
    for sentence in SENTENCE.findall(text or ""):
        yield {f for w in set(TOKEN.findall(sentence.lower())) for f in features(w)}


def train(texts: list[str], labels: np.ndarray, weights: np.ndarray) -> dict:
    """Words with their weights, the sentence bias and the leak, from labelled texts."""
    # Documents with a feature by label, counted in slots, so that memory does not follow the vocabulary.
    seen = np.zeros((2, SLOTS), np.int32)
    for text, label in zip(texts, labels):
        seen[int(label), list({_slot(f) for sentence in sentences(text) for f in sentence})] += 1
    n = np.array([max((labels == 0).sum(), 1), max((labels == 1).sum(), 1)], dtype=float)
    rates = (seen + 0.5) / (n[:, None] + 1)
    strength = np.abs(rates[1] - rates[0]) / np.sqrt((rates * (1 - rates) / n[:, None]).sum(axis=0))
    strength[seen.sum(axis=0) < 5] = 0
    chosen = np.argsort(-strength, kind="stable")[:VOCABULARY]
    chosen = set(chosen[strength[chosen] > 3.5].tolist())
    words = {f for text in texts for sentence in sentences(text) for f in sentence if _slot(f) in chosen}
    words = sorted(sorted(words, key=lambda f: (-strength[_slot(f)], f))[:VOCABULARY])
    place = {w: i for i, w in enumerate(words)}
    del seen, rates, strength
    rows, columns, owners, count = [], [], [], np.zeros(len(texts))
    for d, text in enumerate(texts):
        for sentence in sentences(text):
            count[d] += 1
            known = sorted(place[w] for w in sentence if w in place)
            if known:  # other sentences all have the bias alone and are counted below
                columns.extend(known)
                rows.extend([len(owners)] * len(known))
                owners.append(d)
    rows, columns, owners = np.array(rows, int), np.array(columns, int), np.array(owners, int)
    plain = count - np.bincount(owners, minlength=len(texts))
    theta, bias, leak = np.zeros(len(words)), -4.0, -3.0
    y, w = labels.astype(float), weights / weights.sum()
    moments = [np.zeros(len(words) + 2), np.zeros(len(words) + 2)]
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for step in range(1, ROUNDS + 1):
        z = bias + np.bincount(rows, theta[columns], minlength=len(owners))
        p, p0, q = sigmoid(z), sigmoid(bias), sigmoid(leak)
        none = np.bincount(owners, np.log1p(-p), minlength=len(texts)) + plain * np.log1p(-p0) + np.log1p(-q)
        score = np.clip(-np.expm1(none), 1e-9, 1 - 1e-9)
        # d loss / d none, where none is the log of the chance that nothing offends.
        push = w * (y * (1 - score) / score - (1 - y))
        by_sentence = push[owners] * p
        slope = np.concatenate([
            -np.bincount(columns, by_sentence[rows], minlength=len(words)) + 1e-5 * theta,
            [-(by_sentence.sum() + (push * plain).sum() * p0), -push.sum() * q],
        ])
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        move = 0.2 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        # The slope is that of the log-likelihood with its sign turned: it is descended.
        theta, bias, leak = theta - move[:-2], bias - move[-2], leak - move[-1]
    return {"words": words, "theta": theta.tolist(), "bias": float(bias), "leak": float(leak)}


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The model from the rows of ``labels`` (doc_id, toxic) that are not held out.

    Rows with a null id or label are left out; of several labels for one id the toxic one counts. Without both labels in the rest there is
    nothing to learn: the score is then the share of toxic rows for every text.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2)).select(
        "doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows at most
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    if len(counts) < 2:
        level = min(max(share, 0.01), 0.99)
        return {"words": [], "theta": [], "bias": -30.0, "leak": float(np.log(level / (1 - level)))}
    chosen = [known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for label in (0, 1)]
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").withColumn("one", F.lit(1))

    def one_group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "text"])
        label = frame["toxic"].to_numpy()
        sizes = {k: max((label == k).sum(), 1) for k in (0, 1)}
        weights = np.array([counts[int(k)] / sizes[int(k)] for k in label])
        model = train(frame["text"].tolist(), label, weights)
        return pd.DataFrame({"words": [model["words"]], "theta": [model["theta"]], "bias": [model["bias"]], "leak": [model["leak"]]})

    rows = sample.groupBy("one").applyInPandas(one_group, "words array<string>, theta array<double>, bias double, leak double").collect()
    if not rows:  # the labelled documents are not in the table
        return {"words": [], "theta": [], "bias": -30.0, "leak": float(np.log(share / (1 - share)))}
    return rows[0].asDict()


def scorer(model: dict):
    """A function from a text to (score, offending sentences as (start, end, probability))."""
    theta = dict(zip(model["words"], model["theta"]))
    by_word: dict[str, tuple[str, ...]] = {}
    sigmoid = lambda x: 1 / (1 + np.exp(-min(max(x, -30.0), 30.0)))
    plain, leak = np.log1p(-sigmoid(model["bias"])), np.log1p(-sigmoid(model["leak"]))

    def score(text: str | None, least: float):
        none, offending = leak, []
        for found in SENTENCE.finditer(text or ""):
            known = set()
            for word in TOKEN.findall(found.group().lower()):
                if word not in by_word:
                    if len(by_word) >= CACHED:
                        by_word.clear()
                    by_word[word] = tuple(f for f in features(word) if f in theta)
                known.update(by_word[word])
            if not known:
                none += plain
                continue
            p = sigmoid(model["bias"] + sum(theta[w] for w in sorted(known)))
            none += np.log1p(-p)
            if p >= least:
                offending.append((found.start(), found.end(), float(p)))
        return float(min(max(-np.expm1(none), 0.0), 1.0)), offending

    return score


SPANS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("probability", T.DoubleType())]))


def scored(docs: DataFrame, model: dict, least: float = 0.3, score_name: str = "score", spans_name: str = "offending") -> DataFrame:
    """All columns of ``docs`` with the score and the offending sentences added.

    Needs a column text. A null or empty text has no sentence; its score is the leak, the chance
    that a text without a known word is labelled toxic. Offsets count code points, end
    exclusive. Rows keep their other columns; where one has an added column's name, that gets a
    leading underscore. Equal texts have equal scores. An empty table stays empty.
    """
    score_name, spans_name = fresh(docs, score_name, spans_name)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_name, T.DoubleType()), T.StructField(spans_name, SPANS)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
    at = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for batch in batches:
            found = [score(t, least) for t in batch.column(at).to_pylist()]
            spans = [[{"start": s, "end": e, "probability": p} for s, e, p in x] for _, x in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], pa.float64()), pa.array(spans, kind)],
                [*batch.schema.names, score_name, spans_name])

    return docs.mapInArrow(add, schema)


def keep_clean(spark: SparkSession, docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """Documents whose score is below ``least``, with the columns they came with."""
    score, spans = fresh(docs, "score", "offending")
    model = fit(docs, labels)
    return scored(docs, model, least, score, spans).filter(col(score) < least).select(*[col(c) for c in docs.columns])
