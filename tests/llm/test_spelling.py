"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keeprate.llm import spelling


def edits(word: str, letters: str) -> set[str]:
    cut = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in letters} | {a + c + b for a, b in cut for c in letters}
    return out - {word}


def brute(counts: dict[str, int], times: int = 10) -> list[tuple]:
    letters = "".join(sorted({c for w in counts for c in w}))
    near = {w: [x for x in edits(w, letters) if x in counts] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out, key=str)


def vocabulary(seed: int, count: int = 500) -> dict[str, int]:
    """Words of 7 to 30 letters with many variants, common beginnings and ends, and chains of counts."""
    rng = random.Random(seed)
    syllables = ["an", "ber", "ti", "on", "é", "ing", "ser", "to", "aa", "ßl", "re", "com"]
    out = {}
    while len(out) < count:
        word = "".join(rng.choice(syllables) for _ in range(rng.randint(4, 9)))
        if len(word) >= 7:
            out[word] = rng.choice([2, 3, 20, 200, 5000])
    for word in list(out):
        for _ in range(rng.randint(0, 6)):
            near = rng.choice(sorted(edits(word, "abntè")))
            if len(near) >= 7:
                out.setdefault(near, rng.choice([2, 2, 3, 30, 400]))
    return out


def grouped(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, spelling.group(spark, df.repartition(3)).collect()), key=str)


@pytest.mark.parametrize("hot", [1, 4, 64])
def test_variants(spark, monkeypatch, hot):
    """With every list split, some, and nearly none."""
    monkeypatch.setattr(spelling, "HOT", hot)
    counts = vocabulary(1)
    got = grouped(spark, counts)
    assert got == brute(counts) and sum(r[4] > 0 for r in got) > 300 and any(r[2] not in (r[0], r[1]) for r in got)


def test_place_by_place(spark, monkeypatch):
    """Words are compared as long ones are."""
    monkeypatch.setattr(spelling, "LONG", 3)
    counts = vocabulary(4, 200)
    assert grouped(spark, counts) == brute(counts)


def test_pruned_dictionary(spark, monkeypatch):
    """A dictionary that prunes nearly every short gram, and one that prunes none."""
    counts = vocabulary(2, 200)
    for frequent in (1, 1_000_000):
        monkeypatch.setattr(spelling, "FREQUENT", frequent)
        assert grouped(spark, counts) == brute(counts)


def test_every_edit_leaves_a_list():
    """At every level, any edit of any word shares a merged list with the word."""
    rng = random.Random(3)
    pruned = {}
    words = ["".join(rng.choice("abc") for _ in range(n)) for n in range(7, 20) for _ in range(6)]
    for size, h, there in spelling.Flat(words, spelling.level_of(np.array([len(w) for w in words]))).grams():
        for x in h[there]:
            if rng.random() < 0.5:
                pruned[x] = True
    names = np.array(sorted(pruned), np.uint64)

    def listed(word, shorter):
        return {int(key[0]) for key, _, _ in spelling.entries([word], len(word) > shorter, names)}

    for word in words:
        for other in edits(word, "abz"):
            if len(other) >= 7:
                shorter = min(len(word), len(other))
                assert listed(word, shorter) & listed(other, shorter), (word, other)


def test_words_of_documents(spark, corpus, rows, nothing):
    want = Counter()
    for doc_id, text, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    counted = spelling.counted(spelling.perturbed_words(corpus))
    assert {r.word: r.n for r in counted.collect()} == want
    assert sorted(map(tuple, spelling.group(spark, counted).collect()), key=str) == brute(want)
    assert spelling.group(spark, spelling.counted(spelling.perturbed_words(nothing))).collect() == []


def test_very_long_words(spark):
    """Runs without a blank; only a word twice counts."""
    long = "ab" * 20_000
    docs = spark.createDataFrame([(1, long + " x " + long), (2, f"{long}a {long}a"), (3, None), (None, "once only letters")], "doc_id long, text string")
    got = {r.word: r for r in spelling.group(spark, docs.select(F.explode(spelling.runs(F.col("text"))).alias("word")).transform(spelling.counted)).collect()}
    assert {len(w): r.n_near for w, r in got.items()} == {40_000: 1, 40_001: 1}
    assert all(r.form is None and r.root == w for w, r in got.items())


def test_times_must_end_chains(spark):
    with pytest.raises(ValueError):
        spelling.group(spark, spark.createDataFrame([], "word string, n long"), 1)
