from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed: int = 5) -> list[tuple]:
    """Documents with copies, near copies, shared passages, nulls, empty and long texts, repeated and null ids."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        out = []
        for i in range(n):
            out.append(rng.choice(words) + rng.choice(["", "", "", ".", ","]))
        return "".join(w + rng.choice([" ", " ", " ", "\n"]) for w in out).strip()

    def near(text, edits):
        parts = text.split(" ")
        for _ in range(edits):
            parts[rng.randrange(len(parts))] = rng.choice(words).upper()
        return " ".join(parts)

    passage = prose(60)
    base = [prose(rng.randint(30, 150)) for _ in range(25)]
    rows = list(base)
    rows += [rng.choice(base) for _ in range(8)]  # exact copies
    rows += [near(rng.choice(base), rng.randint(1, 5)) for _ in range(14)]
    hub = prose(200)
    rows += [hub] + [near(hub, k) for k in range(1, 12)]  # a group around one text
    rows += [prose(20) + "\n" + passage + "\n" + prose(25) for _ in range(6)]
    rows += [prose(3000), "", " \n\t", "word", "two words", "two words", "Two  WORDS", None, "the " * 120, "\n" * 5, "ab" * 300, "same line\n" * 30]
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(t or "")) for i, t in enumerate(rows)]
    rng.shuffle(out)
    out.append(out[3])  # a repeated row
    out.append((out[5][0], prose(40), "en", "a", 1))  # a repeated id with another text
    out.append((None, rows[0], None, None, None))
    out.append((None, None, None, None, None))
    return out


CLASHING = ["key", "grp", "size", "score", "h", "text_hash", "lines", "removed", "copies", "class", "bucket", "row", "target"]


@pytest.fixture(scope="session")
def corpus(spark):
    """The documents, with extra columns whose names the operators use inside."""
    df = spark.createDataFrame(texts(), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("extra") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return texts()
