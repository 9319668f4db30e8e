"""Language identification by compression with per-language zstandard dictionaries.

Each language's dictionary is raw content: text of that language's training documents. A
text is compressed block by block with each of them, and the smallest sum of sizes wins;
where the runner-up is nearly as small, the text is rejected (the guess stays visible).

The dictionaries come from a bounded sample: about ``SAMPLE`` documents a language, chosen by
the hash of id and text, which share ``DICTIONARY`` bytes evenly: each gives as much as the others, and what
short ones leave goes to the rest. Its part of a document starts where a hash says. At most ``LANGUAGES``
languages are learned, those with most documents. The dictionaries are the only thing that is sent to
the tasks. Every text is compressed whole; nothing but the sample is shuffled.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from keeprate.llm.common import held_out

SAMPLE = 400  # documents a language, as expected
DICTIONARY = 100_000  # bytes a language
PIECE = 4_000  # bytes of a training document at most
LANGUAGES = 200
BLOCK = 2_000  # bytes compressed at a time, so that the dictionary stays what matches
LEVEL = 3
MARGIN = 0.02
APART = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """Lower-case letters, everything between them one blank: what the language shows in."""
    return APART.sub(" ", text.lower()).strip().encode()


def piece(text: str) -> bytes:
    """At most ``PIECE`` bytes of a text's letters, from a place that a hash of them tells."""
    raw = letters(text)
    start = zlib.crc32(raw) % max(len(raw) - PIECE + 1, 1)
    return raw[start:start + PIECE]


def even_limit(sizes: list[int], total: int) -> int:
    """The largest limit at which the sizes, cut to it, sum to ``total`` at most."""
    left = total
    for i, size in enumerate(sorted(sizes)):
        if size * (len(sizes) - i) > left:
            return left // (len(sizes) - i)
        left -= size
    return max(sizes, default=0)


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Dictionary text by language, from the documents that are not held out.

    Rows with a null or empty text or a null language teach nothing.
    """
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("text").isNotNull() & (F.col("text") != "") & F.col("lang").isNotNull() & ~held_out("doc_id", 5, 0))
    place = F.xxhash64("doc_id", "text")
    counts = known.groupBy("lang").agg(
        F.count("*").alias("n"), F.approx_count_distinct(place).alias("different")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    share = F.pmod(place, F.lit(1 << 20)) < F.ceil(F.lit(float(SAMPLE) * (1 << 20)) / F.col("different"))
    sample = known.join(F.broadcast(counts), "lang").filter(share).select("lang", "n", place.alias("place"), "text")

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(text=[piece(t) for t in frame["text"]]).rename(columns={"text": "piece"})

    # Equal rows are one document, so a text that comes often is no larger group.
    sample = sample.mapInPandas(pieces, "lang string, n long, place long, piece binary").distinct()

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        parts = frame["piece"].drop_duplicates().tolist()
        limit = even_limit([len(x) + 1 for x in parts], DICTIONARY + 1) - 1
        content = b"\n".join(x[:limit] for x in parts)
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "content": [content], "n": [int(frame["n"].iloc[0])]})

    rows = sample.groupBy("lang").applyInPandas(gather, "lang string, content binary, n long").collect()  # one a language
    return {r.lang: bytes(r.content) for r in sorted(rows, key=lambda r: (-r.n, r.lang))}


def identify(docs: DataFrame, content: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row.

    ``lang_pred`` is ``und``, with score 0 and rejected, for null texts, texts without a letter, and
    where no language was learned. ``score`` is the winner's share when each language weighs
    by its size, from 0 to 1; ``rejected`` tells that the runner-up is within ``margin``
    of it. Ties go to the language with more training documents. Repeated rows get equal
    results, a null doc_id stays null, other columns are not read, an empty table gives none.
    """
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        languages = list(content)
        coders = []
        for lang in languages:
            words = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            coders.append(zstandard.ZstdCompressor(
                dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False))

        def guess(text: str | None):
            if not languages or not text or not any(map(str.isalpha, text)):
                return "und", 0.0, True
            raw = letters(text)
            sizes = np.zeros(len(languages))
            for i in range(0, len(raw), BLOCK):
                block = raw[i:i + BLOCK]
                sizes += [len(c.compress(block)) for c in coders]
            best = int(sizes.argmin())
            if len(sizes) == 1:
                return languages[0], 1.0, False
            second = float(np.partition(sizes, 1)[1])
            weight = np.exp(-(sizes - sizes[best]) / (0.02 * sizes[best] + 1))
            return languages[best], float(1 / weight.sum()), bool(second - sizes[best] < margin * sizes[best])

        for batch in batches:
            found = [guess(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
