"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

Every window of ``width`` words is hashed where its document is read. The hashes go to
buckets by their leading bits, packed by run of documents: seven bytes of hash, the word position as a gap
from the one before, and a short list of the documents. A bucket's task sorts its hashes;
of equal ones, all but the earliest (smallest doc_id, then smallest position) are
repeats. Repeated positions return to their documents, where overlapping windows merge into
maximal intervals that are removed.

Of windows that repeat within a run of documents only the earliest carries its hash to the bucket,
so a passage found in a third of all documents arrives once per run. The number of buckets
follows the input's size: about ``BUCKET_WINDOWS`` windows each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keeprate.llm import rolling
from keeprate.llm.rolling import from_planes, planes
from keeprate.session import settled

BUCKET_WINDOWS = 3_000_000
GROUP_BYTES = 12_000_000  # of text that one task joins with its repeats
MOST_REPEATED = 100_000  # repeated ids that are sent to all tasks
NO_ID = np.iinfo(np.int64).max  # stands for a null id, which comes after all others


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key, tag): ``key`` stands for the id, ``tag`` is the text's hash where rows share an id, else 0.

    Key and tag together name a text; groups by both of them spread the rows of one id, or of no id, over the tasks.
    """
    keyed = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("key"))
    repeated = settled(keyed.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("of"), "repeated-ids")
    count, own = repeated.count(), F.xxhash64("text")
    if not count:
        return keyed.withColumn("tag", F.lit(0).cast("long"))
    if count > MOST_REPEATED:
        return keyed.withColumn("tag", own)
    marked = keyed.join(F.broadcast(repeated), F.col("key") == F.col("of"), "left")
    return marked.withColumn("tag", F.when(F.col("of").isNotNull(), own).otherwise(F.lit(0).cast("long"))).drop("of")


def grouped_by(groups: int) -> Column:
    """The group of a text, by key and tag; tasks compute the same."""
    return F.pmod(F.col("key").bitwiseXOR(F.col("tag")), F.lit(groups))


def _packed(ids, tags, place, position) -> dict:
    """Documents with entries, their counts, and gaps of positions; entries are in document order."""
    used, counts = np.unique(place, return_counts=True)
    gaps = np.diff(position, prepend=0)
    gaps[np.cumsum(counts) - counts] = position[np.cumsum(counts) - counts]
    return {"ids": planes(np.diff(ids[used], prepend=0)), "tags": planes(tags[used]),
            "counts": planes(counts.astype(np.uint32)), "gaps": planes(gaps.astype(np.uint32))}


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, tag, position) of each entry."""
    counts = from_planes(row.counts, "<u4").astype(np.int64)
    gaps = from_planes(row.gaps, "<u4").astype(np.int64)
    walked = np.cumsum(gaps)
    first = np.cumsum(counts) - counts
    walked -= np.repeat(walked[first] - gaps[first], counts)
    ids = np.cumsum(from_planes(row.ids, "<i8"))
    return np.repeat(ids, counts), np.repeat(from_planes(row.tags, "<i8"), counts), walked


def _earliest(order_by: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """True where no entry of the same hash comes before in (id, position)."""
    position, ids = order_by
    order = np.lexsort((position, ids, hashes))
    h, i, p = hashes[order], ids[order], position[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    out = np.empty(len(h), bool)
    out[order] = (i == i[lead]) & (p == p[lead])
    return out


BUCKETED = "bucket int, ids binary, tags binary, counts binary, gaps binary, first binary, hashes binary"
REPEATS = "grp long, ids binary, tags binary, counts binary, gaps binary"


def repeats(docs: DataFrame, width: int, bits: int, groups: int) -> DataFrame:
    """Packed positions of repeated windows by document group; docs: (key, text, tag)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, marks = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            for row, end, data, offsets in rolling.chunks(batch.column(1)):
                starts, ends, first = rolling.words(data, offsets)
                h = rolling.rolling(rolling.word_hashes(data, starts, ends), width, rolling.WORD_BASE)
                count = np.maximum(np.diff(first) - width + 1, 0)
                if not count.sum():
                    continue
                ids, tags = every[row:end], marks[row:end]
                place = np.repeat(np.arange(end - row), count)
                position = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
                h = h[np.repeat(first[:-1], count) + position]
                earliest = _earliest([position, ids[place]], h)
                bucket = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
                rows = []
                for b in range(1 << bits):
                    mine = order[edges[b]:edges[b + 1]]
                    if len(mine):
                        short = h[mine][earliest[mine]]
                        rows.append({"bucket": b, **_packed(ids, tags, place[mine], position[mine]),
                                     "first": np.packbits(earliest[mine]).tobytes(),
                                     "hashes": short.view(np.uint8).reshape(-1, 8)[:, :7].tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema=BUCKET_SCHEMA)

    def found(frame: pd.DataFrame) -> pd.DataFrame:
        ids, tags, position, known, hashes = [], [], [], [], []
        for row in frame.itertuples():
            i, t, p = _unpacked(row)
            first = np.unpackbits(np.frombuffer(row.first, np.uint8), count=len(p)).astype(bool)
            h = np.zeros((int(first.sum()), 8), np.uint8)
            h[:, :7] = np.frombuffer(row.hashes, np.uint8).reshape(-1, 7)
            for whole, part in ((ids, i), (tags, t), (position, p), (known, first), (hashes, h.view(np.uint64).reshape(-1))):
                whole.append(part)
        ids, tags, position, known = (np.concatenate(x) for x in (ids, tags, position, known))
        repeated = ~known
        repeated[known] = ~_few_earliest([position[known], ids[known]], np.concatenate(hashes))
        ids, tags, position = ids[repeated], tags[repeated], position[repeated]
        group = (ids ^ tags) % groups
        order = np.lexsort((position, tags, ids, group))
        ids, tags, position, group = ids[order], tags[order], position[order], group[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])
        place = np.cumsum(new) - 1
        edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]]) if len(group) else np.array([0])
        rows = []
        for a, b in zip(edges[:-1], edges[1:]):
            own = place[a:b] - place[a]
            head = np.flatnonzero(new[a:b]) + a
            rows.append({"grp": int(group[a]), **_packed(ids[head], tags[head], own, position[a:b])})
        return pd.DataFrame(rows, columns=["grp", "ids", "tags", "counts", "gaps"])

    return docs.mapInArrow(hashed, BUCKETED).groupBy("bucket").applyInPandas(found, REPEATS)


BUCKET_SCHEMA = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("ids", "tags", "counts", "gaps", "first", "hashes"))])


def _few_earliest(order_by: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """``_earliest`` that sorts positions only of hashes that occur twice."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    twin = np.zeros(len(h), bool)
    twin[1:] = h[1:] == h[:-1]
    twin[:-1] |= twin[1:].copy()
    several = order[twin]
    out = np.ones(len(hashes), bool)
    out[several] = _earliest([x[several] for x in order_by], hashes[several])
    return out


def _prime(least: int) -> int:
    n = max(2, least)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def dedup(spark: SparkSession, docs: DataFrame, width: int = 20) -> DataFrame:
    """(doc_id, n_words, removed, kept) for every row.

    Words are what stands between ASCII blanks. Each word covered by a window of ``width``
    words that also starts earlier (smaller doc_id, or same document and earlier) is removed;
    windows are judged on the input. ``removed`` lists the maximal (start, end) word intervals,
    end exclusive, ``kept`` is the rest joined by one blank.

    Null and empty texts and texts shorter than a window lose nothing (null: no word, kept
    empty). A null doc_id comes after all others; rows that share an id and a position do not
    count as earlier than each other, so repeated rows keep the same words. Only doc_id and text
    are read. An empty table gives an empty result. Equality is that of 56 bits and the bucket's
    bits of a hash, and of 64 bits for words; ``width`` is 512 at most.
    """
    if not 1 <= width <= rolling.WIDEST:
        raise ValueError(f"width must be from 1 to {rolling.WIDEST}")
    docs = identified(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(size / 6 / BUCKET_WINDOWS, 1)))))
    groups = _prime(size // GROUP_BYTES)
    flagged = repeats(docs.select("key", "text", "tag"), width, bits, groups)

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known: dict[tuple, list] = {}
        for row in right.itertuples():
            ids, tags, position = _unpacked(row)
            edges = np.concatenate([[0], np.flatnonzero((np.diff(ids) != 0) | (np.diff(tags) != 0)) + 1, [len(ids)]])
            for a, b in zip(edges[:-1], edges[1:]):
                known.setdefault((int(ids[a]), int(tags[a])), []).append(position[a:b])
        rows = []
        for key, tag, doc_id, text in zip(left["key"], left["tag"], left["doc_id"], left["text"]):
            raw = (text or "").encode()
            parts, gone = raw.split(), []
            mine = known.get((int(key), int(tag)))
            n = len(parts)
            if mine:
                covered = rolling.cover(np.concatenate(mine), width, n)
                gone = [{"start": int(a), "end": int(b)} for a, b in rolling.runs(covered)]
                parts = [parts[i] for i in np.flatnonzero(~covered)]
            rows.append((doc_id, n, gone, b" ".join(parts).decode()))
        return pd.DataFrame(rows, columns=["doc_id", "n_words", "removed", "kept"]).astype({"doc_id": "Int64"})

    grouped = docs.withColumn("grp", grouped_by(groups))
    return grouped.groupBy("grp").cogroup(flagged.groupBy("grp")).applyInPandas(
        cut, "doc_id long, n_words long, removed array<struct<start:int,end:int>>, kept string")


def digest(result: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + (r["end"] - r["start"]))
    return result.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
