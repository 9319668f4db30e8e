"""Suffix-array dedup of long byte strings by threshold-bounded interval expansion.

A Burrows-Wheeler interval holds the suffixes that begin with one string; extending it backwards
by the byte before each suffix splits it. Expanding breadth first gives the common
prefixes by increasing length, and no interval needs to grow beyond the least length L.

Expanding from the empty string would sort all text. But every string of L bytes holds an
anchor: of its k-byte pieces the one with the smallest hash, the leftmost of equals. Equal strings have
equal anchors at equal places. So the expansion starts at the intervals of the anchors that
occur more than once, and each string is looked for in its own anchor's interval only:

1. Each document gives its anchors, about two for every L - k bytes, with a hash of the
   text around each that its strings reach. They go packed to buckets by anchor.
2. Anchors that occur once are done; so are those whose whole surroundings are repeated. The
   surroundings of the rest are fetched from their documents.
3. In each interval the suffixes that start at the anchor are sorted, with the common prefixes
   of neighbours. Breadth-first backward extension splits the intervals byte by byte; at x bytes, a
   string is repeated if a neighbour in its interval agrees for the L - x bytes that remain. After
   L - k steps all strings are decided.
4. Repeated strings return to their documents, which lose the bytes that they cover.

An interval with more than ``HOT`` suffixes (a line in a third of all documents) is expanded in
parts, and its strings are then also counted by hash across the parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from keeprate.llm import rolling
from keeprate.llm.rolling import BYTE_BASE, planes
from keeprate.llm.windows import GROUP_BYTES, _packed, _prime, _unpacked, grouped_by, identified
from keeprate.session import settled

PIECE = 64  # bytes of an anchor
BUCKET_ANCHORS = 1_000_000
PART_SUFFIXES = 30_000  # expanded together in one task
HOT = PART_SUFFIXES


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each run of ``width`` values: running minima from both ends of blocks."""
    n = len(values)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray, offsets: np.ndarray, least: int):
    """For each run of strings with one anchor: row, first string, lead to the anchor, last string less first, anchor hash, surroundings hash."""
    n = len(data)
    width = least - PIECE + 1
    none = np.zeros(0, np.int64)
    if n < least:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    back = rolling.powers_for(rolling.inverse(BYTE_BASE), n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * rolling.powers_for(BYTE_BASE, n), out=sums[1:])
    piece = (sums[PIECE:] - sums[:-PIECE]) * back[: n - PIECE + 1]
    order = (piece * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
    at = sliding_min((order << np.uint64(32)) | np.arange(len(piece), dtype=np.uint64), width) & np.uint64(0xFFFFFFFF)
    lengths = np.diff(offsets)
    count = np.maximum(lengths - least + 1, 0)  # strings of each row
    row = np.repeat(np.arange(len(lengths)), count)
    if not len(row):  # every text is too short
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(offsets[:-1], count)
    at = at[start].astype(np.int64)
    new = np.ones(len(row), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(row)) - 1
    first, end = start[head], start[last]
    lead, span = at[head] - first, end - first
    around = (sums[end + least] - sums[first]) * back[first]
    around = rolling.mixed(around + (lead * 65_536 + span).astype(np.uint64))
    return row[head], first - offsets[:-1][row[head]], lead, span, rolling.mixed(piece[at[head]]), around


ENTRY = ("ids", "tags", "counts", "gaps", "lead", "span")
BUCKET = ("bucket", *ENTRY, "first", "several", "anchor", "around")
BUCKET_SCHEMA = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in BUCKET[1:])])


def _entries(ids, tags, place, position, lead, span) -> dict:
    return {**_packed(ids, tags, place, position), "lead": lead.astype(np.uint16).tobytes(), "span": span.astype(np.uint16).tobytes()}


def _read(row) -> tuple:
    """(id, tag, first string, lead, span) of each entry."""
    return (*_unpacked(row), np.frombuffer(row.lead, np.uint16).astype(np.int64), np.frombuffer(row.span, np.uint16).astype(np.int64))


def _by_group(kind: str, groups: int, ids, tags, position, lead, span, extra: dict) -> list[dict]:
    """Packed entries by document group."""
    group = (ids ^ tags) % groups
    order = np.lexsort((position, tags, ids, group))
    ids, tags, position, lead, span, group = (x[order] for x in (ids, tags, position, lead, span, group))
    extra = {k: v[order] for k, v in extra.items()}
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])
    place = np.cumsum(new) - 1
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(group)] if len(group) else [0]
    rows = []
    for a, b in zip(edges[:-1], edges[1:]):
        head = np.flatnonzero(new[a:b]) + a
        rows.append({"kind": kind, "grp": int(group[a]), **_entries(
            ids[head], tags[head], place[a:b] - place[a], position[a:b], lead[a:b], span[a:b]),
            **{k: planes(v[a:b]) for k, v in extra.items()}})
    return rows


def judged_anchors(docs: DataFrame, least: int, bits: int, groups: int) -> DataFrame:
    """Packed by document group: anchors whose surroundings are repeated, and those to be expanded."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, marks = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            for row, end, data, offsets in rolling.chunks(batch.column(1)):
                place, position, lead, span, anchor, around = anchors(data, offsets, least)
                if not len(place):
                    continue
                ids, tags = every[row:end], marks[row:end]
                # Equal anchors with equal surroundings are sent once a run of documents.
                order = np.lexsort((around, anchor))
                new = np.ones(len(order), bool)
                new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (around[order][1:] != around[order][:-1])
                first, several = np.empty(len(order), bool), np.empty(len(order), bool)
                first[order] = new
                several[order] = np.repeat(np.diff(np.append(np.flatnonzero(new), len(new))) > 1, np.diff(np.append(np.flatnonzero(new), len(new))))
                bucket = (anchor >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(anchor), np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
                rows = []
                for b in range(1 << bits):
                    mine = order[edges[b]:edges[b + 1]]
                    if len(mine):
                        lone = mine[first[mine]]
                        rows.append({"bucket": b, **_entries(ids, tags, place[mine], position[mine], lead[mine], span[mine]),
                                     "first": np.packbits(first[mine]).tobytes(), "several": np.packbits(several[lone]).tobytes(),
                                     "anchor": anchor[lone].tobytes(), "around": around[lone].tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema=BUCKET_SCHEMA)

    def judged(frame: pd.DataFrame) -> pd.DataFrame:
        entries, first, several, anchor, around = [], [], [], [], []
        for row in frame.itertuples():
            entries.append(_read(row))
            first.append(np.unpackbits(np.frombuffer(row.first, np.uint8), count=len(entries[-1][0])).astype(bool))
            anchor.append(np.frombuffer(row.anchor, np.uint64))
            around.append(np.frombuffer(row.around, np.uint64))
            several.append(np.unpackbits(np.frombuffer(row.several, np.uint8), count=len(anchor[-1])).astype(bool))
        entries = [np.concatenate(x) for x in zip(*entries)]
        first, several, anchor, around = (np.concatenate(x) for x in (first, several, anchor, around))
        order = np.lexsort((around, anchor))
        a, c = anchor[order], around[order]
        new_a, new_c = np.ones(len(a), bool), np.ones(len(a), bool)
        new_a[1:] = a[1:] != a[:-1]
        new_c[1:] = new_a[1:] | (c[1:] != c[:-1])
        of_a, of_c = np.cumsum(new_a) - 1, np.cumsum(new_c) - 1
        met = np.bincount(of_c, 1 + several[order])[of_c] > 1  # surroundings that occur again
        kinds = np.bincount(of_a, new_c)[of_a]  # different surroundings of the anchor
        again, open_ = np.zeros(len(a), bool), np.zeros(len(a), bool)
        again[order] = met
        open_[order] = new_c & (kinds > 1)  # one of each kind is expanded
        # Parts of a hot interval: the number of the kind within its anchor.
        nth = np.cumsum(new_c) - 1
        nth -= nth[np.flatnonzero(new_a)][of_a]
        part, hot = np.zeros(len(a), np.uint32), np.zeros(len(a), np.uint8)
        part[order], hot[order] = nth // HOT, kinds > HOT
        repeated = ~first
        repeated[first] = again
        rows = _by_group("repeated", groups, *(x[repeated] for x in entries), {})
        lone = [x[first][open_] for x in entries]
        rows += _by_group("open", groups, *lone, {"anchor": anchor[open_], "part": part[open_], "hot": hot[open_]})
        return pd.DataFrame(rows, columns=["kind", "grp", *ENTRY, "anchor", "part", "hot"])

    schema = ", ".join(f"{c} {'int' if c == 'bucket' else 'binary'}" for c in BUCKET)
    out = ", ".join(f"{c} binary" for c in (*ENTRY, "anchor", "part", "hot"))
    return docs.mapInArrow(found, schema).groupBy("bucket").applyInPandas(judged, f"kind string, grp long, {out}")


def _known(frame: pd.DataFrame, kind: str) -> dict[tuple, list]:
    """Entries of each (id, tag)."""
    out: dict[tuple, list] = {}
    for row in frame.itertuples():
        ids, tags, position, lead, span = _read(row)
        extra = []
        if kind == "open":
            extra = [rolling.from_planes(row.anchor, "<u8"), rolling.from_planes(row.part, "<u4"), rolling.from_planes(row.hot, "<u1")]
        edges = np.concatenate([[0], np.flatnonzero((np.diff(ids) != 0) | (np.diff(tags) != 0)) + 1, [len(ids)]])
        for a, b in zip(edges[:-1], edges[1:]):
            if b > a:
                out.setdefault((int(ids[a]), int(tags[a])), []).append([x[a:b] for x in (position, lead, span, *extra)])
    return out


def surroundings(grouped, asked, least: int, parts: int) -> DataFrame:
    """The bytes that the strings of each open anchor reach, one row per anchor."""

    def fetch(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known, rows = _known(right, "open"), []
        for key, tag, text in zip(left["key"], left["tag"], left["text"]):
            own = int(key), int(tag)
            if own not in known:
                continue
            raw = (text or "").encode()
            for position, lead, span, anchor, part, hot in known.pop(own, []):  # equal rows give one
                for s, l, n, a, p, h in zip(*(x.tolist() for x in (position, lead, span, anchor, part, hot))):
                    rows.append((int((a + p * 0x9E3779B1) % parts), a - (1 << 64) if a >= 1 << 63 else a, p, bool(h), *own, s, l, n, raw[s:s + n + least]))
        return pd.DataFrame(rows, columns=["bin", "anchor", "part", "hot", "key", "tag", "first", "lead", "span", "content"])

    return grouped.cogroup(asked.groupBy("grp")).applyInPandas(
        fetch, "bin long, anchor long, part long, hot boolean, key long, tag long, first long, lead int, span int, content binary")


def expand(anchor: np.ndarray, lead: np.ndarray, span: np.ndarray, content: list[bytes], least: int) -> np.ndarray:
    """Which strings are repeated: a row for each suffix, a column for each number of bytes before the anchor.

    All intervals of the bin are expanded together, breadth first.
    """
    n, width = len(anchor), least - PIECE + 1
    after, before = np.zeros((n, least), np.uint8), np.zeros((n, width), np.uint8)
    for i, (l, raw) in enumerate(zip(lead, content)):
        data = np.frombuffer(raw, np.uint8)
        tail = data[l:l + least]
        after[i, :len(tail)] = tail
        before[i, :l] = data[:l][::-1]
    # The suffix array of the suffixes that start at the anchors, and their common prefixes.
    order = np.argsort(after.view(f"V{least}").reshape(-1), kind="stable")
    order = order[np.argsort(anchor[order], kind="stable")]
    anchor, lead, span, after, before = anchor[order], lead[order], span[order], after[order], before[order]
    common = np.zeros(n, np.int64)
    if n > 1:
        differ = after[1:] != after[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), least)
        common[1:][anchor[1:] != anchor[:-1]] = -1
    common[0] = -1
    out = np.zeros((n, width), bool)
    interval = np.cumsum(common < 0) - 1
    alive = np.arange(n)
    for x in range(width):
        if x:  # extend backwards: split each interval by the byte before
            longer = lead[alive] >= x
            alive = alive[longer]
            if not len(alive):
                break
            interval = np.unique(interval[longer] * 256 + before[alive, x - 1], return_inverse=True)[1]
        judged = lead[alive] - span[alive] <= x
        # Suffixes that agree for the bytes that remain stand together in the array.
        agree = np.cumsum(common < least - x)[alive]
        together = interval[judged] * (n + 1) + agree[judged]
        _, back, count = np.unique(together, return_inverse=True, return_counts=True)
        out[alive[judged], x] = count[back] > 1
    result = np.empty_like(out)
    result[order] = out
    return result


RUNS = "grp long, key long, tag long, low long, high long"


def expanded(open_: DataFrame, least: int, groups: int) -> DataFrame:
    """Runs (low to high) of repeated strings of a document, found within the parts of intervals."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(frame):
            whole = (frame["anchor"].to_numpy().astype(np.uint64) + frame["part"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            lead, span, content = frame["lead"].to_numpy(), frame["span"].to_numpy(), frame["content"].tolist()
            found = expand(whole, lead, span, content, least)
            cells = zip(frame["key"].tolist(), frame["tag"].tolist(), frame["first"].tolist(), lead.tolist(), span.tolist(), found)
            for key, tag, first, l, n, flags in cells:
                for a, b in rolling.runs(flags[l - n:l + 1][::-1]):  # by string, in the document's order
                    rows.append(((key ^ tag) % groups, key, tag, first + int(a), first + int(b) - 1))
        return pd.DataFrame(rows, columns=["grp", "key", "tag", "low", "high"])

    return open_.groupBy("bin").applyInPandas(run, RUNS)


def across_parts(open_: DataFrame, least: int, groups: int) -> DataFrame:
    """Repeated strings of the intervals that were expanded in parts, by hash: runs of one string."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["content"], np.uint8).astype(np.uint64) + np.uint64(1)
                found = rolling.rolling(data, least, BYTE_BASE).astype(np.int64)
                n = len(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, (row["key"] ^ row["tag"]) % groups)), pa.array(np.full(n, row["key"])), pa.array(np.full(n, row["tag"])),
                    pa.array(row["first"] + np.arange(n)), pa.array(found)], ["grp", "key", "tag", "low", "string"])

    hot = open_.filter("hot").select("key", "tag", "first", "content").mapInArrow(
        strings, "grp long, key long, tag long, low long, string long")
    twice = hot.groupBy("string").agg(F.count("*").alias("times")).filter(F.col("times") > 1).select("string")
    return hot.join(twice, "string").select("grp", "key", "tag", "low", F.col("low").alias("high"))


def dedup(spark: SparkSession, docs: DataFrame, least: int = 200) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) for every row.

    A text is its UTF-8 bytes, and no string crosses documents. Each byte covered by a string of ``least`` bytes
    that also starts anywhere else, in the same document too, is removed; all occurrences go. ``removed``
    lists the maximal (start, end) runs, end exclusive, ``kept`` is the rest as bytes.

    Null and empty texts and texts under ``least`` bytes lose nothing (null: no byte). Repeated rows are
    occurrences of each other, whatever their ids; null ids are allowed. Only doc_id and text are read. Very long texts
    are read whole. An empty table gives an empty result. Equality of whole surroundings and of
    strings across parts is that of 64-bit hashes; expansion compares bytes. ``least`` is from 65 to 512.
    """
    if not PIECE < least <= rolling.WIDEST:
        raise ValueError(f"least must be from {PIECE + 1} to {rolling.WIDEST}")
    docs = identified(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(size * 2 / (least - PIECE) / BUCKET_ANCHORS, 1)))))
    groups = _prime(size // GROUP_BYTES)
    entries = settled(judged_anchors(docs.select("key", "text", "tag"), least, bits, groups), "anchors")
    asked, repeated = entries.filter(F.col("kind") == "open"), entries.filter(F.col("kind") == "repeated")
    waiting = asked.agg(F.sum(F.octet_length("lead")) / 2).first()[0] or 0
    keyed = docs.withColumn("grp", grouped_by(groups))
    open_ = settled(surroundings(keyed.groupBy("grp"), asked, least, _prime(int(waiting // PART_SUFFIXES))), "surroundings")
    runs_ = expanded(open_, least, groups).union(across_parts(open_, least, groups))
    nothing = F.lit(None).cast("binary")
    both = repeated.select("grp", *ENTRY, F.lit(None).cast("long").alias("key"), F.lit(None).cast("long").alias("tag"),
                           F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high")).union(
        runs_.select("grp", *[nothing.alias(c) for c in ENTRY], "key", "tag", "low", "high"))

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        packed = right["ids"].notna()
        known = _known(right[packed], "repeated")
        single: dict[tuple, list] = {}
        rest = right[~packed]
        for k, t, low, high in zip(rest["key"], rest["tag"], rest["low"], rest["high"]):
            single.setdefault((int(k), int(t)), []).append((int(low), int(high)))
        rows = []
        for key, tag, doc_id, text in zip(left["key"], left["tag"], left["doc_id"], left["text"]):
            raw = (text or "").encode()
            gone: list[dict] = []
            if known or single:
                own = int(key), int(tag)
                starts = [x[0] for x in known.get(own, [])] + [np.array([a for a, _ in single.get(own, [])], np.int64)]
                ends = [x[0] + x[2] for x in known.get(own, [])] + [np.array([b for _, b in single.get(own, [])], np.int64)]
                starts, ends = np.concatenate(starts), np.concatenate(ends)
                if len(starts):
                    edges = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, ends + least, -1)
                    covered = np.cumsum(edges[:-1]) > 0
                    gone = [{"start": int(a), "end": int(b)} for a, b in rolling.runs(covered)]
                    n, raw = len(raw), np.frombuffer(raw, np.uint8)[~covered].tobytes()
                    rows.append((doc_id, n, gone, raw))
                    continue
            rows.append((doc_id, len(raw), gone, raw))
        return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "removed", "kept"]).astype({"doc_id": "Int64"})

    return keyed.groupBy("grp").cogroup(both.groupBy("grp")).applyInPandas(
        cut, "doc_id long, n_bytes long, removed array<struct<start:int,end:int>>, kept binary")


def digest(result: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + (r["end"] - r["start"]))
    return result.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
