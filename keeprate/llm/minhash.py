"""MinHash near-dedup with sequential Bayesian verification.

Documents with the same shingle set are one class, found by a sum over the set; only class
representatives go on. Bands of their MinHash signatures put likely pairs into buckets.
A candidate pair's signatures are compared batch by batch; it is dropped as soon as the
posterior chance that its similarity reaches the threshold falls below ``MISS``. The
survivors are confirmed on the full sets.

A bucket of m members never becomes m * m pairs. First each member is compared with one, the
member that shares most buckets, which is the centre of a group of near copies; links merge components.
Where components are left apart, their members meet anew at their rarest shingles: sets of similarity t
share one of the n - ceil(t * n) + 1 rarest, and its place in both orders bounds their intersection,
so pairs that only share what the whole group shares are never made. These meetings are worked off in
rounds: a few pivots are compared with the members of other components that the bound
allows, then leave; their number grows eightfold a round, so the rounds are few and no candidate is
skipped. Links, components and signatures stay in tables; the driver sees counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from keeprate.llm import rolling
from keeprate.session import settled

ROWS, BANDS = 5, 24  # a pair at similarity 0.85 misses all bands with a chance below 1e-6, at 0.8 below 1e-4
HASHES = ROWS * BANDS
BATCH = 20  # signature places compared at a time
SLOT_BITS = 20  # of the counters that order shingles by rarity; any order is right
EARLIER = 12  # rarest shingles of a class by which a meeting that came before is known
MISS = 1e-5  # chance of losing a pair at the threshold
NO_ID = np.iinfo(np.int64).max


def _lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for row, end, data, offsets in rolling.chunks(column):
        starts, ends, first = rolling.words(data, offsets)
        hashes = rolling.word_hashes(_lower(data), starts, ends)
        rolled = rolling.rolling(hashes, width, rolling.WORD_BASE)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= width:
                yield np.unique(rolled[a:b - width + 1])
            elif b > a:  # too short for a shingle: the whole sequence is one
                yield rolling.rolling(hashes[a:b], b - a, rolling.WORD_BASE) ^ np.uint64(b - a)
            else:
                yield hashes[:0]


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(11)
    return tuple(draw.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits of the smallest value of each hash function over the set."""
    times, plus = _functions()
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2_048):  # a very long text needs no more memory
        part = shingles[start:start + 2_048]
        low = np.minimum(low, (part[:, None] * times + plus).min(axis=0))
    return (low >> np.uint64(8)).astype(np.uint16)


def class_of(shingles: np.ndarray) -> int:
    """One number for a set: equal sets, equal numbers."""
    total = rolling.mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(rolling.mixed(np.array([total]))[0].astype(np.int64))


def profiles(docs: DataFrame, width: int) -> DataFrame:
    """(key, text_hash, n, class, bands, signature) of each row; bands are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = rolling.powers_for(rolling.WORD_BASE, ROWS)
        salt = rolling.mixed(np.arange(1, BANDS + 1).astype(np.uint64))
        for batch in batches:
            sizes, classes, bands, signatures = [], [], [], []
            for shingles in shingle_sets(batch.column(2), width):
                sizes.append(len(shingles))
                classes.append(class_of(shingles))
                if not len(shingles):
                    bands.append(None)
                    signatures.append(None)
                    continue
                own = signature(shingles)
                mixed = rolling.mixed((rolling.mixed(own.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)) * weights).sum(axis=1, dtype=np.uint64) ^ salt)
                bands.append(mixed.astype(np.int64))
                signatures.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                ["key", "text_hash", "n", "class", "bands", "signature"])

    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("key")
    return docs.select(key, F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "key long, text_hash long, n long, class long, bands array<long>, signature binary")


def least_matches(threshold: float) -> list[int]:
    """For each full batch, the matches below which a pair is dropped.

    With a flat prior the posterior of the similarity after m of n matches is Beta(m + 1, n - m + 1).
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            mass = np.exp(log - log.max())
            if mass[grid >= threshold].sum() / mass.sum() >= MISS:
                out.append(m)
                break
    return out


def _pruned(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, sa, sb) whose signatures do not rule the threshold out, as (a, b)."""
    least = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in (2, 3))
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, int)
            for i, needed in enumerate(least):
                at = slice(i * BATCH, (i + 1) * BATCH)
                matches[alive] += (left[alive, at] == right[alive, at]).sum(axis=1)
                alive = alive[matches[alive] >= needed]
            yield batch.select([0, 1]).take(pa.array(alive))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, width: int, least: int, per: int) -> DataFrame:
    """Pairs (a, b, ta, tb) whose sets have per * intersection >= least * union, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, last, mine = [], None, None
            for a, other in zip(batch.column(2).to_pylist(), shingle_sets(batch.column(3), width)):
                if a != last:  # pivots come in runs
                    last, mine = a, next(shingle_sets(pa.array([a]), width))
                both = len(np.intersect1d(mine, other, assume_unique=True))
                ok.append(per * both >= least * (len(mine) + len(other) - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(class, label) after merging along links (a, b) between classes.

    The smallest label spreads along links, and each label is replaced by its own label, until
    nothing changes; every step is written, so lost executors cost one step.
    """
    linked, labelled = links.count(), labels.count()
    if not linked:
        return labels
    both = settled(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b"), "links", 2 * linked)
    while True:
        near = both.join(labels.toDF("b", "of_b"), "b").groupBy("a").agg(F.min("of_b").alias("near"))
        # The label itself is lowered as well, so whole components move at once.
        met = labels.join(near.withColumnRenamed("a", "class"), "class", "left").withColumn(
            "lower", F.least("label", F.coalesce("near", "label")))
        moved = met.groupBy("label").agg(F.min("lower").alias("to")).withColumnRenamed("label", "of")
        new = settled(met.join(moved, F.col("label") == F.col("of")).select(
            "class", F.col("to").alias("label"), (F.col("to") != F.col("label")).alias("changed")), "labels", labelled)
        labels = new.select("class", "label")
        if new.filter("changed").isEmpty():
            return labels


def group(spark: SparkSession, docs: DataFrame, width: int = 5, least: int = 80, per: int = 100) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for every row.

    Words are cut at ASCII blanks, with A to Z in lower case. Documents are linked when
    per * intersection >= least * union of their distinct ``width``-word shingles; a text with
    fewer words has its whole sequence as its one shingle. ``component_id`` is the smallest
    doc_id that links lead to, ``kept`` tells that the row's own id is that.

    Null, empty and blank texts have no shingle and are linked with nothing, each kept under its own
    id. A null doc_id comes after all others: its component is null where no other id is in it, and
    it is kept there. Rows equal in id and text get the same result. Only doc_id and text are
    read; ``width`` is 512 at most; ``text_hash`` is xxhash64 of the text, to find the row again. Very long texts are read whole. An empty
    table gives an empty result. Sets are sets of 64-bit shingle hashes.
    """
    if not 1 <= width <= rolling.WIDEST:
        raise ValueError(f"width must be from 1 to {rolling.WIDEST}")
    docs = docs.select("doc_id", "text")
    rows = settled(profiles(docs, width), "profiles")
    nodes = rows.filter(F.col("n") > 0).groupBy("class").agg(
        F.min(F.struct("key", "text_hash")).alias("root"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    nodes = settled(nodes.select("class", "n", "root.*", "bands", "signature"), "nodes")
    labels = _linked(spark, docs, nodes, width, least, per)
    named = nodes.select("class", "key").join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    smallest = named.groupBy("label").agg(F.min("key").alias("component"))
    found = named.join(smallest, "label").select("class", "component")
    real = lambda c: F.when(F.col(c) != int(NO_ID), F.col(c))
    return rows.join(found, "class", "left").withColumn("component", F.coalesce(F.when(F.col("n") > 0, F.col("component")), "key")).select(
        real("key").alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"), real("component").alias("component_id"),
        (F.col("key") == F.col("component")).alias("kept"))


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _slot_counts(texts: DataFrame, width: int) -> np.ndarray:
    """How often shingles fall into each slot, for an order by rarity; 2 ** ``SLOT_BITS`` numbers at every size."""
    part = 1 << 10

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for shingles in shingle_sets(batch.column(1), width):
                np.add.at(total, _slot(shingles), 1)
        rows = [(i, x.tobytes()) for i, x in enumerate(total.reshape(-1, part)) if x.any()]
        yield pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["part", "counts"])

    def add(key, frame):
        total = sum(np.frombuffer(x, np.int64) for x in frame["counts"])
        return pd.DataFrame({"part": [int(key[0])], "counts": [total.tobytes()]})

    rows = texts.select("class", "text").mapInArrow(count, "part int, counts binary").groupBy("part").applyInPandas(
        add, "part int, counts binary").collect()
    out = np.zeros((1 << SLOT_BITS) // part * part, np.int64).reshape(-1, part)
    for row in rows:
        out[row.part] = np.frombuffer(row.counts, np.int64)
    return out.reshape(-1)


def _meetings(texts: DataFrame, width: int, least: int, per: int) -> DataFrame:
    """(class, n, bucket, place, leads): the rarest shingles of each class, of which linked classes share one.

    The smaller set of a linked pair has the first shared shingle among fewer still, the ones where it ``leads``.
    """
    counts = texts.sparkSession.sparkContext.broadcast(_slot_counts(texts, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                chosen, sizes, leading = [], [], []
                for shingles in shingle_sets(rows.column(1), width):
                    n = len(shingles)
                    order = np.lexsort((shingles, counts.value[_slot(shingles)]))
                    chosen.append(shingles[order[:n - -(-least * n // per) + 1]].astype(np.int64))
                    sizes.append(n)
                    leading.append(np.arange(len(chosen[-1])) <= n + (-2 * least * n // (per + least)))
                times = [len(x) for x in chosen]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.asarray(rows.column(0)), times)), pa.array(np.repeat(np.array(sizes, np.int64), times)),
                    pa.array(np.concatenate(chosen)), pa.array(np.concatenate([np.arange(t) for t in times]).astype(np.int32)),
                    pa.array(np.concatenate(leading))], ["class", "n", "bucket", "place", "leads"])

    return texts.select("class", "text").mapInArrow(run, "class long, n long, bucket long, place int, leads boolean")


def _may_link(least: int, per: int) -> Column:
    """False where the places at which two classes first meet keep their similarity below the threshold."""
    both = F.least(F.col("n") - F.col("place"), F.col("pivot_n") - F.col("pivot_place"))
    return per * both >= least * (F.col("n") + F.col("pivot_n") - both)


class _Verifier:
    """Links between candidate pairs (a, b): signatures first, then the full sets."""

    def __init__(self, signatures: DataFrame, texts: DataFrame, width: int, least: int, per: int):
        self.signatures, self.texts, self.width, self.least, self.per = signatures, texts, width, least, per

    def links(self, pairs: DataFrame, how: str = "auto") -> DataFrame:
        """``how`` "merge" shuffles the texts at every size, for pairs that grow with the corpus."""
        signed = pairs.distinct().join(self.signatures.toDF("a", "sa"), "a").join(self.signatures.toDF("b", "sb"), "b")
        likely = settled(_pruned(signed, self.least / self.per), "likely")
        texts = self.texts.hint("merge") if how == "merge" else self.texts
        with_texts = likely.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a")
        return settled(_confirmed(with_texts, self.width, self.least, self.per), "confirmed")


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their labels, of buckets that hold several components and one that leads."""
    now = members.join(labels, "class")
    several = now.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("leads").alias("led")).filter(
        (F.col("low") != F.col("high")) & F.col("led")).select("bucket")
    return settled(now.join(several, "bucket"), "apart")


def _linked(spark: SparkSession, docs: DataFrame, nodes: DataFrame, width: int, least: int, per: int) -> DataFrame:
    """(class, label): component labels of the classes that share a bucket with another."""
    banded = nodes.select("class", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(
        F.count("*").alias("size"), F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("sum")).filter(F.col("size") > 1)
    # Buckets with the same members are one.
    buckets = settled(buckets.groupBy("size", "sum").agg(F.min("bucket").alias("bucket"), F.count("*").alias("times")), "buckets")
    members = settled(banded.join(buckets, "bucket").select("bucket", "class", "size", "times"), "members")
    degree = members.groupBy("class").agg(F.sum(F.col("size") * F.col("times")).alias("degree"))
    sharing = settled(degree.join(nodes.drop("bands"), "class"), "sharing")
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("key"), F.xxhash64("text").alias("text_hash"), "text")
    # What shares a bucket grows with the corpus: it is shuffled at every size, not sent to all tasks while it is small.
    texts = keyed.join(sharing.select("class", "key", "text_hash").hint("merge"), ["key", "text_hash"])
    texts = settled(texts.groupBy("class").agg(F.first("text").alias("text")), "texts")
    labels = settled(sharing.select("class", F.col("class").alias("label")), "labels", sharing.count())
    verifier = _Verifier(sharing.select("class", "signature"), texts, width, least, per)

    # Every member against its bucket's centre.
    placed = members.select("bucket", "class").join(sharing.select("class", "degree", "n"), "class")
    centres = placed.groupBy("bucket").agg(F.max(F.struct("degree", "class", "n")).alias("centre"))
    near = placed.join(centres, "bucket").filter((F.col("class") != F.col("centre.class")) & (
        per * F.least("n", "centre.n") >= least * F.greatest("n", "centre.n")))
    labels = components(verifier.links(near.select(F.col("centre.class").alias("a"), F.col("class").alias("b")), "merge"), labels)

    # The members of buckets that still hold several components, at their rarest shingles. A centre has met its bucket:
    # only the others' pairs are left, and none in the buckets of two that a larger corpus makes by chance.
    others = members.join(centres.select("bucket", F.col("centre.class").alias("class")), ["bucket", "class"], "left_anti")
    left = _apart(others.select("bucket", "class", F.lit(True).alias("leads")), labels).select("class").distinct()
    open_members = meetings = settled(_meetings(texts.hint("merge").join(left, "class"), width, least, per), "meetings")
    # Two classes meet first at their rarest shared shingle; later meetings are left out as far as ``firsts`` tells.
    firsts = settled(meetings.filter(F.col("place") < EARLIER).groupBy("class").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "bucket"))), lambda x: x["bucket"]).alias("firsts")), "firsts")
    before = F.slice("firsts", F.lit(1), F.col("place"))
    pivots_a_round = 8
    while True:
        now = _apart(open_members, labels)
        if now.isEmpty():
            return labels
        nth = F.row_number().over(Window.partitionBy("bucket").orderBy("place", "class"))
        pivots = settled(now.filter("leads").withColumn("nth", nth).filter(F.col("nth") <= pivots_a_round).select(
            F.col("bucket").alias("of"), F.col("class").alias("pivot"), F.col("label").alias("pivot_label"),
            F.col("n").alias("pivot_n"), F.col("place").alias("pivot_place"), F.col("class")).join(firsts, "class").select(
            "of", "pivot", "pivot_label", "pivot_n", "pivot_place", F.slice("firsts", F.lit(1), F.col("pivot_place")).alias("pivot_before")), "pivots")
        members = now.join(firsts, "class").withColumn("before", before).drop("firsts")
        pairs = members.join(pivots, (F.col("bucket") == F.col("of")) & (F.col("label") != F.col("pivot_label")) & _may_link(least, per)
                             & ~F.arrays_overlap("before", "pivot_before"))
        labels = components(verifier.links(pairs.select(F.col("pivot").alias("a"), F.col("class").alias("b"))), labels)
        done = pivots.select(F.col("of").alias("bucket"), F.col("pivot").alias("class"))
        open_members = now.drop("label").join(done, ["bucket", "class"], "left_anti")
        pivots_a_round *= 8


def dedup(spark: SparkSession, docs: DataFrame, width: int = 5, least: int = 80, per: int = 100) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id, with all its columns."""
    from keeprate.llm.common import col, fresh

    key, digest = fresh(docs, "key", "text_hash")
    kept = group(spark, docs, width, least, per).filter("kept").select(
        F.coalesce("doc_id", F.lit(int(NO_ID))).alias(key), F.col("text_hash").alias(digest)).distinct()
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))), digest: F.xxhash64("text")})
    return keyed.join(kept, [key, digest], "left_semi").select(*[col(c) for c in docs.columns])
