"""Benchmark decontamination: SimHash of item-sized windows, a multi-index, then exact similarity.

For every benchmark item of L words, document windows of L words are fingerprinted: a 64-bit
SimHash whose bits are weighted votes of the window's five-word shingles. The items' fingerprints stand in a
multi-index: eight blocks of eight bits, each with all values up to two bits away. Two
fingerprints within 23 bits differ in at most two bits in one block at least, so no such
pair is missed. Candidates are confirmed by the weighted similarity of their shingles: the sum
of the smaller counts over the sum of the larger ones.

Only windows that share a shingle with an item of their size can be similar to one; the others
are never built. This first join, and not the windows, meets the whole corpus; the item
shingles are sent to all tasks only where their number is below ``BROADCAST_SHINGLES``. At similarity
0.8 a pair is expected to differ in 10 of 64 bits with a deviation of 3, so a radius of 23
loses less than one in 100,000.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keeprate.llm.common import col, fresh
from keeprate.session import settled

SHINGLE = 5
BLOCKS, BLOCK_BITS, FLIPS, RADIUS = 8, 8, 2, 23
BROADCAST_SHINGLES = 500_000  # of 16 bytes each
LANES = 32  # bits of a vote counter; two counters share a long, for windows of up to two thousand million words
TOKEN = r"[\p{L}\p{N}]+"
NO_ID = (1 << 63) - 1


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def _shingles(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words; none for shorter arrays."""
    return F.when(F.size(words) >= width, F.transform(
        F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)])
    )).otherwise(F.array().cast("array<bigint>"))


def _fingerprints(shingled: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fingerprint) from a row per shingle ``s``: every bit is the majority of the shingles' bits."""
    mask = F.lit(sum(1 << (LANES * i) for i in range(64 // LANES)))
    votes = shingled.groupBy(*keys).agg(
        F.count("*").alias("votes"),
        *[F.sum(F.shiftrightunsigned("s", g).bitwiseAND(mask)).alias(f"lane_{g}") for g in range(LANES)])
    bit = lambda g, i: F.when(
        F.shiftrightunsigned(f"lane_{g}", LANES * i).bitwiseAND(F.lit((1 << LANES) - 1)) * 2 > F.col("votes"),
        F.shiftleft(F.lit(1).cast("long"), LANES * i + g)).otherwise(F.lit(0).cast("long"))
    whole = F.lit(0).cast("long")
    for i in range(64 // LANES):
        for g in range(LANES):
            whole = whole.bitwiseOR(bit(g, i))
    return votes.select(*keys, whole.alias("fingerprint"))


def _block(i: int) -> Column:
    return F.shiftrightunsigned("fingerprint", BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def _blocks() -> Column:
    return F.array(*[F.struct(F.lit(i).alias("block"), _block(i).alias("value")) for i in range(BLOCKS)])


# All block values up to two bits away, as the bits to turn.
TURNS = [sum(1 << b for b in bits) for n in range(FLIPS + 1) for bits in combinations(range(BLOCK_BITS), n)]


def shared_weight(a: Column, b: Column) -> Column:
    """Sum over shingles of the smaller of their counts in two arrays."""
    counted = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda acc, x: acc + F.least(
            F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)


def leaks(spark: SparkSession, docs: DataFrame, items: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, start_word, n_words, n_windows): leaked items by document.

    Words are runs of letters and digits, in lower case. A window has as many words as the item; a shorter
    document is one window. ``similarity`` is the best one of the document's windows, ``start_word`` the first such
    window, ``n_windows`` how many reach ``least``. An item of fewer than five words
    is found where exactly its words stand.

    Needs doc_id and text, and item_id and text; other columns are not read. Null, empty and wordless
    texts and items match nothing. Rows equal in id and text are reported once; null ids
    are reported as null. Items that share an id count as one, at their best. Very long texts are read whole. Empty
    tables give an empty result.
    """
    tests = items.select("item_id", _words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    tests = settled(tests.select(
        "item_id", F.size("words").alias("n"), F.xxhash64("words").alias("item"), "words",
        _shingles(F.col("words"), SHINGLE).alias("shingles")).dropDuplicates(["item_id", "item"]), "items")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key")
    whole = docs.select(key, F.xxhash64("text").alias("text_hash"), "text").filter(F.col("text").isNotNull())
    found = _near(whole, tests.filter(F.col("n") >= SHINGLE), least)
    short = [r.n for r in tests.filter(F.col("n") < SHINGLE).select("n").distinct().collect()]  # four at most
    for n in sorted(short):
        found = found.unionByName(_exact(whole, tests.filter(F.col("n") == n), n))
    best = found.groupBy("key", "text_hash", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n")).alias("best"), F.count("*").alias("n_windows"))
    return best.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), "text_hash", "item_id", "best.similarity",
        (-F.col("best.back")).alias("start_word"), F.col("best.n").alias("n_words"), "n_windows")


def _with_hits(whole: DataFrame, keys: DataFrame, width: int) -> DataFrame:
    """Rows (key, text_hash, n, p, length) where the shingle at p is one of ``keys`` (hash, length)."""
    if keys.count() <= BROADCAST_SHINGLES:
        keys = F.broadcast(keys)
    texts = whole.select("key", "text_hash", _words(F.col("text")).alias("words"))
    return texts.select("key", "text_hash", F.size("words").alias("n"), F.posexplode(_shingles(F.col("words"), width)).alias("p", "s")).join(keys, "s")


def _exact(whole: DataFrame, tests: DataFrame, n: int) -> DataFrame:
    listed = tests.select("item_id", F.xxhash64(*[F.get("words", F.lit(i)) for i in range(n)]).alias("s")).distinct()
    hits = _with_hits(whole, listed, n)
    return hits.select("key", "text_hash", "item_id", F.lit(1.0).alias("similarity"), F.col("p").alias("start"), F.lit(n).alias("n")).distinct()


def _near(whole: DataFrame, tests: DataFrame, least: float) -> DataFrame:
    """(key, text_hash, item_id, similarity, start, n) of all windows that reach ``least``."""
    keys = settled(tests.select(F.explode("shingles").alias("s"), F.col("n").alias("length")).distinct(), "item-shingles")
    hits = _with_hits(whole, keys, SHINGLE)
    # Every start of a window of that length that holds the shingle; a shorter document has one window.
    starts = F.sequence(F.greatest(F.lit(0), F.least(F.col("p") - F.col("length") + SHINGLE, F.col("n") - F.col("length"))),
                        F.greatest(F.lit(0), F.least(F.col("p"), F.col("n") - F.col("length"))))
    windows = settled(hits.select("key", "text_hash", "length", F.explode(starts).alias("start")).distinct(), "windows")
    marked = windows.select("key", "text_hash").distinct()
    # Marked documents grow with the corpus: they are shuffled at every size, not sent to all tasks while they are few.
    texts = whole.join(marked.hint("merge"), ["key", "text_hash"]).dropDuplicates(["key", "text_hash"])
    texts = texts.select("key", "text_hash", _words(F.col("text")).alias("words"))  # a column of its own: it is read for every shingle
    texts = settled(texts.select("key", "text_hash", _shingles(F.col("words"), SHINGLE).alias("all")), "marked-texts")
    sliced = windows.join(texts, ["key", "text_hash"]).select(
        "key", "text_hash", "length", "start", F.slice("all", F.col("start") + 1, F.col("length") - SHINGLE + 1).alias("own"))
    sliced = settled(sliced, "sliced")
    printed = _fingerprints(sliced.select("key", "text_hash", "length", "start", F.explode("own").alias("s")),
                            ["key", "text_hash", "length", "start"])
    printed = settled(printed, "prints")
    of_items = _fingerprints(tests.select("item_id", "item", "n", F.explode("shingles").alias("s")), ["item_id", "item", "n"])
    of_items = settled(of_items.withColumnRenamed("fingerprint", "item_print"), "item-prints")
    index = of_items.withColumnRenamed("item_print", "fingerprint").select(
        "item_id", "item", F.col("n").alias("length"), F.col("fingerprint").alias("item_print"), F.explode(_blocks()).alias("b"))
    index = index.select("item_id", "item", "length", "item_print", "b.block", F.explode(F.array(*[
        F.col("b.value").bitwiseXOR(F.lit(t)) for t in TURNS])).alias("value"))
    probes = printed.select("*", F.explode(_blocks()).alias("b")).select("key", "text_hash", "length", "start", "fingerprint", "b.*")
    candidates = probes.join(index, ["length", "block", "value"]).filter(
        F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS).select(
        "key", "text_hash", "length", "start", "item_id", "item").distinct()
    pairs = candidates.join(sliced, ["key", "text_hash", "length", "start"]).join(
        tests.select("item_id", "item", "shingles"), ["item_id", "item"])
    both = shared_weight(F.col("own"), F.col("shingles"))
    judged = pairs.withColumn("both", both).withColumn(
        "similarity", F.col("both") / (F.size("own") + F.size("shingles") - F.col("both")))
    return judged.filter(F.col("similarity") >= least).groupBy("key", "text_hash", "item_id", "start").agg(
        F.max(F.struct("similarity", "length")).alias("best")).select(
        "key", "text_hash", "item_id", "best.similarity", "start", F.col("best.length").alias("n"))


def keep_clean(spark: SparkSession, docs: DataFrame, items: DataFrame, least: float = 0.8) -> DataFrame:
    """Documents in which no item leaked, with the columns they came with."""
    key, digest = fresh(docs, "key", "text_hash")
    marked = leaks(spark, docs, items, least).select(
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias(key), F.col("text_hash").alias(digest)).distinct()
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), digest: F.xxhash64("text")})
    return keyed.join(marked, [key, digest], "left_anti").select(*[col(c) for c in docs.columns])
