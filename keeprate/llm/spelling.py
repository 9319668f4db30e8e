"""Spelling variant grouping by a variable-length gram index.

Words at one edit (a code point inserted, deleted or replaced) from each other are found through shared grams.

1. *Dictionary.* Grams of ``SHORTEST`` to q code points are counted over the words; a gram that
   occurs more often than its share (``FREQUENT`` grams of a length at most are above it) is pruned from
   the index and replaced by its extensions. Only the pruned ones are kept and broadcast,
   so the dictionary has a bound at every size.
2. *Decomposition.* At every place a word has the shortest gram that is not pruned (or q code points, or what
   is left); grams inside an earlier one are dropped, so starts and ends rise.
3. *Affected grams.* An edit at place x changes at most the grams that end within x + 1 .. x + q: an earlier
   gram is decided by code points before x, and a later one is out of reach of any gram that contains x. So
   for each word and a middle m, edits from m on spare all grams that end by m, and edits before m all that
   end from m + q on. With at least 2 q + 1 code points both are some grams, so q grows
   with the length of the shorter word (``LONGEST``) and no pair is lost.
4. *Lists.* Two words at one edit share, at their places, all grams that the edit's side must spare. The lists
   of these grams are merged to one, named by their hash and the length of the shorter word; a
   word enters those that its lengths and shifts allow. A list beyond ``HOT`` words is split exactly: its members
   meet by what is left when one more code point is taken out of the side of the edit.
5. *Verification* by edit distance of each candidate pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keeprate.llm.rolling import mixed
from keeprate.session import settled

SHORTEST = 2  # code points of a gram
LONGEST = {7: 3, 9: 4, 11: 5, 13: 6}  # of a gram, by the least length of the shorter word: at least 2 q + 1
FREQUENT = 20_000  # grams of one length and level above the pruning share, at most
LONG = 64  # code points above which two words are compared place by place
HOT = 64  # words of a list that meet pair by pair


def runs(text: Column) -> Column:
    """Maximal runs of at least seven letters, A to Z in lower case."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(F.coalesce(low, F.lit("")), F.lit("([A-Za-zÀ-ÿ]{7,})"), F.lit(1))


def counted(words: DataFrame, shortest: int = 7, least: int = 2) -> DataFrame:
    """(word, n) of words with at least ``shortest`` code points and ``least`` occurrences; words: (word)."""
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


class Flat:
    """Words of a batch laid end to end: code points with their word, place, and rolling gram hashes."""

    def __init__(self, words: list[str], levels: np.ndarray):
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.word = np.repeat(np.arange(len(words)), self.lengths)
        self.place = np.arange(len(self.points)) - self.first[self.word]
        self.left = self.lengths[self.word] - self.place  # code points from here on
        self.reach = np.array([0, *LONGEST.values()])[levels][self.word]  # longest gram at the word's level
        self.seed = mixed(levels.astype(np.uint64) + np.uint64(1))[self.word]

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, hash of the gram at each place, whether there is one)."""
        h, n = self.seed, len(self.points)
        for size in range(1, max(LONGEST.values()) + 1):
            ahead = np.zeros(n, np.uint64)
            ahead[:n - size + 1] = self.points[size - 1:]
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + ahead + np.uint64(1))
            if size >= SHORTEST:
                yield size, h, (self.left >= size) & (size <= self.reach)


def level_of(shorter: np.ndarray) -> np.ndarray:
    """Number of the level, from 1, of pairs whose shorter word has so many code points."""
    return np.searchsorted(np.array([*LONGEST]), shorter, side="right")


def decomposed(words: list[str], levels: np.ndarray, pruned: np.ndarray):
    """(batch, gram places, their ends in the word, their hashes); ``pruned`` are sorted hashes."""
    flat = Flat(words, levels)
    size, name = np.zeros(len(flat.points), np.int64), np.zeros(len(flat.points), np.uint64)
    growing = np.ones(len(flat.points), bool)
    for q, h, there in flat.grams():
        growing &= there
        size[growing], name[growing] = q, h[growing]
        at = np.minimum(np.searchsorted(pruned, h), max(len(pruned) - 1, 0))
        growing &= pruned[at] == h if len(pruned) else False
    end = np.where(size > 0, np.arange(len(size)) + size, 0)
    before = np.maximum.accumulate(np.concatenate([[0], end[:-1]]))
    at = np.flatnonzero((size > 0) & (end > before))
    return flat, at, flat.place[at] + size[at], name[at]


def entries(words: list[str], longer: bool, pruned: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(list, first and end place of the edit) of each word, for an edit on the right and on the left."""
    shorter = np.array([len(w) for w in words], np.int64) - longer
    flat, at, end, name = decomposed(words, level_of(shorter), pruned)
    middle, reach, word = shorter // 2, flat.reach[flat.first], flat.word[at]
    # An edit on the left of a longer word has moved the grams by one place.
    for left, spared in ((False, end <= middle[word]), (True, end - longer >= (middle + reach)[word])):
        place = (flat.place[at] - (longer and left)).astype(np.uint64)
        values = np.where(spared, mixed(name + place * np.uint64(0xD6E8FEB86659FD93)), np.uint64(0))
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=total[1:])
        first = np.searchsorted(word, np.arange(len(words) + 1))
        key = mixed(mixed(total[first[1:]] - total[first[:-1]]) + (2 * shorter + left).astype(np.uint64))
        yield key, np.where(left, 0, middle), np.where(left, middle, shorter + longer)


def _roles(lengths: np.ndarray) -> list[tuple[bool, np.ndarray, np.ndarray]]:
    """(as the longer word, words, levels): each word as the shorter or equal one, and as the longer one."""
    least = min(LONGEST)
    own, longer = np.flatnonzero(lengths >= least), np.flatnonzero(lengths > least)
    return [(False, own, level_of(lengths[own])), (True, longer, level_of(lengths[longer] - 1))]


def dictionary(words: DataFrame) -> np.ndarray:
    """Sorted hashes of the pruned grams: less than ``FREQUENT`` of each length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0).to_pylist()
            lengths = np.array([len(w) for w in column], np.int64)
            for _, chosen, levels in _roles(lengths)[:1]:
                if not len(chosen):
                    continue
                for size, h, there in Flat([column[i] for i in chosen], levels).grams():
                    names, n = np.unique(h[there], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(np.full(len(n), size, np.int32)), pa.array(n)], ["name", "size", "n"])

    grams = words.select("word").mapInArrow(count, "name long, size int, n long").groupBy("name", "size").agg(F.sum("n").alias("n"))
    grams = settled(grams, "grams")
    total = grams.groupBy("size").agg(F.sum("n").alias("total"))  # a row for each gram length
    frequent = grams.join(F.broadcast(total), "size").filter((F.col("n") * FREQUENT > F.col("total")) & (F.col("n") > 8)).select("name")
    rows = frequent.toPandas()  # less than FREQUENT a length
    return np.sort(rows["name"].to_numpy(np.int64).astype(np.uint64))


LISTED = "list long, longer boolean, low int, high int, word string, n long"


def lists(words: DataFrame, pruned: np.ndarray) -> DataFrame:
    """(list, longer, low, high, word, n): each word in its merged lists; an edit lies within [low, high)."""
    shared = words.sparkSession.sparkContext.broadcast(pruned)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0).to_pylist()
            lengths = np.array([len(w) for w in column], np.int64)
            for longer, chosen, _ in _roles(lengths):
                rows = batch.take(pa.array(chosen))
                for key, low, high in entries([column[i] for i in chosen], longer, shared.value) if len(chosen) else ():
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key.astype(np.int64)), pa.array(np.full(len(key), longer)), pa.array(low.astype(np.int32)),
                        pa.array(high.astype(np.int32)), *rows.columns], ["list", "longer", "low", "high", "word", "n"])

    return words.select("word", "n").mapInArrow(enter, LISTED)


def _split(hot: DataFrame) -> DataFrame:
    """Members of long lists under what a deletion on the side of the edit leaves, with its place for words of one length."""
    def without(i):
        return F.concat(F.substring("word", F.lit(1), i), F.substring("word", i + 2, F.length("word") - i - 1))

    outside = F.sequence(F.col("low"), F.col("high") - 1)
    replaced = F.transform(outside, lambda i: F.xxhash64("list", F.lit("r"), i, without(i)))
    inserted = F.array_distinct(F.transform(outside, lambda i: F.xxhash64("list", F.lit("i"), without(i))))
    whole = F.array(F.xxhash64("list", F.lit("i"), F.col("word")))
    keys = F.when(F.col("longer"), inserted).otherwise(F.concat(replaced, whole))
    return hot.select(F.explode(keys).alias("list"), "longer", "word", "n")


def _met(members: DataFrame) -> DataFrame:
    """Candidate pairs (a, na, b, nb) within the lists; a is the shorter, or the smaller of one length.

    A list holds ``HOT`` words at most, or, where it was split, words that are all at one edit from each other or from one.
    """
    listed = members.groupBy("list").agg(F.collect_list(F.struct("longer", "word", "n")).alias("m"))
    listed = listed.filter(F.size("m") > 1)
    own = F.filter("m", lambda x: ~x["longer"])
    pairs = F.flatten(F.transform(own, lambda a: F.transform(
        F.filter("m", lambda b: b["longer"] | (a["word"] < b["word"])),
        lambda b: F.struct(a["word"].alias("a"), a["n"].alias("na"), b["word"].alias("b"), b["n"].alias("nb")))))
    return listed.select(F.explode(pairs).alias("p")).select("p.*")


def near_pairs(spark: SparkSession, words: DataFrame) -> DataFrame:
    """(a, na, b, nb): pairs of words at exactly one edit, each once; words: (word, n), different, seven code points at least."""
    members = settled(lists(words, dictionary(words)), "lists")
    hot = settled(members.groupBy(F.col("list").alias("of")).agg(F.count("*").alias("size")).filter(F.col("size") > HOT).select("of"), "hot")
    belongs = F.col("list") == F.col("of")
    cold = members.join(hot, belongs, "left_anti").select("list", "longer", "word", "n")
    candidates = _met(cold).unionByName(_met(_split(members.join(hot, belongs, "left_semi"))))
    return candidates.filter(_one_edit()).distinct()


def _one_edit() -> Column:
    """Whether a and b, of one length or b one longer, differ by one edit; in linear time for long words."""
    letters = [F.split(c, "") for c in ("a", "b")]
    first = F.array_position(F.zip_with(*letters, lambda x, y: F.coalesce(x == y, F.lit(False))), False).cast("int")
    tail_a = F.when(F.length("a") == F.length("b"), F.substring("a", first + 1, F.length("a"))).otherwise(F.substring("a", first, F.length("a")))
    long = (first > 0) & (tail_a == F.substring("b", first + 1, F.length("b")))
    return F.when(F.length("b") > LONG, long).otherwise(F.levenshtein("a", "b", 1) == 1)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of (word, form); every step doubles the way that is done."""
    now = settled(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = now.join(step, "root", "left")
        moved = settled(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def group(spark: SparkSession, words: DataFrame, times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word.

    ``words`` are (word, n), each word once, with seven code points or more. Two words are near if exactly one inserted,
    deleted or replaced code point tells them apart. A word's form is its near word of
    largest n, ties to the smallest in code-point order, if that n is at least ``times`` its own; else
    null. The root follows forms to the last, and is the word itself without one. An empty
    table gives an empty result; ``times`` must be above 1, so that chains end.
    """
    if times <= 1:
        raise ValueError("times must be above 1")
    words = settled(words.select("word", "n"), "words")
    pairs = settled(near_pairs(spark, words), "near")
    both = pairs.select(F.col("a").alias("word"), "na", F.col("b").alias("other"), "nb").unionByName(
        pairs.select(F.col("b").alias("word"), F.col("nb").alias("na"), F.col("a").alias("other"), F.col("na").alias("nb")))
    near = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.first("na").alias("own"), F.min(F.struct(-F.col("nb"), F.col("other").alias("form"))).alias("best"))
    has = -F.col("best.col1") >= times * F.col("own")
    near = settled(near.select("word", "n_near", F.when(has, F.col("best.form")).alias("form"), F.when(has, -F.col("best.col1")).alias("form_n")), "forms")
    ends = roots(near.filter(F.col("form").isNotNull()))
    return words.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def perturbed_words(docs: DataFrame) -> DataFrame:
    """(word): the runs of every text, where 31 divides crc32("id:run") without the code point that it picks.

    A null text has no run, a null id counts as an empty text.
    """
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs(F.col("text"))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return run.select(F.when(h % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
