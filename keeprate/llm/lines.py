"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

Every line start is a suffix of its document's sequence of line IDs. In round k suffixes that agree on
2^k lines have the same name; the suffixes of a name are a longest-common-prefix interval of at least 2^k
lines. The next round's name joins a suffix's name with that of the suffix 2^k lines on. A
suffix alone in its interval is settled and leaves, so the rounds shrink; names are
hashes instead of dense ranks, for which no global sort is needed: any fixed order of IDs gives
the same intervals. In an interval the earliest suffix stays and the runs of the later ones
are marked. Overlapping marked runs merge and are deleted.

The doubling goes on until no name is shared, and each suffix's longest common prefix is added up from the
rounds' names. Without ``whole_runs`` only blocks of ``ROUNDS`` sizes are judged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from keeprate.llm.common import WORD, col, fresh
from keeprate.session import settled

NO_ID = (1 << 63) - 1  # stands for a null id, which comes after all others
ROUNDS = 5  # blocks of 1, 2, 4, 8 and 16 lines
MIN_WORDS = 10


def line_rows(docs: DataFrame) -> DataFrame:
    """(key, text_hash, line, name, words): a row for each line of each different (id, text)."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key")
    lines = docs.filter(F.col("text").isNotNull()).select(
        key, F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n", -1)).alias("line", "content"))
    return lines.select(
        "key", "text_hash", "line", F.xxhash64("content").alias("name"),
        F.regexp_count("content", F.lit(WORD)).cast("long").alias("words"))


def _interval(suffixes: DataFrame) -> DataFrame:
    """Suffixes that share their name with one at another place; ``later`` tells that it comes first."""
    place = F.struct("key", "line")
    groups = suffixes.groupBy("name").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(
        F.col("first") != F.col("last")).select(F.col("name").alias("of"), "first")
    return suffixes.join(groups, F.col("name") == F.col("of")).select(
        *suffixes.columns, (place != F.col("first")).alias("later"))


def repeated_blocks(lines: DataFrame, min_words: int = MIN_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """(key, text_hash, line, size): later copies of blocks of ``size`` lines with enough words."""
    suffixes, marked = lines, None
    for k in range(rounds):
        size = 1 << k
        agreeing = settled(_interval(suffixes).distinct(), f"lines-{size}")
        blocks = agreeing.filter(F.col("later") & (F.col("words") >= min_words)).select(
            "key", "text_hash", "line", F.lit(size).alias("size"))
        marked = blocks if marked is None else marked.union(blocks)
        on = agreeing.select(
            F.col("key").alias("on_key"), F.col("text_hash").alias("on_hash"), (F.col("line") - size).alias("on_line"),
            F.col("name").alias("on_name"), F.col("words").alias("on_words"))
        suffixes = agreeing.join(on, (F.col("key") == F.col("on_key")) & (F.col("text_hash") == F.col("on_hash")) & (
            F.col("line") == F.col("on_line"))).select(
            "key", "text_hash", "line", F.xxhash64("name", "on_name").alias("name"), (F.col("words") + F.col("on_words")).alias("words"))
    return marked


def repeated_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, text_hash, line, size): from every line the longest run that also starts earlier, with enough words.

    A suffix's prefix grows by the rounds' block sizes, largest first. Suffixes with the same prefix compare what
    comes next: the earliest one stays as it is, the others with the same next block take it into their prefix. The
    earliest goes along as their witness, and stands for all of them among those that stay.
    """
    rounds, sizes, suffixes = [], [lines.count()], lines
    while True:
        size = 1 << len(rounds)
        agreeing = settled(_interval(suffixes).distinct(), f"runs-{size}", sizes[-1])
        sizes.append(agreeing.count())
        if not sizes[-1]:
            break
        rounds.append(agreeing)
        on = agreeing.select(
            F.col("key").alias("on_key"), F.col("text_hash").alias("on_hash"), (F.col("line") - size).alias("on_line"),
            F.col("name").alias("on_name"), F.col("words").alias("on_words"))
        suffixes = agreeing.join(on, (F.col("key") == F.col("on_key")) & (F.col("text_hash") == F.col("on_hash")) & (
            F.col("line") == F.col("on_line"))).select(
            "key", "text_hash", "line", F.xxhash64("name", "on_name").alias("name"), (F.col("words") + F.col("on_words")).alias("words"))
    first = rounds[0] if rounds else agreeing
    own = ["key", "text_hash", "line"]
    state = first.select(*own, F.lit(1).alias("size"), F.col("name").alias("prefix"), "words", (~F.col("later")).alias("witness"))
    place = F.struct("key", "line")
    for k in reversed(range(len(rounds))):
        size = 1 << k
        following = rounds[k].select(
            F.col("key").alias("on_key"), F.col("text_hash").alias("on_hash"), F.col("line").alias("on_line"),
            F.xxhash64("name", F.lit(k)).alias("on_name"), F.col("words").alias("on_words"))
        named = settled(state.join(following, (F.col("key") == F.col("on_key")) & (F.col("text_hash") == F.col("on_hash")) & (
            F.col("line") + F.col("size") == F.col("on_line")), "left").select(
            *state.columns, "on_words", F.when(F.col("on_name").isNotNull(), F.xxhash64("prefix", "on_name")).alias("longer")),
            f"runs-named-{size}", sizes[1])
        groups = named.filter(F.col("longer").isNotNull()).groupBy("longer").agg(
            F.min(place).alias("first"), F.max(F.when(~F.col("witness"), place)).alias("last")).filter(
            F.col("last") > F.col("first")).select(F.col("longer").alias("of"), "first")
        met, opens = F.col("of").isNotNull(), place == F.col("first")
        ways = F.array(
            F.struct((~met | opens).alias("goes"), F.col("size"), F.col("prefix"), F.col("words"), F.col("witness")),
            F.struct(met.alias("goes"), (F.col("size") + size).alias("size"), F.col("longer").alias("prefix"),
                     (F.col("words") + F.col("on_words")).alias("words"), (F.col("witness") | opens).alias("witness")))
        state = named.join(groups, F.col("longer") == F.col("of"), "left").select(
            *own, F.explode(F.filter(ways, lambda w: w["goes"])).alias("way")).select(
            *own, "way.size", "way.prefix", "way.words", "way.witness")
    return state.filter(~F.col("witness") & (F.col("words") >= min_words)).select(*own, "size")


def maximal_runs(blocks: DataFrame) -> DataFrame:
    """(key, text_hash, removed): merged (start, end) line runs of each document, end exclusive."""
    own = Window.partitionBy("key", "text_hash").orderBy("line", "size")
    before = F.max(F.col("line") + F.col("size")).over(own.rowsBetween(Window.unboundedPreceding, -1))
    opened = blocks.withColumn("opens", F.coalesce(F.col("line") > before, F.lit(True)).cast("int"))
    numbered = opened.withColumn("run", F.sum("opens").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("key", "text_hash", "run").agg(
        F.min("line").alias("start"), F.max(F.col("line") + F.col("size")).alias("end"))
    return runs.groupBy("key", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed"))


def dedup(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS, rounds: int = ROUNDS,
          removed_name: str = "removed", kept_name: str = "kept", whole_runs: bool = True) -> DataFrame:
    """All columns of ``docs``, the removed line runs and the text that is left.

    Lines end at ``\\n`` and are compared whole. A line is removed if it lies in a maximal run of lines, of any length,
    with at least ``min_words`` words that also starts earlier: in a document
    with a smaller doc_id, or in the same one further up. Runs are judged on the input.
    Without ``whole_runs`` the words are asked of blocks of 2^k lines, k below ``rounds``, instead.

    Null text: kept null, nothing removed. Empty text: one empty line. A text whose lines all go is
    kept empty. A null doc_id comes after all others. Rows that share an id count as one document, so
    repeated rows are not earlier than each other and stay alike. Other columns pass through, whatever
    their names; very long texts are read whole; an empty table stays empty.
    """
    key, digest, lines, gone = fresh(docs, "key", "text_hash", "lines", "gone")
    rows = settled(line_rows(docs), "lines")
    runs = maximal_runs(repeated_runs(rows, min_words) if whole_runs else repeated_blocks(rows, min_words, rounds))
    runs = runs.toDF(key, digest, gone)
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), digest: F.xxhash64("text")})
    joined = keyed.join(runs, [key, digest], "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    split = F.split("text", "\n", -1)
    starts = F.concat(F.array(F.lit(0)), F.transform(col(gone), lambda r: r["end"]))
    ends = F.concat(F.transform(col(gone), lambda r: r["start"]), F.array(F.size(col(lines))))
    parts = F.zip_with(starts, ends, lambda a, b: F.slice(col(lines), a + 1, b - a))
    kept = F.when(col(gone).isNull(), F.col("text")).otherwise(F.array_join(F.flatten(parts), "\n"))
    return joined.withColumn(lines, F.when(col(gone).isNotNull(), split)).select(
        *[col(c) for c in docs.columns], F.coalesce(col(gone), none).alias(removed_name), kept.alias(kept_name))


def digest(result: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + (r["end"] - r["start"]))
    return result.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"),
        gone.alias("n_removed"), F.size("removed").cast("long").alias("n_runs"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def without_repeats(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS, whole_runs: bool = True) -> DataFrame:
    """``docs`` with later copies of line runs cut out of ``text``; texts that lose all they have go."""
    removed, kept = fresh(docs, "removed", "kept")
    cut = dedup(spark, docs, min_words, removed_name=removed, kept_name=kept, whole_runs=whole_runs)
    left = cut.filter((F.size(col(removed)) == 0) | (F.trim(col(kept)) != ""))
    return left.select(*[
        col(kept).alias(c) if c == "text"
        else F.when(F.size(col(removed)) > 0, F.length(col(kept))).otherwise(col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else col(c) for c in docs.columns])
