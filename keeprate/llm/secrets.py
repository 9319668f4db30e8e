"""Secret scan: fixed patterns plus a battery of randomness tests, in column expressions.

Tokens of 20 and more key characters are tested. From its characters a token's encoding
(alphabet) is inferred, and three tests ask if it could be drawn evenly from it:
chi-squared uniformity over the alphabet, the runs test on its lower and upper half,
and lag-one serial correlation. A token that passes all three may still be plain
text that is too short to tell, so the chi-squared value is also held against the one that
text of this length would give; these probabilities go through a false-discovery control
by length class, whose thresholds come from counts over all tokens of the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from keeprate.functions.normal import log_normal_cdf
from keeprate.session import settled

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
MIN_ASSIGNED = 12
KINDS = ["assign", "access", "hex", "random"]

# Alphabets by encoding, and the excess of squared letter frequencies over
# an even spread (alphabet size times the sum of squares, less one) that text shows in each.
ENCODINGS = {
    "decimal": ("0123456789", 0.5),
    "hex": ("0123456789abcdef", 1.2),
    "hex_upper": ("0123456789ABCDEF", 1.2),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.1),
    "base36": ("0123456789abcdefghijklmnopqrstuvwxyz", 1.4),
    "base62": ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 3.0),
    "base64": ("+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 3.2),
    "base64url": ("-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz", 3.2),
}
LENGTH_CLASSES = [20, 24, 32, 40, 64, 128]  # lower ends
BINS_PER_TENTH = 20  # bins of probability for each power of ten
LEAST_POWER = -300  # smaller probabilities share a bin: no count of tests is so large that they differ


def _matches(df: DataFrame, pattern: str, name: str, group: int = 0) -> DataFrame:
    """Adds ``name``: an array of (start, end, value) of the leftmost matches, in code points."""
    found, values, pieces = f"{name}_found", f"{name}_values", f"{name}_pieces"
    hit = F.col("text").rlike(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumns({
        found: F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none),
        pieces: F.when(hit, F.split("text", pattern, -1)).otherwise(none),
        **({values: F.when(hit, F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).otherwise(none)} if group else {}),
    })
    steps = F.zip_with(F.slice(F.col(pieces), F.lit(1), F.size(found)), F.col(found), lambda p, m: F.struct(
        F.length(p).alias("gap"), F.length(m).alias("long")))
    walked = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["long"]).alias("at"),
            F.array_append(acc["spans"], F.struct(
                (acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["long"]).alias("end"))).alias("spans"),
        ), lambda acc: acc["spans"])
    spans = F.zip_with(walked, F.col(values if group else found), lambda s, v: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))
    kept = [c for c in df.columns if c not in (found, values, pieces)]
    return df.select(*kept, spans.alias(name))


def normal_cdf(z: Column) -> Column:
    """The normal distribution function to seven decimals (Abramowitz and Stegun, 26.2.17), at least 1e-8.

    For the levels of the randomness tests; p_text needs its tail and is kept as a logarithm.
    """
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.greatest(F.exp(-z * z / 2) * 0.3989422804014327 * series, F.lit(1e-8))
    return F.when(z > 0, 1 - tail).otherwise(tail)


def encoding_of(bare: Column) -> Column:
    """The narrowest alphabet that holds all characters."""
    return (
        F.when(bare.rlike("^[0-9]+$"), "decimal").when(bare.rlike("^[0-9a-f]+$"), "hex")
        .when(bare.rlike("^[0-9A-F]+$"), "hex_upper").when(bare.rlike("^[A-Z2-7]+$"), "base32")
        .when(bare.rlike("^[a-z0-9]+$"), "base36").when(bare.rlike("^[A-Za-z0-9]+$"), "base62")
        .when(bare.rlike("^[A-Za-z0-9+/]+$"), "base64").otherwise("base64url")
    )


def tested(tokens: DataFrame) -> DataFrame:
    """Adds encoding, p_uniform, p_runs, p_serial and log_p_text (to base 10) to rows with a column ``value``."""
    alphabets = F.create_map(*[F.lit(x) for k, (a, _) in ENCODINGS.items() for x in (k, a)])
    excess = F.create_map(*[F.lit(x) for k, (_, e) in ENCODINGS.items() for x in (k, e)])
    bare = F.regexp_replace("value", "=+$", "")
    df = tokens.withColumns({"bare": bare}).withColumn("encoding", encoding_of(F.col("bare"))).withColumns({
        "alphabet": alphabets[F.col("encoding")], "excess": excess[F.col("encoding")],
    }).withColumns({
        "k": F.length("alphabet").cast("double"),
        "squares": F.aggregate(
            F.filter(F.split("alphabet", ""), lambda s: s != ""), F.lit(0.0),
            lambda acc, s: acc + F.pow(F.length("bare") - F.length(F.replace(F.col("bare"), s, F.lit(""))), F.lit(2))),
        "codes": F.transform(F.filter(F.split("bare", ""), lambda c: c != ""),
                             lambda c: F.instr(F.col("alphabet"), c).cast("double")),
    })
    mean = F.aggregate("codes", F.lit(0.0), lambda acc, c: acc + c) / F.size("codes")
    df = df.withColumn("mean", mean).withColumns({
        "deviations": F.transform("codes", lambda c: c - F.col("mean")),
        "sides": F.array_join(F.transform("codes", lambda c: F.when(c * 2 > F.col("k"), "1").otherwise("0")), ""),
    }).withColumns({
        "variance": F.aggregate("deviations", F.lit(0.0), lambda acc, d: acc + d * d),
        "covariance": F.aggregate(
            F.zip_with(F.slice("deviations", F.lit(1), F.size("deviations") - 1), F.slice("deviations", F.lit(2), F.size("deviations")),
                       lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0))),
        "runs": F.regexp_count("sides", F.lit("0+|1+")).cast("double"),
        "upper": F.length(F.replace("sides", F.lit("0"), F.lit(""))).cast("double"),
    })
    df = df.withColumn("n", F.size("codes").cast("double"))
    n, k, free = F.col("n"), F.col("k"), F.col("k") - 1
    lower = n - F.col("upper")
    df = df.withColumns({"chi2": k / n * F.col("squares") - n, "expected": 2 * F.col("upper") * lower / n + 1}).withColumns({
        # The cube root of a chi-squared value over its degrees of freedom is nearly normal.
        "z_uniform": (F.cbrt(F.greatest(F.col("chi2"), F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)),
        "z_runs": (F.col("runs") - F.col("expected"))
        / F.sqrt(F.greatest((F.col("expected") - 1) * (F.col("expected") - 2) / (n - 1), F.lit(1e-9))),
        "z_serial": F.when(F.col("variance") > 0, F.col("covariance") / F.col("variance")).otherwise(1.0) * F.sqrt(n),
        "z_text": (F.col("chi2") - free - n * F.col("excess")) / F.sqrt(2 * free + 4 * n * F.col("excess")),
    })
    return df.select(
        *tokens.columns, "encoding", (1 - normal_cdf(F.col("z_uniform"))).alias("p_uniform"),
        (2 * (1 - normal_cdf(F.abs("z_runs")))).alias("p_runs"), (2 * (1 - normal_cdf(F.abs("z_serial")))).alias("p_serial"),
        (F.expr(log_normal_cdf("z_text")) / math.log(10)).alias("log_p_text"),
    )


def length_class(length: Column) -> Column:
    """The largest of ``LENGTH_CLASSES`` that is not above the length."""
    out = F.lit(LENGTH_CLASSES[0])
    for least in LENGTH_CLASSES[1:]:
        out = F.when(length >= least, F.lit(least)).otherwise(out)
    return out


def probability_bin(log_p: Column) -> Column:
    """Number of the bin of a probability, from its logarithm; a bin's upper edge is its number over ``BINS_PER_TENTH``."""
    return F.ceil(F.greatest(log_p, F.lit(float(LEAST_POWER))) * BINS_PER_TENTH).cast("int")


def thresholds(candidates: DataFrame, rate: float) -> dict[int, int]:
    """Largest accepted bin of p_text by length class, for a share of false findings of at most ``rate``.

    The step-up rule p <= rate * rank / tests, in logarithms and on counts by probability bin: a bin's
    upper edge stands for its tokens, which can only accept fewer. Returns a value for each of the
    six length classes at most; all tokens that were tested count, those that failed too.
    """
    counts = candidates.groupBy("class", probability_bin(F.col("log_p_text")).alias("bin")).agg(
        F.sum(F.col("even").cast("long")).alias("n"), F.count("*").alias("all"))
    ordered = Window.partitionBy("class").orderBy("bin")
    whole = Window.partitionBy("class")
    ranked = counts.select("class", "bin", F.sum("n").over(ordered).alias("rank"), F.sum("all").over(whole).alias("tests"))
    passed = ranked.filter((F.col("rank") > 0) & (
        F.col("bin") / BINS_PER_TENTH <= (math.log10(rate) if rate > 0 else -math.inf) + F.log10("rank") - F.log10("tests")))
    return {r["class"]: r.bin for r in passed.groupBy("class").agg(F.max("bin").alias("bin")).collect()}


def scan(spark: SparkSession, docs: DataFrame, rate: float = 0.05, alpha: float = 0.001) -> DataFrame:
    """(doc_id, spans): spans are (kind, start, end), by start and kind, in code points, end exclusive.

    Needs doc_id and text; other columns are not read. ``rate`` bounds the expected share of
    false findings among the ``random`` spans of a length class; ``alpha`` is the level
    of each of the three randomness tests. Random spans inside a base span are left out.

    A row per input row, repeated rows too. Null and empty texts have no spans. A null
    doc_id stays null. Very long texts are read whole. An empty table gives an empty result.
    """
    found = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    for pattern, name, group in ((ASSIGN, "assign", 2), (ACCESS, "access", 0), (HEX, "hex", 0), (TOKEN, "token", 0)):
        found = _matches(found, pattern, name, group)
    span = lambda kind: lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"))
    base = F.concat(
        F.transform(F.filter("assign", lambda m: F.length(m["value"]) >= MIN_ASSIGNED), span("assign")),
        F.transform("access", span("access")), F.transform("hex", span("hex")),
    )
    found = found.select(F.monotonically_increasing_id().alias("row"), "doc_id", base.alias("base"), F.col("token").alias("tokens"))
    found = settled(found, "found")
    tests = tested(found.filter(F.size("tokens") > 0).select("row", F.explode("tokens").alias("t")).select("row", "t.*"))
    even = (F.col("p_uniform") >= alpha) & (F.col("p_runs") >= alpha) & (F.col("p_serial") >= alpha)
    tests = settled(tests.select(
        "row", "start", "end", "log_p_text", even.alias("even"), length_class(F.length("value")).alias("class")), "tests")
    accepted = F.lit(None).cast("int")
    for least, last in thresholds(tests, rate).items():
        accepted = F.when(F.col("class") == least, F.lit(last)).otherwise(accepted)
    random = tests.filter(F.col("even") & (probability_bin(F.col("log_p_text")) <= accepted)).groupBy("row").agg(F.collect_list(F.struct(
        "start", F.lit(KINDS.index("random")).alias("kind"), "end")).alias("random"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = found.select("row", "doc_id", "base").join(random, "row", "left")
    fresh_spans = F.filter(F.coalesce("random", none), lambda r: ~F.exists(
        "base", lambda b: (b["start"] <= r["start"]) & (r["end"] <= b["end"])))
    names = F.array(*[F.lit(k) for k in KINDS])
    return joined.select("doc_id", F.transform(
        F.array_sort(F.concat("base", fresh_spans)),
        lambda s: F.struct(names[s["kind"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def digest(spans: DataFrame) -> DataFrame:
    """The result columns of the registered query, derived from the spans."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda found: F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return spans.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
    )
