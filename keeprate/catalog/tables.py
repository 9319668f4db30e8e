"""Registered projection, profiling, sorting and feature queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from keeprate.catalog.common import (
    FEATURE_LIST, NUMERIC, USAGE_SQL, cs_probability, each, flagged, kept_usage, registered, rounded, smooth_probability, usage,
)
from keeprate.functions.columns import (
    as_percent, confidence, fixed_digits, log_day, mapped, next_version, risk_level, service_call_rate, total,
    version_number, yes_no_flag, yes_no_label,
)
from keeprate.operators import encode, outliers, profile, project
from keeprate.operators.metrics import class_weights
from keeprate.operators.normality import anderson_darling
from keeprate.operators.ordered import row_numbers
from keeprate.plans import recipes
from keeprate.plans.scoring import as_predictions, report_table, summary
from keeprate.plans.usage import held_out_rows, train_rows
from keeprate.functions.normal import log_normal_cdf
from keeprate.schema import (
    CATEGORICAL, CORRELATED, CORRELATION_AFTER, CORRELATION_BEFORE, COUNTABLE, FEATURES, MEASURES, PERIODS,
)
from keeprate.session import settled, table

# ---- projections and predicates ------------------------------------------------------


def p01_drop_columns(spark, folder):
    return project.drop_columns(usage(spark, folder), ["churn", "split", "no_such_column"])


def p02_select_by_type(spark, folder):
    u = usage(spark, folder)
    return u.select("customer_id", *project.columns_of_type(u, T.StringType, T.BooleanType))


def p03_countable_split(spark, folder):
    u = usage(spark, folder).select(*FEATURES, "churn")
    return u.select(*project.countable_columns(u, CATEGORICAL))


def p04_feature_subset(spark, folder):
    return flagged(spark, folder).select(
        "customer_id", "total_charge", "cs_calls", "vmail_messages", "intl_calls", "intl_charge", "intl_flag",
        "night_calls", (F.col("area_code") == 101).cast("int").alias("area_code_101"),
    )


def p05_filter_all_columns(spark, folder):
    u = kept_usage(spark, folder)
    kept = outliers.remove_zscore_outliers(u, MEASURES, 2.0)
    return kept.select("customer_id", *MEASURES)


def p06_range_filter(spark, folder):
    return project.keep_all_within(
        usage(spark, folder), {"account_length": (1900, 2200), "cs_calls": (1, 3)}
    ).select("customer_id", "account_length", "cs_calls")


def p07_cast(spark, folder):
    return usage(spark, folder).select(
        "customer_id", F.col("churn").cast("int").alias("churn"), F.col("area_code").cast("string").alias("area_code")
    )


def p08_dictionary_map(spark, folder):
    orders = table(spark, folder, "orders")
    return usage(spark, folder).select("customer_id", yes_no_flag("intl_plan").alias("flag")).unionByName(
        # Three statuses, two of them in the dictionary: the third becomes null.
        orders.select("o_orderkey", mapped("o_orderstatus", {"O": 0, "F": 1}).alias("flag"))
        .withColumnRenamed("o_orderkey", "customer_id")
    )


def p09_risk_bucket(spark, folder):
    return usage(spark, folder).withColumn("risk", risk_level(cs_probability())).groupBy("risk").count() \
        .withColumnRenamed("count", "customers")


def p10_align_columns(spark, folder):
    return project.align(
        usage(spark, folder), ["cs_calls", "state_NOWHERE", "customer_id", "account_length"], 0
    )


def p11_relabel(spark, folder):
    return usage(spark, folder).select(
        "customer_id", yes_no_label(F.col("churn").cast("int")).alias("churned")
    )


def p12_renamed_report(spark, folder):
    u = usage(spark, folder).select("customer_id", smooth_probability().alias("probability"))
    predictions = as_predictions(u.withColumn("prediction", (F.col("probability") > 0.5).cast("int")), ["customer_id"])
    return predictions.select(
        F.col("customer_id").alias("Customer"), F.col("churn_prediction").alias("Churn"),
        F.round("churn_probability", 6).alias("Probability"), F.round("confidence", 6).alias("Confidence"),
        F.col("risk_level").alias("Risk Level"),
    )


def p13_preview(spark, folder):
    return project.preview(usage(spark, folder).select("customer_id", *FEATURES), "customer_id")


# ---- profiling -----------------------------------------------------------------------


def a01_shape(spark, folder):
    return profile.shape(usage(spark, folder))


def a02_null_counts(spark, folder):
    # Half-empty columns come from an outer join that leaves customers without orders.
    customers = table(spark, folder, "customer").join(
        usage(spark, folder).filter("churn").select("customer_id", "state", "day_charge", "churn"),
        F.col("c_custkey") == F.col("customer_id"), "left",
    )
    return profile.null_counts(customers)


def a03_duplicate_rows(spark, folder):
    return profile.duplicate_rows(usage(spark, folder).select("state", "cs_calls", "intl_plan", "vmail_plan", "churn"))


def a04_distinct_counts(spark, folder):
    return profile.distinct_counts(usage(spark, folder).select(*FEATURES, "churn"))


def a05_column_info(spark, folder):
    return profile.column_info(usage(spark, folder).select(*FEATURES, "churn"))


def a06_describe(spark, folder):
    return rounded(profile.describe(kept_usage(spark, folder), NUMERIC), {
        "mean": 4, "std": 4, "min": 4, "q25": 4, "q50": 4, "q75": 4, "max": 4,
    })


def a07_distinct_values(spark, folder):
    return profile.distinct_values(usage(spark, folder), CATEGORICAL)


def a08_value_counts(spark, folder):
    return profile.value_counts(usage(spark, folder), ["state", "cs_calls"])


def a09_count_by_category(spark, folder):
    return profile.value_counts(usage(spark, folder), CATEGORICAL)


def a10_churn_rate_by_state(spark, folder):
    """Churn rate, average total charge and service-call rate by state."""
    return encode.engineered(usage(spark, folder)).groupBy("state").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("churn").cast("int")).alias("churned"),
        F.round(F.avg(F.col("churn").cast("int")), 6).alias("churn_rate"),
        F.round(F.avg("total_charge"), 2).alias("avg_total_charge"),
        F.round(F.avg("cs_rate"), 6).alias("avg_cs_rate"),
    )


def a10_churn_by_category(spark, folder):
    return profile.value_counts(usage(spark, folder), ["state", "area_code", "intl_plan", "vmail_plan", "cs_calls"], ["churn"])


def a10_churn_by_service_calls(spark, folder):
    u = kept_usage(spark, folder)
    rates = rounded(profile.rate_by(u, "cs_calls"), {"churn_rate": 6})
    return rates.join(profile.count_by_class(u, "cs_calls"), "cs_calls")


def a11_histogram(spark, folder):
    return rounded(profile.histogram(kept_usage(spark, folder), COUNTABLE, 25), {"low": 4, "high": 4})


def a12_histogram_by_class(spark, folder):
    f = flagged(spark, folder, kept=True)
    return rounded(
        profile.histogram(f, ["total_charge", "total_calls", "cs_rate"], 30, by="churn"), {"low": 6, "high": 6}
    )


# The columns whose density is drawn.
DENSE = ["total_charge", "total_calls", "cs_rate"]


def a13_density(spark, folder):
    rows = flagged(spark, folder, kept=True)
    parts = [profile.density(rows, c, by="churn").select(F.lit(c).alias("column"), "*") for c in DENSE]
    return rounded(reduce(DataFrame.unionByName, parts), {"x": 6, "density": 9})


def a13_binned_density(spark, folder):
    """Density from weights on a fine grid."""
    rows = flagged(spark, folder, kept=True)
    parts = [profile.binned_density(rows, c, by="churn").select(F.lit(c).alias("column"), "*") for c in DENSE]
    return rounded(reduce(DataFrame.unionByName, parts), {"x": 6, "density": 9})


def a14_box_stats(spark, folder):
    return rounded(profile.box_stats(kept_usage(spark, folder), MEASURES), {
        "q1": 4, "median": 4, "q3": 4, "whisker_low": 4, "whisker_high": 4,
    })


def a14_box_stats_cleaned(spark, folder):
    cleaned = settled(outliers.remove_iqr_outliers(train_rows(kept_usage(spark, folder)), MEASURES), "cleaned")
    return rounded(profile.box_stats(cleaned, MEASURES), {
        "q1": 4, "median": 4, "q3": 4, "whisker_low": 4, "whisker_high": 4,
    })


def a15_exact_quantile(spark, folder):
    lines = table(spark, folder, "lineitem")
    found = profile.quantile_table(lines, ["l_extendedprice", "l_quantity", "l_discount"], [0.01, 0.25, 0.5, 0.75, 0.999])
    return rounded(found, {"value": 4})


def a16_correlation(spark, folder):
    return rounded(profile.correlation_matrix(flagged(spark, folder, kept=True), CORRELATION_BEFORE), {"correlation": 6})


def a16_correlation_reduced(spark, folder):
    return rounded(profile.correlation_matrix(flagged(spark, folder, kept=True), CORRELATION_AFTER), {"correlation": 6})


def a17_mean_std(spark, folder):
    return rounded(profile.mean_std_table(kept_usage(spark, folder), NUMERIC), {"mean": 4, "std_pop": 4})


def a18_normality(spark, folder):
    found = anderson_darling(train_rows(kept_usage(spark, folder)), MEASURES)
    return rounded(found, {"statistic": 4, "critical_value": 6})


def a18_normality_embeddings(spark, folder):
    """Components of the embeddings, of which some pass as normal."""
    parts = table(spark, folder, "embeddings").select(
        *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(16)]
    )
    return rounded(anderson_darling(parts, parts.columns), {"statistic": 6, "critical_value": 6})


def a19_class_distribution(spark, folder):
    return train_rows(usage(spark, folder)).groupBy("churn").agg(F.count(F.lit(1)).alias("n"))


def a20_class_weights(spark, folder):
    return rounded(class_weights(train_rows(usage(spark, folder)), "churn"), {"weight": 6})


def a21_batch_summary(spark, folder):
    u = usage(spark, folder).select(smooth_probability().alias("probability"))
    predictions = as_predictions(u.withColumn("prediction", (F.col("probability") > 0.5).cast("int")))
    return rounded(summary(predictions), {"churn_percentage": 6})


# ---- sorts ---------------------------------------------------------------------------


def _strength(spark, folder):
    """Features by the strength of their correlation with churn."""
    f = flagged(spark, folder, kept=True).withColumn("churn", F.col("churn").cast("int"))
    columns = [c for c in NUMERIC if c not in CORRELATED]
    return profile.correlation_matrix(f, ["churn", *columns]).filter(
        (F.col("column_a") == "churn") & (F.col("column_b") != "churn")
    ).select(F.col("column_b").alias("feature"), F.round(F.abs("correlation"), 6).alias("importance"))


def t01_top_ten(spark, folder):
    return _strength(spark, folder).orderBy(F.desc("importance"), "feature").limit(10)


def t02_full_ranking(spark, folder):
    ordered = _strength(spark, folder).withColumn("place", F.struct(-F.col("importance"), "feature"))
    return row_numbers(ordered, "place", "rank").drop("place")


def t03_largest_twenty(spark, folder):
    states = profile.rate_by(usage(spark, folder), "state")
    return rounded(states, {"churn_rate": 6}).orderBy(F.desc("churned"), "state").limit(20)


def t04_latest_first(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").orderBy(
        F.desc("o_orderdate"), "o_orderkey"
    ).limit(100).select("o_orderkey", "o_custkey", "o_totalprice")


# ---- features ------------------------------------------------------------------------


def f01_label_encoding(spark, folder):
    u = kept_usage(spark, folder)
    coded = encode.label_codes(train_rows(u), "state", u)
    return encode.label_codes(train_rows(u), "intl_plan", coded).select("customer_id", "state_code", "intl_plan_code")


def f01_label_encoding_text(spark, folder):
    """Codes of a column with very many distinct texts."""
    customers = table(spark, folder, "customer")
    return encode.label_codes(customers, "c_name").select("c_custkey", "c_name_code")


def f01_label_stage(spark, folder):
    u = kept_usage(spark, folder)
    model = encode.index_stage(["state"], ["code"], "error").fit(train_rows(u))
    return model.transform(u).select("customer_id", F.col("code").cast("int").alias("state_code"))


def f02_target_encoding(spark, folder):
    return usage(spark, folder).select("customer_id", F.col("churn").cast("double").alias("label"))


def f03_one_hot(spark, folder):
    u = kept_usage(spark, folder)
    known = encode.categories_of(u.filter(F.col("account_length") < 2300), "area_code")
    return encode.one_hot(u, "area_code", known).select("customer_id", *[f"area_code_{c}" for c in known])


def f03_one_hot_stage(spark, folder):
    """Width and sum of the one-hot state vector, fitted without the states of area 102."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    u = kept_usage(spark, folder)
    model = Pipeline(stages=encode.one_hot_stages(["state"])).fit(u.filter(F.col("area_code") != 102))
    values = vector_to_array("state_hot")
    return model.transform(u).select(
        "customer_id", F.size(values).alias("slots"),
        F.aggregate(values, F.lit(0.0), lambda a, b: a + b).alias("set_slots"),
    )


def f04_standard_scaling(spark, folder):
    u = kept_usage(spark, folder)
    columns = NUMERIC
    scaled = encode.standard_scaled(train_rows(u), columns, held_out_rows(u))
    return rounded(scaled.select("customer_id", *columns), {c: 6 for c in columns})


def f04_scaler_stage(spark, folder):
    from pyspark.ml.functions import vector_to_array

    u = kept_usage(spark, folder)
    columns = NUMERIC
    build = encode.assembler(columns, "raw")
    stages = encode.fit_scaler(build.transform(train_rows(u)), "raw", "scaled")
    out = build.transform(held_out_rows(u))
    for stage in stages:
        out = stage.transform(out)
    values = vector_to_array("scaled")
    return out.select("customer_id", *[F.round(values[i], 6).alias(c) for i, c in enumerate(columns)])


def f05_zscore(spark, folder):
    columns = MEASURES
    scored = outliers.zscores(kept_usage(spark, folder), columns)
    return scored.select("customer_id", *[F.round(F.abs(f"{c}_z"), 6).alias(f"{c}_z") for c in columns])


def f06_zscore_outliers(spark, folder):
    columns = MEASURES
    return outliers.remove_zscore_outliers(train_rows(kept_usage(spark, folder)), columns).select("customer_id", *columns)


def f07_iqr_outliers(spark, folder):
    return outliers.remove_iqr_outliers(
        train_rows(kept_usage(spark, folder)), MEASURES
    ).select("customer_id", *MEASURES)


def f07_iqr_outliers_lines(spark, folder):
    return outliers.remove_iqr_outliers(
        table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"]
    ).agg(F.count(F.lit(1)).alias("kept"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


def f07_iqr_outliers_at_once(spark, folder):
    return outliers.remove_iqr_outliers(
        train_rows(kept_usage(spark, folder)), MEASURES, sequential=False
    ).select("customer_id")


def f07_clean(spark, folder):
    """Both rules, chosen by the normality test of each column."""
    return outliers.clean(train_rows(kept_usage(spark, folder)), MEASURES).select("customer_id")


def f08_totals(spark, folder):
    return usage(spark, folder).select(
        "customer_id", total("calls").alias("total_calls"), F.round(total("charge"), 2).alias("total_charge")
    )


def f09_service_call_rate(spark, folder):
    return usage(spark, folder).select(
        "customer_id", F.round(service_call_rate(1), 9).alias("rate_plus_one"),
        F.round(service_call_rate(0), 9).alias("rate"),
    )


def f10_drop_correlated(spark, folder):
    return encode.without_correlated(usage(spark, folder))


def f10_correlated_by_threshold(spark, folder):
    found = profile.correlated_columns(flagged(spark, folder, kept=True), CORRELATION_BEFORE, 0.9)
    return spark.createDataFrame([(c,) for c in found], "column string")


def f11_confidence(spark, folder):
    return usage(spark, folder).select(
        "customer_id", F.round(confidence(smooth_probability()), 9).alias("confidence")
    )


def f12_preprocessing(spark, folder):
    """The full recipe's fitted features, as named columns."""
    from pyspark.ml.functions import vector_to_array

    u = kept_usage(spark, folder)
    encoded = recipes.encode(recipes.fit_features(train_rows(u), "full"), u)
    names = recipes.feature_names(encoded)
    wanted = ["intl_flag", "vmail_messages", "cs_calls", "total_calls", "total_charge", "cs_rate"]
    values = vector_to_array("raw")
    return encoded.select(
        "customer_id", F.col("label").cast("int").alias("label"), F.size(values).alias("width"),
        *[F.round(values[names.index(n)], 6).alias(n) for n in wanted],
    )


def f13_row_number(spark, folder):
    return row_numbers(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", "number")


def f14_date_format(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", log_day("ts").alias("day"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso")
    )


def f15_version_step(spark, folder):
    number = F.regexp_extract("p_brand", r"(\d+)$", 1)
    version = F.concat_ws(".", number, F.col("p_size"))
    return table(spark, folder, "part").select("p_partkey", next_version(version).alias("next_version")).distinct()


def f16_prefix_strip(spark, folder):
    return table(spark, folder, "part").filter(F.col("p_brand").startswith("Brand#1")).select(
        "p_partkey", F.expr("substring(p_brand, 7)").alias("number")
    )


def f17_number_format(spark, folder):
    return usage(spark, folder).select(
        "customer_id", fixed_digits(F.col("cs_calls") / 4.0).alias("four_digits"),
        as_percent(F.col("cs_calls") / 8.0).alias("percent"),
    )


def f18_percent(spark, folder):
    return usage(spark, folder).select("customer_id", F.round(smooth_probability() * 100, 6).alias("percent"))


QUERIES = registered(globals())

_STAT = "round({f}, 4)"
_QUARTILES = "quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3"


def _is_normal(column: str) -> str:
    return f"""(SELECT is_normal FROM judged WHERE "column" = '{column}')"""


def _within_three(columns: list[str]) -> str:
    """CTE ``within``: training rows inside three deviations of every column that ``judged`` calls normal."""
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in columns)
    keep = " AND ".join(f"(NOT {_is_normal(c)} OR abs((t.{c} - m_{c}) / s_{c}) < 3.0)" for c in columns)
    return f"within AS (SELECT t.* FROM train t, (SELECT {stats} FROM train) s WHERE {keep})"


def _sequential_iqr(source: str, columns: list[str], name: str, judged: bool = False) -> str:
    """Chain of CTEs, one per column, each over the survivors of the one before; normal columns pass where ``judged``."""
    parts, current = [], source
    for i, c in enumerate(columns):
        spared = f"{_is_normal(c)} OR " if judged else ""
        parts.append(f"""{name}_q{i} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {current}),
        {name}_{i} AS (SELECT t.* FROM {current} t, {name}_q{i}
          WHERE {spared}(t.{c} >= q1 - 1.5 * (q3 - q1) AND t.{c} <= q3 + 1.5 * (q3 - q1)))""")
        current = f"{name}_{i}"
    return ", ".join(parts)


def _train(extra: str = "") -> str:
    return f"{USAGE_SQL}, train AS (SELECT * FROM usage WHERE split = 'train'){extra}"


def _box(source: str, columns: list[str]) -> str:
    return each(columns, f"""
      SELECT '{{c}}' AS "column", round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
        round(min(CASE WHEN {{c}} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {{c}} END), 4) AS whisker_low,
        round(max(CASE WHEN {{c}} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {{c}} END), 4) AS whisker_high,
        count(CASE WHEN {{c}} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
      FROM (SELECT CAST({{c}} AS DOUBLE) AS {{c}} FROM {source}) s,
        (SELECT {_QUARTILES} FROM (SELECT CAST({{c}} AS DOUBLE) AS {{c}} FROM {source})) q GROUP BY q1, median, q3""")


def _histogram(source: str, columns: list[str], bins: int, by: str | None, digits: int) -> str:
    keep = f"{by}, " if by else ""
    frame = f"(SELECT DISTINCT {by} FROM {source}) classes CROSS JOIN " if by else ""
    same = f" AND counts.{by} = frame.{by}" if by else ""
    lead = f"frame.{by}, " if by else ""
    part = f"""
      SELECT {lead}'{{c}}' AS "column", CAST(frame.bin AS INTEGER) AS bin,
        round(lo + frame.bin * (hi - lo) / {bins}, {digits}) AS low, round(lo + (frame.bin + 1) * (hi - lo) / {bins}, {digits}) AS high,
        coalesce(n, 0) AS n
      FROM (SELECT * FROM {frame}(SELECT unnest(range({bins})) AS bin) b) frame
      CROSS JOIN (SELECT CAST(min({{c}}) AS DOUBLE) AS lo, CAST(max({{c}}) AS DOUBLE) AS hi FROM {source}) r
      LEFT JOIN (
        SELECT {keep}guess - CAST(x < lo + guess * step AS INTEGER)
          + CAST(guess < {bins - 1} AND x >= lo + (guess + 1) * step AS INTEGER) AS bin, count(*) AS n
        FROM (SELECT {keep}x, lo, step, least(CAST(floor((x - lo) / step) AS INTEGER), {bins - 1}) AS guess FROM (
          SELECT {keep}CAST({{c}} AS DOUBLE) AS x, lo, (hi - lo) / {bins} AS step FROM {source},
            (SELECT CAST(min({{c}}) AS DOUBLE) AS lo, CAST(max({{c}}) AS DOUBLE) AS hi FROM {source}) r2) a) g
        GROUP BY ALL) counts ON counts.bin = frame.bin{same}"""
    return each(columns, part)


def _correlations(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM flagged"
        for a in columns for b in columns
    )


def _normality(source: str, columns: list[str], digits: int) -> str:
    """The rank form with the mean rank weight of ties left to summation."""
    part = f"""
      SELECT '{{c}}' AS "column", n, round(-n - s / n, {digits}) AS statistic, round(0.787 / (1 + 4.0 / n - 25.0 / (n * n)), 6) AS critical_value,
        -n - s / n < 0.787 / (1 + 4.0 / n - 25.0 / (n * n)) AS is_normal
      FROM (SELECT count(*) AS n, sum((2 * i - 1) * ({log_normal_cdf("w")}) + (2 * (total - i) + 1) * ({log_normal_cdf("w", -1)})) AS s
        FROM (SELECT row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS total,
            (x - avg(x) OVER ()) / stddev_samp(x) OVER () AS w
          FROM (SELECT CAST({{c}} AS DOUBLE) AS x FROM {source})) ranked)"""
    return each(columns, part)


_STRENGTH = "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(corr(CAST(churn AS INTEGER), {c})), 6) AS importance FROM flagged"
    for c in NUMERIC if c not in CORRELATED
)
_SMOOTH = "1e0 / (1e0 + exp((account_length - 2000.0e0) / 200.0e0))"
_CALLS = " + ".join(f"{p}_calls" for p in PERIODS)
_CHARGE = " + ".join(f"{p}_charge" for p in PERIODS)
_ZFILTER = " AND ".join(f"abs(({{t}}.{c} - m_{c}) / s_{c}) < {{z}}" for c in ["{c}"])


def _zscore_filter(source: str, columns: list[str], limit: float, select: str) -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in columns)
    keep = " AND ".join(f"abs((t.{c} - m_{c}) / s_{c}) < {limit}" for c in columns)
    return f"SELECT {select} FROM {source} t, (SELECT {stats} FROM {source}) s WHERE {keep}"


_NULL_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "customer_id", "state", "day_charge", "churn"]
_TYPES = {"state": "string", "intl_plan": "string", "vmail_plan": "string", "churn": "boolean"} | {
    c: "double" for p in PERIODS for c in (f"{p}_minutes", f"{p}_charge")
}
_SCALED = NUMERIC
_SCALING_SQL = _train(", test AS (SELECT * FROM usage WHERE split = 'test')") + " SELECT customer_id, " + ", ".join(
    f"round((t.{c} - m_{c}) / s_{c}, 6) AS {c}" for c in _SCALED
) + " FROM test t, (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED) + " FROM train) s"

ORACLES = {
    "p01_drop_columns": f"{USAGE_SQL} SELECT customer_id, {FEATURE_LIST} FROM usage",
    "p02_select_by_type": f"{USAGE_SQL} SELECT customer_id, state, intl_plan, vmail_plan, churn, split FROM usage",
    "p03_countable_split": f"{USAGE_SQL} SELECT {', '.join(COUNTABLE)} FROM usage",
    "p04_feature_subset": f"""{USAGE_SQL} SELECT customer_id, total_charge, cs_calls, vmail_messages, intl_calls, intl_charge,
      intl_flag, night_calls, CAST(area_code = 101 AS INTEGER) AS area_code_101 FROM flagged""",
    "p05_filter_all_columns": f"{USAGE_SQL} " + _zscore_filter("usage", MEASURES, 2.0, "customer_id, " + ", ".join(MEASURES)),
    "p06_range_filter": f"""{USAGE_SQL} SELECT customer_id, account_length, cs_calls FROM usage
      WHERE account_length BETWEEN 1900 AND 2200 AND cs_calls BETWEEN 1 AND 3""",
    "p07_cast": f"{USAGE_SQL} SELECT customer_id, CAST(churn AS INTEGER) AS churn, CAST(area_code AS VARCHAR) AS area_code FROM usage",
    "p08_dictionary_map": f"""{USAGE_SQL} SELECT customer_id, intl_flag AS flag FROM flagged
      UNION ALL SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 END FROM orders""",
    "p09_risk_bucket": f"""{USAGE_SQL}, p AS (SELECT cs_calls / (1.0e0 + cs_calls) AS p FROM usage)
      SELECT CASE WHEN p < 0.3 THEN 'Low' WHEN p < 0.6 THEN 'Medium' ELSE 'High' END AS risk, count(*) AS customers FROM p GROUP BY 1""",
    "p10_align_columns": f'{USAGE_SQL} SELECT cs_calls, 0 AS "state_NOWHERE", customer_id, account_length FROM usage',
    "p11_relabel": f"{USAGE_SQL} SELECT customer_id, CASE WHEN churn THEN 'Yes' ELSE 'No' END AS churned FROM usage",
    "p12_renamed_report": f"""{USAGE_SQL}, p AS (SELECT customer_id, {_SMOOTH} AS p FROM usage)
      SELECT customer_id AS "Customer", CAST(p > 0.5 AS INTEGER) AS "Churn", round(p, 6) AS "Probability",
        round(abs(p - 0.5) * 2, 6) AS "Confidence",
        CASE WHEN p < 0.3 THEN 'Low' WHEN p < 0.6 THEN 'Medium' ELSE 'High' END AS "Risk Level" FROM p""",
    "p13_preview": f"{USAGE_SQL} SELECT customer_id, {FEATURE_LIST} FROM usage ORDER BY customer_id LIMIT 5",
    "a01_shape": f"{USAGE_SQL} SELECT count(*) AS rows, 22 AS columns FROM usage",
    "a02_null_counts": f"""{USAGE_SQL}, joined AS (SELECT customer.*, customer_id, state, day_charge, churn
      FROM customer LEFT JOIN (SELECT * FROM usage WHERE churn) u ON c_custkey = customer_id) """ + each(
        _NULL_COLUMNS, """SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM joined"""),
    "a03_duplicate_rows": f"""{USAGE_SQL}, narrow AS (SELECT state, cs_calls, intl_plan, vmail_plan, churn FROM usage)
      SELECT (SELECT count(*) FROM narrow) - (SELECT count(*) FROM (SELECT DISTINCT * FROM narrow)) AS duplicates""",
    "a04_distinct_counts": f"{USAGE_SQL} " + each(
        [*FEATURES, "churn"], """SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values FROM usage"""),
    "a05_column_info": f"{USAGE_SQL} " + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{_TYPES.get(c, "int")}' AS type, count({c}) AS non_null FROM usage"""
        for c in [*FEATURES, "churn"]),
    "a06_describe": f"{USAGE_SQL} " + each(NUMERIC, """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
      round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
      round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
      round(CAST(max({c}) AS DOUBLE), 4) AS max FROM usage"""),
    "a07_distinct_values": f"{USAGE_SQL} " + each(
        CATEGORICAL, """SELECT DISTINCT '{c}' AS "column", CAST({c} AS VARCHAR) AS value FROM usage"""),
    "a08_value_counts": f"{USAGE_SQL} " + each(
        ["state", "cs_calls"], """SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM usage GROUP BY {c}"""),
    "a09_count_by_category": f"{USAGE_SQL} " + each(
        CATEGORICAL, """SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM usage GROUP BY {c}"""),
    "a10_churn_rate_by_state": f"""{USAGE_SQL} SELECT state, count(*) AS customers, CAST(sum(CAST(churn AS INTEGER)) AS BIGINT) AS churned,
      round(avg(CAST(churn AS INTEGER)), 6) AS churn_rate, round(avg(total_charge), 2) AS avg_total_charge,
      round(avg(cs_rate), 6) AS avg_cs_rate FROM flagged GROUP BY state""",
    "a10_churn_by_category": f"{USAGE_SQL} " + each(
        ["state", "area_code", "intl_plan", "vmail_plan", "cs_calls"],
        """SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, churn, count(*) AS n FROM usage GROUP BY {c}, churn"""),
    "a10_churn_by_service_calls": f"""{USAGE_SQL} SELECT cs_calls, count(*) AS customers, CAST(sum(CAST(churn AS INTEGER)) AS BIGINT) AS churned,
      round(avg(CAST(churn AS INTEGER)), 6) AS churn_rate, count(CASE WHEN NOT churn THEN 1 END) AS stayed,
      count(CASE WHEN churn THEN 1 END) AS "left" FROM usage GROUP BY cs_calls""",
    "a11_histogram": f"{USAGE_SQL} " + _histogram("usage", COUNTABLE, 25, None, 4),
    "a12_histogram_by_class": f"{USAGE_SQL} " + _histogram("flagged", ["total_charge", "total_calls", "cs_rate"], 30, "churn", 6),
    "a13_density": f"{USAGE_SQL}, longer AS (" + each(DENSE, """SELECT '{c}' AS "column", churn, CAST({c} AS DOUBLE) AS v FROM flagged""") + """), s AS (
        SELECT "column", churn, count(*) AS n, stddev_samp(v) * pow(count(v), -0.2) AS h FROM longer WHERE v IS NOT NULL GROUP BY ALL),
      r AS (SELECT "column", min(v) AS lo, max(v) AS hi, count(v) AS total FROM longer GROUP BY ALL),
      grid AS (SELECT "column", CAST(point AS INTEGER) AS point, lo + point * ((hi - lo) / 199.0e0) AS gx, total
        FROM r, (SELECT unnest(range(200)) AS point))
      SELECT s."column", s.churn AS class, point, round(gx, 6) AS x,
        round(sum(exp(-0.5e0 * pow((gx - v) / h, 2)) / h) / (total * sqrt(2e0 * pi())), 9) AS density
      FROM longer JOIN s ON s.churn = longer.churn AND s."column" = longer."column" JOIN grid ON grid."column" = s."column"
      WHERE v IS NOT NULL GROUP BY s."column", s.churn, point, gx, total""",
    "a13_binned_density": f"{USAGE_SQL}, longer AS (" + each(DENSE, """SELECT '{c}' AS "column", churn, CAST({c} AS DOUBLE) AS v FROM flagged""") + """), s AS (
        SELECT "column", churn, stddev_samp(v) * pow(count(v), -0.2) AS h FROM longer WHERE v IS NOT NULL GROUP BY ALL),
      r AS (SELECT "column", min(v) AS lo, max(v) AS hi, count(v) AS total FROM longer GROUP BY ALL),
      placed AS (SELECT l."column", churn, (v - lo) / ((hi - lo) / 1990.0e0) AS place FROM longer l JOIN r ON r."column" = l."column" WHERE v IS NOT NULL),
      beside AS (SELECT *, least(floor(place), 1989) AS node FROM placed),
      nodes AS (SELECT "column", churn, node, sum(weight) AS weight FROM (
        SELECT "column", churn, node, node + 1 - place AS weight FROM beside UNION ALL SELECT "column", churn, node + 1, place - node FROM beside) GROUP BY ALL)
      SELECT n."column", n.churn AS class, CAST(point AS INTEGER) AS point, round(lo + point * ((hi - lo) / 199.0e0), 6) AS x,
        round(sum(weight * exp(-0.5e0 * pow((point * 10 - node) * ((hi - lo) / 1990.0e0) / h, 2)) / h) / (total * sqrt(2e0 * pi())), 9) AS density
      FROM nodes n JOIN s ON s.churn = n.churn AND s."column" = n."column" JOIN r ON r."column" = n."column", (SELECT unnest(range(200)) AS point)
      GROUP BY n."column", n.churn, point, lo, hi, total""",
    "a14_box_stats": f"{USAGE_SQL} " + _box("usage", MEASURES),
    "a14_box_stats_cleaned": _train(", " + _sequential_iqr("train", MEASURES, "k")) + _box(
        f"k_{len(MEASURES) - 1}", MEASURES),
    "a15_exact_quantile": "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS probability, round(quantile_cont({c}, {p}), 4) AS value FROM lineitem"""
        for c in ("l_extendedprice", "l_quantity", "l_discount") for p in (0.01, 0.25, 0.5, 0.75, 0.999)),
    "a16_correlation": f"{USAGE_SQL} " + _correlations(CORRELATION_BEFORE),
    "a16_correlation_reduced": f"{USAGE_SQL} " + _correlations(CORRELATION_AFTER),
    "a17_mean_std": f"{USAGE_SQL} " + each(
        NUMERIC, """SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std_pop FROM usage"""),
    "a18_normality": _train() + _normality("train", MEASURES, 4),
    "a18_normality_embeddings": "WITH parts AS (SELECT " + ", ".join(
        f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(16)) + " FROM embeddings) " + _normality(
        "parts", [f"x{i}" for i in range(16)], 6),
    "a19_class_distribution": _train() + " SELECT churn, count(*) AS n FROM train GROUP BY churn",
    "a20_class_weights": _train() + """ SELECT churn, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight
      FROM (SELECT churn, count(*) AS n FROM train GROUP BY churn)""",
    "a21_batch_summary": f"""{USAGE_SQL} SELECT count(*) AS total_customers, count(CASE WHEN {_SMOOTH} > 0.5 THEN 1 END) AS churn_count,
      round(count(CASE WHEN {_SMOOTH} > 0.5 THEN 1 END) * 100.0e0 / count(*), 6) AS churn_percentage FROM usage""",
    "t01_top_ten": f"{USAGE_SQL} SELECT * FROM ({_STRENGTH}) ORDER BY importance DESC, feature LIMIT 10",
    "t02_full_ranking": f"{USAGE_SQL} SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM ({_STRENGTH})",
    "t03_largest_twenty": f"""{USAGE_SQL} SELECT state, count(*) AS customers, CAST(sum(CAST(churn AS INTEGER)) AS BIGINT) AS churned,
      round(avg(CAST(churn AS INTEGER)), 6) AS churn_rate FROM usage GROUP BY state ORDER BY churned DESC, state LIMIT 20""",
    "t04_latest_first": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""",
    "f01_label_encoding": f"""{USAGE_SQL}, state_codes AS (
        SELECT state, CAST(row_number() OVER (ORDER BY state) - 1 AS INTEGER) AS state_code
        FROM (SELECT DISTINCT state FROM usage WHERE split = 'train')),
      plan_codes AS (SELECT intl_plan, CAST(row_number() OVER (ORDER BY intl_plan) - 1 AS INTEGER) AS intl_plan_code
        FROM (SELECT DISTINCT intl_plan FROM usage WHERE split = 'train'))
      SELECT customer_id, state_code, intl_plan_code FROM usage
      JOIN state_codes ON usage.state = state_codes.state JOIN plan_codes ON usage.intl_plan = plan_codes.intl_plan""",
    "f01_label_encoding_text": """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS c_name_code FROM customer""",
    "f01_label_stage": f"""{USAGE_SQL}, codes AS (
        SELECT state, CAST(row_number() OVER (ORDER BY state) - 1 AS INTEGER) AS state_code
        FROM (SELECT DISTINCT state FROM usage WHERE split = 'train'))
      SELECT customer_id, state_code FROM usage JOIN codes ON usage.state = codes.state""",
    "f02_target_encoding": f"{USAGE_SQL} SELECT customer_id, CAST(CAST(churn AS INTEGER) AS DOUBLE) AS label FROM usage",
    "f03_one_hot": f"{USAGE_SQL} SELECT customer_id, " + ", ".join(
        f"CAST(area_code = {c} AS INTEGER) AS area_code_{c}" for c in (100, 101, 102)) + " FROM usage",
    "f03_one_hot_stage": f"""{USAGE_SQL}, known AS (SELECT DISTINCT state FROM usage WHERE area_code <> 102)
      SELECT customer_id, CAST((SELECT count(*) FROM known) AS INTEGER) AS slots,
        CAST(CASE WHEN known.state IS NULL THEN 0 ELSE 1 END AS DOUBLE) AS set_slots
      FROM usage LEFT JOIN known ON usage.state = known.state""",
    "f04_standard_scaling": _SCALING_SQL,
    "f04_scaler_stage": _SCALING_SQL,
    "f05_zscore": f"{USAGE_SQL} SELECT customer_id, " + ", ".join(f"round(abs(({c} - m_{c}) / s_{c}), 6) AS {c}_z" for c in MEASURES)
      + " FROM usage, (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in MEASURES) + " FROM usage) s",
    "f06_zscore_outliers": _train() + " " + _zscore_filter(
        "train", MEASURES, 3.0, "customer_id, " + ", ".join(MEASURES)),
    "f07_iqr_outliers": _train(", " + _sequential_iqr("train", MEASURES, "k"))
      + f" SELECT customer_id, {', '.join(MEASURES)} FROM k_{len(MEASURES) - 1}",
    "f07_iqr_outliers_lines": "WITH " + _sequential_iqr("lineitem", ["l_extendedprice", "l_quantity"], "k")
      + " SELECT count(*) AS kept, round(sum(l_quantity), 2) AS quantity FROM k_1",
    "f07_iqr_outliers_at_once": _train() + " SELECT customer_id FROM train t, (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in MEASURES) + " FROM train) q WHERE " + " AND ".join(
        f"{c} BETWEEN a_{c} - 1.5 * (b_{c} - a_{c}) AND b_{c} + 1.5 * (b_{c} - a_{c})" for c in MEASURES),
    "f07_clean": _train(f", judged AS ({_normality('train', MEASURES, 4)}), " + _within_three(MEASURES) + ", "
      + _sequential_iqr("within", MEASURES, "k", judged=True)) + f" SELECT customer_id FROM k_{len(MEASURES) - 1}",
    "f08_totals": f"{USAGE_SQL} SELECT customer_id, {_CALLS} AS total_calls, round({_CHARGE}, 2) AS total_charge FROM usage",
    "f09_service_call_rate": f"""{USAGE_SQL} SELECT customer_id, round(cs_calls / (account_length + 1.0e0), 9) AS rate_plus_one,
      round(cs_calls / nullif(CAST(account_length AS DOUBLE), 0), 9) AS rate FROM usage""",
    "f10_drop_correlated": f"{USAGE_SQL} SELECT customer_id, "
      + ", ".join(c for c in FEATURES if c not in CORRELATED) + ", churn, split FROM usage",
    "f10_correlated_by_threshold": f"""{USAGE_SQL}, pairs AS ({_correlations(CORRELATION_BEFORE)}),
      places AS (SELECT unnest([{', '.join(repr(c) for c in CORRELATION_BEFORE)}]) AS name, unnest(range({len(CORRELATION_BEFORE)})) AS place)
      SELECT DISTINCT later.name AS "column" FROM pairs JOIN places earlier ON column_a = earlier.name
      JOIN places later ON column_b = later.name WHERE earlier.place < later.place AND abs(correlation) > 0.9""",
    "f11_confidence": f"{USAGE_SQL} SELECT customer_id, round(abs({_SMOOTH} - 0.5) * 2, 9) AS confidence FROM usage",
    "f12_preprocessing": f"""{USAGE_SQL} SELECT customer_id, CAST(churn AS INTEGER) AS label,
      CAST(15 + (SELECT count(DISTINCT state) FROM usage WHERE split = 'train')
        + (SELECT count(DISTINCT area_code) FROM usage WHERE split = 'train') AS INTEGER) AS width,
      round(CAST(intl_flag AS DOUBLE), 6) AS intl_flag, round(CAST(vmail_messages AS DOUBLE), 6) AS vmail_messages,
      round(CAST(cs_calls AS DOUBLE), 6) AS cs_calls, round(CAST(total_calls AS DOUBLE), 6) AS total_calls,
      round(total_charge, 6) AS total_charge, round(cs_rate, 6) AS cs_rate FROM flagged""",
    "f13_row_number": "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS number FROM orders",
    "f14_date_format": """SELECT event_id, strftime(ts, '%Y.%m.%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events""",
    "f15_version_step": """SELECT DISTINCT p_partkey, substr(p_brand, 7) || '.' || CAST(p_size + 1 AS VARCHAR) AS next_version FROM part""",
    "f16_prefix_strip": "SELECT p_partkey, substr(p_brand, 7) AS number FROM part WHERE starts_with(p_brand, 'Brand#1')",
    "f17_number_format": f"""{USAGE_SQL} SELECT customer_id, printf('%.4f', cs_calls / 4.0e0) AS four_digits,
      printf('%.2f%%', cs_calls / 8.0e0 * 100) AS percent FROM usage""",
    "f18_percent": f"{USAGE_SQL} SELECT customer_id, round({_SMOOTH} * 100, 6) AS percent FROM usage",
}
