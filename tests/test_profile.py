from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keeprate.functions.normal import log_normal_cdf
from keeprate.operators import profile
from keeprate.operators.normality import anderson_darling, split_by_normality
from keeprate.operators.ordered import dense_codes, row_numbers, running_totals
from keeprate.operators.outliers import remove_iqr_outliers, remove_zscore_outliers
from keeprate.operators.quantiles import exact_quantiles


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


@pytest.mark.parametrize("buffer_rows", [10, 50, 100_000])
def test_exact_quantiles_by_bracketing(spark, buffer_rows):
    rng = np.random.default_rng(3)
    smooth = rng.normal(size=3000)
    heavy = np.where(rng.random(3000) < 0.4, 7.0, rng.exponential(size=3000).round(2))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(smooth, heavy)], "a double, b double").repartition(7)
    probabilities = [0.0, 0.013, 0.25, 0.5, 0.75, 0.9991, 1.0]
    found = exact_quantiles(df, ["a", "b"], probabilities, buffer_rows=buffer_rows, accuracy=100)
    assert found["a"] == pytest.approx(np.quantile(smooth, probabilities), abs=1e-12)
    assert found["b"] == pytest.approx(np.quantile(heavy, probabilities), abs=1e-12)


def test_quantiles_skip_nulls_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [2.5], "b": [None]}


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_buckets(spark, descending):
    rng = np.random.default_rng(1)
    keys = rng.permutation(5000)
    df = spark.createDataFrame([(int(k), int(k % 3), int(k % 7)) for k in keys], "k long, g long, n long")
    found = running_totals(df, "k", {"upto": "n"}, by="g", descending=descending, buckets=8)
    so_far, want = {}, {}
    for k in sorted(keys, reverse=descending):
        so_far[k % 3] = so_far.get(k % 3, 0) + k % 7
        want[int(k)] = so_far[k % 3]
    assert {r.k: r.upto for r in found.collect()} == want


def test_row_numbers_and_codes_of_many_texts(spark):
    df = spark.range(4000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("t"))
    want = {t: i for i, t in enumerate(sorted(f"c{i}" for i in range(4000)))}
    assert {r.t: r.code for r in dense_codes(df.union(df), "t").collect()} == want
    assert {r.id: r.row_no for r in row_numbers(spark.range(3000), "id").collect()} == {i: i + 1 for i in range(3000)}


def test_codes_put_null_under_its_own_name(spark):
    df = spark.createDataFrame([("z",), (None,), ("a",)], "t string")
    assert {r.t: r.code for r in dense_codes(df, "t").collect()} == {"a": 0, "nan": 1, "z": 2}


def test_histogram_edges(spark):
    df = numbers(spark, [0, 1, 2, 2.5, 10, 10])
    bins = {r.bin: r.n for r in profile.histogram(df, ["x"], 4).collect()}
    assert bins == {0: 3, 1: 1, 2: 0, 3: 2}
    constant = profile.histogram(numbers(spark, [3, 3, 3]), ["x"], 4).collect()
    assert [(r.bin, r.n) for r in constant] == [(0, 3)]


def test_histogram_agrees_with_numpy(spark):
    values = np.random.default_rng(5).normal(size=2000).round(1)
    bins = {r.bin: r.n for r in profile.histogram(numbers(spark, values), ["x"], 25).collect()}
    assert [bins[i] for i in range(25)] == list(np.histogram(values, bins=25)[0])


def test_correlation_of_constant_and_missing(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0), (4.0, 8.5, 5.0)], "a double, b double, c double"
    )
    found = {(r.column_a, r.column_b): r.correlation for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert found["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 4.1, 5.9, 8.5])[0, 1])
    assert found["a", "c"] is None
    holes = df.union(spark.createDataFrame([(None, 1.0, 1.0), (9.0, None, 2.0)], df.schema))
    found = {(r.column_a, r.column_b): r.correlation for r in profile.correlation_matrix(holes, ["a", "b", "c"]).collect()}
    assert found["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 4.1, 5.9, 8.5])[0, 1])
    assert found["b", "c"] == pytest.approx(np.corrcoef([2, 4.1, 5.9, 8.5, 1], [5, 5, 5, 5, 1])[0, 1])


def test_counts_of_nulls_duplicates_distincts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, float("nan")), (2, 1.0)], "a int, b double")
    assert {r["column"]: r.nulls for r in profile.null_counts(df).collect()} == {"a": 0, "b": 3}
    assert profile.duplicate_rows(df).first()[0] == 1
    assert {r["column"]: r.distinct_values for r in profile.distinct_counts(df).collect()} == {"a": 2, "b": 1}  # NaN is missing
    assert profile.duplicate_rows(df.limit(0)).first()[0] == 0


def test_density_integrates_to_class_share(spark):
    values = np.random.default_rng(2).normal(size=500)
    df = spark.createDataFrame([(float(v), bool(i % 4 == 0)) for i, v in enumerate(values)], "x double, c boolean")
    rows = profile.density(df, "x", by="c").collect()
    for c, share in ((True, 0.25), (False, 0.75)):
        ys = sorted((r.x, r.density) for r in rows if r["class"] is c)
        area = np.trapezoid([y for _, y in ys], [x for x, _ in ys])
        assert area == pytest.approx(share, abs=0.02)


def test_binned_density_stays_within_its_bound(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=700), rng.exponential(3, 300), [7.0] * 200])
    rows = [(float(v), bool(i % 3 == 0)) for i, v in enumerate(values)] + [(None, True), (float("nan"), False), (float("inf"), True)]
    df = spark.createDataFrame(rows, "x double, c boolean").repartition(5)
    exact = {(r["class"], r.point): (r.x, r.density) for r in profile.density(df, "x", by="c", points=60).collect()}
    for refine in (1, 10):
        found = profile.binned_density(df, "x", by="c", points=60, refine=refine).collect()
        assert len(found) == len(exact) == 120
        for c in (True, False):
            own = values[[bool(i % 3 == 0) == c for i in range(len(values))]]
            h = own.std(ddof=1) * len(own) ** -0.2
            d = (values.max() - values.min()) / 59 / refine
            bound = len(own) / len(values) * d**2 / (8 * h**3 * math.sqrt(2 * math.pi))
            errors = [abs(r.density - exact[c, r.point][1]) for r in found if r["class"] is c]
            assert max(errors) <= bound + 1e-12 and all(r.x == exact[r["class"], r.point][0] for r in found)
    assert profile.binned_density(df.filter("x = 7"), "x", by="c").count() == 0  # no spread


def test_log_normal_cdf(spark):
    xs = [float(x) for x in np.linspace(-30, 30, 301)]
    rows = numbers(spark, xs, "w").selectExpr("w", log_normal_cdf("w") + " AS low", log_normal_cdf("w", -1) + " AS high").collect()
    for r in rows:
        if abs(r.w) < 26:
            assert r.low == pytest.approx(math.log(0.5 * math.erfc(-r.w / math.sqrt(2))), rel=1e-13, abs=1e-15)
        assert math.isfinite(r.low) and math.isfinite(r.high)


def test_anderson_darling_matches_textbook_form(spark):
    rng = np.random.default_rng(11)
    normal, skewed = rng.normal(size=1500), rng.exponential(size=1500).round(1)
    df = spark.createDataFrame([(float(a), float(b), 1.0) for a, b in zip(normal, skewed)], "a double, b double, c double")
    found = {r["column"]: r for r in anderson_darling(df, ["a", "b", "c"]).collect()}
    for name, values in (("a", normal), ("b", skewed)):
        y = np.sort((values - values.mean()) / values.std(ddof=1))
        n = len(y)
        cdf = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in y])
        i = np.arange(1, n + 1)
        want = -n - np.sum((2 * i - 1) * (np.log(cdf) + np.log(1 - cdf[::-1]))) / n
        assert found[name].statistic == pytest.approx(want, rel=1e-8)
    assert found["a"].is_normal and not found["b"].is_normal and not found["c"].is_normal
    assert split_by_normality(df, ["b", "a"]) == (["a"], ["b"])


def test_outlier_rules(spark):
    df = numbers(spark, [1, 2, 3, 4, 5, 6, 7, 8, 9, 100])
    assert remove_zscore_outliers(df, ["x"], 2.0).count() == 9
    assert remove_zscore_outliers(df, []).count() == 10
    assert remove_iqr_outliers(df, ["x"]).count() == 9


def test_sequential_order_matters(spark):
    rng = np.random.default_rng(8)
    a = rng.exponential(size=800)
    df = spark.createDataFrame([(float(x), float(x * rng.normal() + rng.exponential())) for x in a], "a double, b double")

    def kept(columns):
        rows = np.array([(r.a, r.b) for r in df.collect()])
        for c in columns:
            column = rows[:, "ab".index(c)]
            q1, q3 = np.quantile(column, [0.25, 0.75])
            rows = rows[(column >= q1 - 1.5 * (q3 - q1)) & (column <= q3 + 1.5 * (q3 - q1))]
        return len(rows)

    for order in (["a", "b"], ["b", "a"]):
        assert remove_iqr_outliers(df, order).count() == kept(order)


def test_results_do_not_depend_on_partitioning(spark):
    values = np.random.default_rng(9).normal(size=1000).round(2)
    one, many = numbers(spark, values).coalesce(1), numbers(spark, values[::-1]).repartition(13)
    for f in (
        lambda d: profile.describe(d, ["x"]).select("q25", "q50", "q75", "min", "max").collect(),
        lambda d: profile.histogram(d, ["x"], 10).orderBy("bin").collect(),
        lambda d: profile.box_stats(d, ["x"]).collect(),
    ):
        assert f(one) == f(many)


def test_missing_numbers_count_the_same_at_every_size(spark):
    """A third NaN among more rows than the quantile search sorts at once."""
    n = 330_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("x"))
    row = profile.describe(df, ["x"]).first()
    kept = [float(i) for i in range(n) if i % 3]
    assert row["count"] == len(kept) and row["max"] == kept[-1] and row["min"] == 1.0
    for name, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        place = share * (len(kept) - 1)
        low = int(place)
        assert row[name] == pytest.approx(kept[low] + (kept[low + 1] - kept[low]) * (place - low))
    counts = profile.histogram(df, ["x"], 10).agg(F.sum("n")).first()[0]
    assert counts == len(kept)
    assert profile.box_stats(df, ["x"]).first()["outliers"] == 0
    both = df.withColumn("y", F.col("x") * 2)
    assert all(r.correlation == pytest.approx(1.0) for r in profile.correlation_matrix(both, ["x", "y"]).collect())
    assert profile.distinct_counts(df, ["x"]).first()["distinct_values"] == len(kept)


def test_correlation_equals_numpy_on_complete_pairs(spark):
    """Missing numbers by pair, large offsets, several partitions, and a pair that is constant only together."""
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4)) + [0, 1e6, -50, 3]
    x[:, 2] += x[:, 0]
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = np.where(np.isnan(x[:, 0]), x[:, 3], 0.1)
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(x)], "a double, b double, c double, d double")
    for parts in (1, 5):
        found = {(r.column_a, r.column_b): r.correlation for r in profile.correlation_matrix(df.repartition(parts), names).collect()}
        assert len(found) == 16
        for i, a in enumerate(names):
            for j, b in enumerate(names):
                both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
                p, q = x[both, i], x[both, j]
                constant = np.ptp(p) == 0 or np.ptp(q) == 0
                assert found[a, b] is None if constant else found[a, b] == pytest.approx(np.corrcoef(p, q)[0, 1], abs=1e-9)


def test_too_many_categories_are_an_error(spark, monkeypatch):
    from keeprate.operators import encode

    monkeypatch.setattr(encode, "MOST_CATEGORIES", 3)
    assert encode.categories_of(spark.range(3), "id") == [0, 1, 2]
    with pytest.raises(ValueError, match="more than 3 values"):
        encode.categories_of(spark.range(4), "id")
