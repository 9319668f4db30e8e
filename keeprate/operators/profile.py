"""Table profiling. Each function covers all its columns in one or two scans."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from keeprate.operators.project import unpivot
from keeprate.operators.quantiles import exact_quantiles


def _rows(df: DataFrame, records: list[tuple], schema: str) -> DataFrame:
    """A small result (one record per column or bin) as a DataFrame."""
    return df.sparkSession.createDataFrame(records, schema)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def _present(df: DataFrame, column: str) -> Column:
    """The value, with NaN as null: the one rule of this module for what is missing."""
    value = F.col(column)
    return F.when(~F.isnan(column), value) if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else value


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _missing(df: DataFrame, column: str) -> Column:
    return F.count(F.when(_present(df, column).isNull(), 1))


def _per_column(df: DataFrame, columns: list[str], measure, name: str) -> DataFrame:
    """One aggregate per column in a single job, turned into (column, name) rows."""
    wide = df.agg(*[measure(c).alias(c) for c in columns])
    return unpivot(wide, columns, "long").withColumnRenamed("value", name)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return _per_column(df, columns or df.columns, lambda c: _missing(df, c), "nulls")


def distinct_counts(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column; the sketch is opt-in.

    Values are merged per column on the map side, so neither a frequent value nor
    the number of columns multiplies the shuffle.
    """
    columns = columns or df.columns
    if approximate:
        return _per_column(df, columns, lambda c: F.approx_count_distinct(_present(df, c)), "distinct_values")
    # Adding zero makes -0.0 and 0.0 one value in text form.
    signless = df.select(*[
        (_present(df, c) + F.lit(0.0)).alias(c) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else c
        for c in columns
    ])
    found = unpivot(signless, columns, "string").groupBy("column", "value").agg(F.lit(1).alias("one"))
    return found.groupBy("column").agg(F.count("value").alias("distinct_values"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row; equal rows are merged before the shuffle."""
    return (
        df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    )


def column_info(df: DataFrame) -> DataFrame:
    """(column, type, non_null)."""
    wide = df.agg(*[(F.count(F.lit(1)) - _missing(df, c)).alias(c) for c in df.columns])
    kinds = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    return unpivot(wide, df.columns, "long").select(
        "column", F.element_at(kinds, F.col("column")).alias("type"), F.col("value").alias("non_null")
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles, max: one row per column."""
    numeric = df.select(*[_number(c).alias(c) for c in columns])
    basics = numeric.agg(*[
        F.struct(F.count(c), F.avg(c), F.stddev_samp(c), F.min(c), F.max(c)).alias(c) for c in columns
    ]).first()
    quartiles = exact_quantiles(numeric, columns, [0.25, 0.5, 0.75])
    return _rows(
        df,
        [(c, *basics[c][:4], *quartiles[c], basics[c][4]) for c in columns],
        "column string, count long, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double",
    )


def quantile_table(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    found = exact_quantiles(df, columns, probabilities)
    return _rows(
        df,
        [(c, p, v) for c in columns for p, v in zip(probabilities, found[c])],
        "column string, probability double, value double",
    )


def value_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Counts per column and value, largest first, optionally split by other columns."""
    by = by or []
    return (
        unpivot(df, columns, "string", by)
        .groupBy("column", "value", *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("column", F.desc("n"), "value", *by)
    )


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return unpivot(df, columns, "string").distinct()


def rate_by(df: DataFrame, column: str, flag: str = "churn") -> DataFrame:
    """Rows, flagged rows and flagged share per value of a column."""
    flagged = F.col(flag).cast("int")
    return df.groupBy(column).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(flagged).alias("churned"),
        F.avg(flagged).alias("churn_rate"),
    )


def count_by_class(df: DataFrame, column: str, flag: str = "churn") -> DataFrame:
    """Counts by value with one column per class."""
    return df.groupBy(column).agg(
        F.count(F.when(~F.col(flag), 1)).alias("stayed"),
        F.count(F.when(F.col(flag), 1)).alias("left"),
    )


def means_and_deviations(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column, from one scan."""
    row = df.agg(*[
        F.struct(F.avg(_number(c)).alias("mean"), F.stddev_pop(_number(c)).alias("std")).alias(c) for c in columns
    ]).first()
    return {c: (row[c]["mean"], row[c]["std"]) for c in columns}


def mean_std_table(df: DataFrame, columns: list[str]) -> DataFrame:
    found = means_and_deviations(df, columns)
    return _rows(df, [(c, *found[c]) for c in columns], "column string, mean double, std_pop double")


def _finite(column: str) -> Column:
    return F.when(F.abs(_number(column)) < float("inf"), F.col(column).cast("double"))


def ranges(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest finite value of each column."""
    row = df.agg(*[
        F.struct(F.min(_finite(c)).alias("low"), F.max(_finite(c)).alias("high")).alias(c)
        for c in columns
    ]).first()
    return {c: (row[c]["low"], row[c]["high"]) for c in columns}


def _bin_number(value: Column, low: Column, step: Column, bins: int) -> Column:
    """Bin of a value; the edges decide where the division rounds, the last bin is closed."""
    guess = F.least(F.floor((value - low) / step), F.lit(bins - 1)).cast("int")
    down = (value < low + guess * step).cast("int")
    up = ((guess < bins - 1) & (value >= low + (guess + 1) * step)).cast("int")
    return guess - down + up


def histogram(df: DataFrame, columns: list[str], bins: int, by: str | None = None) -> DataFrame:
    """Counts in equal-width bins shared by all classes of ``by``; empty bins count 0.

    A constant column gets the single bin 0. Null, NaN and infinite values are in no bin.
    """
    keep = [by] if by else []
    # Constant columns have no width: only their bin 0 exists.
    limits = {c: (lo, hi) for c, (lo, hi) in ranges(df, columns).items() if lo is not None}
    edges = [
        (c, b, lo + b * (hi - lo) / bins, lo + (b + 1) * (hi - lo) / bins)
        for c, (lo, hi) in limits.items() for b in range(bins if hi > lo else 1)
    ]
    width = {c: (hi - lo) / bins for c, (lo, hi) in limits.items()}
    binned = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            (_bin_number(_finite(c), F.lit(limits[c][0]), F.lit(width[c]), bins)
             if width[c] else F.when(_finite(c).isNotNull(), F.lit(0))).alias("bin"),
        )
        for c in limits
    ])
    counts = (
        df.select(*keep, F.inline(binned)).filter(F.col("bin").isNotNull())
        .groupBy(*keep, "column", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    frame = _rows(df, edges, "column string, bin int, low double, high double")
    if by:
        listed = frame.agg(F.collect_list(F.struct("column", "bin", "low", "high")).alias("edges"))  # one row
        frame = df.select(by).distinct().join(listed).select(by, F.inline("edges"))
    # bins x columns x classes rows against counts of the same size.
    counts = counts.withColumnsRenamed({c: f"_{c}" for c in (*keep, "column", "bin")})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keep, "column", "bin")]
    return frame.join(counts, same, "left").select(
        *keep, "column", "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n")
    )


def _class_spread(df: DataFrame, column: str, by: str | None):
    """(class, x) rows, and their number, limits and (_of, h) of each class with spread; None without one."""
    source = df.select(_finite(column).alias("x"), (F.col(by) if by else F.lit("all")).alias("class")).filter(F.col("x").isNotNull())
    stats = source.groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("std"), F.min("x").alias("low"), F.max("x").alias("high"),
    ).filter(F.col("std") > 0)
    whole = stats.agg(F.sum("n"), F.min("low"), F.max("high")).first()
    widths = stats.select(F.col("class").alias("_of"), (F.col("std") * F.pow("n", F.lit(-0.2))).alias("h"))
    return source, (*whole, widths) if whole[0] else None


def _density_schema(source: DataFrame) -> str:
    return f"class {source.schema['class'].dataType.simpleString()}, point int, x double, density double"


def density(df: DataFrame, column: str, by: str | None = None, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid, scaled by class share.

    The bandwidth per class is Scott's rule. Each row adds to the grid sums of its class in
    the task that reads it, so the shuffle carries one row of ``points`` sums per class and task.
    Null, NaN and infinite values are left out, as are classes without spread.
    """
    source, shape = _class_spread(df, column, by)
    if shape is None:
        return _rows(df, [], _density_schema(source))
    total, low, high, widths = shape
    step = (high - low) / (points - 1)
    kernel = lambda i: F.exp(-0.5 * F.pow((F.lit(low + i * step) - F.col("x")) / F.col("h"), 2)) / F.col("h")
    sums = source.join(widths, F.col("class").eqNullSafe(F.col("_of"))).groupBy("class").agg(
        *[F.sum(kernel(i)).alias(f"s{i}") for i in range(points)])
    scale = F.lit(total * (2 * 3.141592653589793) ** 0.5)
    return sums.select("class", F.posexplode(F.array(*[f"s{i}" for i in range(points)])).alias("point", "sum")).select(
        "class", "point", (F.lit(low) + F.col("point") * F.lit(step)).alias("x"), (F.col("sum") / scale).alias("density"))


def binned_density(df: DataFrame, column: str, by: str | None = None, points: int = 200, refine: int = 10) -> DataFrame:
    """``density`` from weights on a grid ``refine`` times as fine, at a cost a row that no longer depends on ``points``.

    A row shares its weight between the two nodes beside it, by nearness; each node is then a row of that weight. With nodes
    d apart and bandwidth h this is off by at most ``share * d**2 / (8 * h**3 * sqrt(2 * pi))``, share being the class's. The
    shuffle carries one weight for each class, node and task.
    """
    source, shape = _class_spread(df, column, by)
    if shape is None:
        return _rows(df, [], _density_schema(source))
    total, low, high, widths = shape
    cells = refine * (points - 1)
    place = (F.col("x") - F.lit(low)) / F.lit((high - low) / cells)
    node = F.least(F.floor(place), F.lit(cells - 1)).cast("int")
    sides = source.select("class", node.alias("node"), place.alias("place")).select("class", F.inline(F.array(
        F.struct("node", (F.col("node") + 1 - F.col("place")).alias("weight")),
        F.struct((F.col("node") + 1).alias("node"), (F.col("place") - F.col("node")).alias("weight")))))
    nodes = sides.groupBy("class", "node").agg(F.sum("weight").alias("weight"))
    # Nodes x points rows for each class, whatever the table's size.
    pairs = nodes.join(widths, F.col("class").eqNullSafe(F.col("_of"))).select("class", "node", "weight", "h", F.explode(
        F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    apart = (F.col("point") * refine - F.col("node")) * F.lit((high - low) / cells) / F.col("h")
    sums = pairs.groupBy("class", "point").agg(F.sum(F.col("weight") * F.exp(-0.5 * apart * apart) / F.col("h")).alias("sum"))
    return sums.select("class", "point", (F.lit(low) + F.col("point") * F.lit((high - low) / (points - 1))).alias("x"),
                       (F.col("sum") / F.lit(total * math.sqrt(2 * math.pi))).alias("density"))


def box_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles, whiskers (extreme values within 1.5 IQR) and outlier counts."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggregates = []
    for c in columns:
        q1, _, q3 = quartiles[c]
        if q1 is None:
            q1 = q3 = 0.0
        value = _number(c)
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        within = F.when(value.between(low, high), value)
        aggregates.append(F.struct(
            F.min(within), F.max(within), F.count(F.when(~value.between(low, high), 1))
        ).alias(c))
    row = df.agg(*aggregates).first()
    return _rows(
        df,
        [(c, *quartiles[c], *row[c]) for c in columns],
        "column string, q1 double, median double, q3 double, "
        "whisker_low double, whisker_high double, outliers long",
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair, as (column_a, column_b, correlation).

    A pair with a constant column is null. Each pair uses the rows that are complete for it.
    """
    rows = {(r.a, r.b): r for r in _cross_products(df, columns).collect()}  # a row for each pair of columns
    records = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            one, other = rows.get((i, j)), rows.get((j, i))
            value = None
            if one is not None and one.n and one.low < one.high and other.low < other.high:
                mean, mean_b = one.sx / one.n, other.sx / one.n
                spread = (one.sxx / one.n - mean * mean) * (other.sxx / one.n - mean_b * mean_b)
                value = (one.sxy / one.n - mean * mean_b) / math.sqrt(spread) if spread > 0 else None
            records.append((a, b, value))
    return _rows(df, records, "column_a string, column_b string, correlation double")


def _cross_products(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, n, sx, sxx, sxy, low, high): sums over the rows that have both columns, x being a's distance from its mean.

    Each partition multiplies its columns as matrices and sends one row for each pair.
    """
    numeric = df.select(*[_number(c).alias(f"c{i}") for i, c in enumerate(columns)])
    means = numeric.agg(*[F.avg(c) for c in numeric.columns]).first()
    centre, k = np.array([0.0 if m is None else m for m in means]), len(columns)

    def run(batches):
        sums, low, high = np.zeros((4, k, k)), np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for batch in batches:
            raw = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            there = ~np.isnan(raw)
            x, present = np.where(there, raw - centre, 0.0), there.astype(float)
            sums += [present.T @ present, x.T @ present, (x * x).T @ present, x.T @ x]
            for b in range(k):
                part = raw[there[:, b]]
                if len(part):
                    low[:, b] = np.fmin(low[:, b], np.fmin.reduce(part, axis=0))
                    high[:, b] = np.fmax(high[:, b], np.fmax.reduce(part, axis=0))
        a, b = (i.ravel().astype(np.int32) for i in np.indices((k, k)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), *(pa.array(m.ravel()) for m in (*sums, low, high))], ["a", "b", "n", "sx", "sxx", "sxy", "low", "high"])

    totals = numeric.mapInArrow(run, "a int, b int, n double, sx double, sxx double, sxy double, low double, high double")
    return totals.groupBy("a", "b").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sxx", "sxy")], F.min("low").alias("low"), F.max("high").alias("high"))


def correlated_columns(df: DataFrame, columns: list[str], threshold: float) -> list[str]:
    """Columns correlated above the threshold with an earlier column of the list."""
    strong = {
        (r.column_a, r.column_b)
        for r in correlation_matrix(df, columns).collect()
        if r.correlation is not None and abs(r.correlation) > threshold
    }
    return [c for i, c in enumerate(columns) if any((c, earlier) in strong for earlier in columns[:i])]
