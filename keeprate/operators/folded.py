"""Cross-validation of additive models: a scan serves the models of all folds and settings together.

Gaussian naive Bayes needs one scan: the moments of each fold and class are added up, and the model
without a fold is the sum of the others. Logistic regression takes Newton steps, whose gradients and
Hessians are sums over rows: one scan adds them up for every fold and penalty.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from keeprate.session import settled

SMOOTHING = 1e-9  # of the largest variance, added to each
CHUNK = 1024  # sums that one row carries to the shuffle
RIDGE = 1e-10  # on the intercept, so that the Newton system is never singular


# ---- naive Bayes ---------------------------------------------------------------------


def _merged(parts: list[tuple[float, np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, means and variances of parts put together."""
    n = sum(part[0] for part in parts)
    mean = sum(part[0] * part[1] for part in parts) / n
    return n, mean, sum(part[0] * (part[2] + (part[1] - mean) ** 2) for part in parts) / n


def bayes_margins(folded: DataFrame, features: list[str]) -> DataFrame:
    """Adds ``margin``, the log odds of label 1 by the naive Bayes model that has not seen the row's fold.

    Rows with a null or NaN feature, label or fold teach nothing; without a feature or fold their margin
    is null. A class that the other folds do not have gives an infinite margin for the other one.
    """
    number = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in features]
    taught = folded.select("label", "fold", *number).dropna()
    found = taught.groupBy("fold", (F.col("label") > 0).alias("up")).agg(
        F.count("*").alias("n"), F.array(*[F.avg(c) for c in features]).alias("mean"),
        F.array(*[F.var_pop(c) for c in features]).alias("variance"),
    ).collect()  # two rows a fold
    moments = {(r["fold"], r["up"]): (float(r["n"]), np.array(r["mean"]), np.array(r["variance"])) for r in sorted(found, key=lambda r: (r["fold"], r["up"]))}
    margin = F.lit(None).cast("double")
    for fold in {r["fold"] for r in folded.select("fold").distinct().dropna().collect()}:  # a row a fold
        margin = F.when(F.col("fold") == fold, _log_odds(moments, fold, features)).otherwise(margin)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features])
    return folded.withColumn("margin", F.when(whole, margin))


def _log_odds(moments: dict, fold, features: list[str]) -> Column:
    classes = {up: [part for (f, u), part in moments.items() if f != fold and u == up] for up in (False, True)}
    if not all(classes.values()):
        return F.lit(math.inf if classes[True] else -math.inf if classes[False] else None).cast("double")
    added = SMOOTHING * float(_merged(classes[False] + classes[True])[2].max()) or SMOOTHING
    sides = {}
    for up, parts in classes.items():
        n, mean, variance = _merged(parts)
        sides[up] = F.lit(math.log(n))
        for c, m, v in zip(features, mean, variance + added):
            sides[up] -= F.lit(0.5 * math.log(2 * math.pi * v)) + F.pow(F.col(c) - float(m), 2) / float(2 * v)
    return sides[True] - sides[False]


# ---- logistic regression -------------------------------------------------------------


def _sums(rows: DataFrame, weights: np.ndarray, without: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, log loss, gradient and Hessian of each model at its weights, over the rows outside its fold."""
    shared = rows.sparkSession.sparkContext.broadcast((weights, without))  # models x features numbers
    models, size = weights.shape

    def add(frames):
        weights, without = shared.value
        total = np.zeros((models, 2 + size + size * size))
        for frame in filter(len, frames):
            x = np.column_stack([np.stack(frame["values"].to_numpy()).astype(float), np.ones(len(frame))])
            y, fold = frame["label"].to_numpy(), frame["fold"].to_numpy()
            margins = x @ weights.T
            for j in range(models):
                on = fold != without[j]
                points, m, of = x[on], margins[on, j], y[on]
                p = 0.5 * (1 + np.tanh(m / 2))
                total[j, 0] += len(of)
                total[j, 1] += (np.logaddexp(0, m) - of * m).sum()
                total[j, 2:2 + size] += points.T @ (p - of)
                total[j, 2 + size:] += ((points * (p * (1 - p))[:, None]).T @ points).ravel()
        for j in range(models):
            for low in range(0, total.shape[1], CHUNK):
                yield pd.DataFrame({"model": [j], "low": [low], "part": [total[j, low:low + CHUNK]]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        return group.head(1).assign(part=[np.sum(np.stack(group["part"].to_numpy()), axis=0)])

    schema = "model int, low int, part array<double>"
    total = np.zeros((models, 2 + size + size * size))
    for r in rows.mapInPandas(add, schema).groupBy("model", "low").applyInPandas(merge, schema).collect():
        total[r["model"], r["low"]:r["low"] + len(r["part"])] = r["part"]
    shared.unpersist()
    return total[:, 0], total[:, 1], total[:, 2:2 + size], total[:, 2 + size:].reshape(models, size, size)


class LogisticFolds:
    """Logistic models of every penalty without each fold, and without none.

    ``weights[i, j]`` are those of penalty i without ``folds[j]``, the intercept last; ``weights[i, -1]`` are those of all
    rows. ``scans`` tells how often the rows were read for it.
    """

    def __init__(self, folds: list, penalties: list[float], weights: np.ndarray, scans: int):
        self.folds, self.penalties, self.weights, self.scans = folds, penalties, weights, scans

    def margins(self, folded: DataFrame, features: str = "values") -> DataFrame:
        """Adds ``margins``: one a penalty, by the model that has not seen the row's fold; other folds take the model of all rows."""
        weights, place = self.weights, {fold: j for j, fold in enumerate(self.folds)}

        @F.pandas_udf("array<double>")
        def found(values: pd.Series, fold: pd.Series) -> pd.Series:
            which = fold.map(place).fillna(len(place)).astype(int).to_numpy()
            x = np.column_stack([np.stack(values.to_numpy()).astype(float), np.ones(len(values))]) if len(values) else np.zeros((0, weights.shape[2]))
            return pd.Series(list(np.einsum("nf,pnf->np", x, weights[:, which])))

        return folded.withColumn("margins", found(features, "fold"))


def fit_logistic(
    folded: DataFrame, penalties: list[float], features: str = "values", passes: int = 50, tol: float = 1e-13, by_fold: bool = True
) -> LogisticFolds:
    """Fits (label 0/1, fold, array of numbers) rows; ``by_fold=False`` fits the model of all rows alone.

    The objective is the mean log loss and half the penalty times the squared weights, the intercept free.
    Rows with a null in one of the three are left out; none at all is an error. Steps that raise the objective are halved.
    """
    rows = settled(folded.select(
        F.col("label").cast("double").alias("label"), "fold", F.col(features).cast("array<double>").alias("values")).dropna(), "folded")
    width = rows.agg(F.max(F.size("values"))).first()[0]
    if width is None:
        raise ValueError("no rows to train on")
    folds = sorted(r["fold"] for r in rows.select("fold").distinct().collect()) if by_fold else []
    without = np.array([*folds, (max(folds) if folds else 0) + 1] * len(penalties))
    if not folds:
        rows = rows.withColumn("fold", F.lit(0))
    penalty = np.repeat(penalties, len(folds) + 1)[:, None] * np.ones(width + 1)
    penalty[:, -1] = RIDGE
    best = np.zeros(penalty.shape)
    step, trial, value = np.zeros(best.shape), best.copy(), np.full(len(best), np.inf)
    done, scans = np.zeros(len(best), bool), 0
    while scans < passes and not done.all():
        n, loss, gradient, hessian = _sums(rows, trial, without)
        scans += 1
        for j in np.flatnonzero(~done):
            if not n[j]:  # all rows are in the fold
                done[j] = True
                continue
            now = loss[j] / n[j] + 0.5 * float(penalty[j] @ trial[j] ** 2)
            if now > value[j] + 1e-15:
                step[j] /= 2
            else:
                best[j], value[j] = trial[j], now
                step[j] = -np.linalg.solve(hessian[j] / n[j] + np.diag(penalty[j]), gradient[j] / n[j] + penalty[j] * best[j])
            done[j] = np.abs(step[j]).max() <= tol * (1 + np.abs(best[j]).max())
            trial[j] = best[j] + step[j]
        trial[done] = best[done]
    return LogisticFolds(folds, list(penalties), best.reshape(len(penalties), len(folds) + 1, -1), scans)
