"""Whole-number vectors of embeddings, and exact inner products inside tasks (numpy)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

LARGEST = 1 << 26  # of a scaled component: sums of products of two stay whole numbers of 64 bits
PIECE = 512  # terms that are spread out to columns at a time


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x; null where the vector takes no part.

    Those are vectors that are null or hold a component that is null, not finite, or
    beyond ``LARGEST`` after scaling. An empty vector stays empty.
    """
    wide = vector.cast("array<double>")
    valid = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LARGEST))
    return F.when(valid, F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


def whole_numbers(vectors: DataFrame, scale: int, id_column: str, vector_column: str, *more: str) -> DataFrame:
    """(id, more, vector) with whole components: the rows that take part, one an id.

    Rows whose id or one of ``more`` is null take no part. Of several rows with
    one id the smallest by ``more`` and the vector, in this order, counts.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), *more, scaled(F.col(vector_column), scale).alias("vector"))
    rows = rows.dropna(subset=["id", *more, "vector"])
    return rows.groupBy("id").agg(F.min(F.struct(*more, "vector")).alias("row")).select("id", "row.*")


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of whole numbers, by floating-point units where those are exact."""
    if a.size and b.size and float(np.abs(a).sum(axis=1).max()) * float(np.abs(b).max()) < 2**53:
        return np.rint(a.astype(float) @ b.astype(float)).astype(np.int64)
    return a @ b


class Rows:
    """Sparse rows: flat terms and weights with the row of each."""

    def __init__(self, terms: list, weights: list):
        sizes = [len(t) for t in terms]
        self.count = len(sizes)
        self.row = np.repeat(np.arange(self.count), sizes)
        self.term = np.concatenate([*terms, np.zeros(0, np.int64)]).astype(np.int64)
        self.weight = np.concatenate([*weights, np.zeros(0, np.int64)]).astype(np.int64)

    def part(self, chosen: np.ndarray) -> Rows:
        """The entries for which ``chosen`` is true; the rows stay."""
        out = Rows([], [])
        out.count, out.row, out.term, out.weight = self.count, self.row[chosen], self.term[chosen], self.weight[chosen]
        return out

    def columns(self, terms: np.ndarray) -> np.ndarray:
        """The rows over some sorted terms, spread out."""
        at = np.minimum(np.searchsorted(terms, self.term), len(terms) - 1)
        here = terms[at] == self.term
        out = np.zeros((self.count, len(terms)), np.int64)
        np.add.at(out, (self.row[here], at[here]), self.weight[here])
        return out


def products(left: Rows, right: Rows) -> np.ndarray:
    """Inner products of all rows of one side with all of the other, ``PIECE`` terms at a time."""
    shared = np.intersect1d(left.term, right.term)
    out = np.zeros((left.count, right.count), np.int64)
    for start in range(0, len(shared), PIECE):
        terms = shared[start:start + PIECE]
        out += product(left.columns(terms), right.columns(terms).T)
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, best first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]
