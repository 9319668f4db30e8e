"""Exact quantiles by scans.

Spark's exact ``percentile`` keeps every distinct value of a column in one merge
task. Here the ranks are found by bracketing, at every size alike: an approximate pass gives a narrow value range around each wanted
rank, a counting pass says which side of it holds the rank, and the range shrinks
until at most ``BUFFER_ROWS`` rows are left in it, which are sorted in one task. Every pass covers all columns and ranks in one scan and shuffles only
per-partition summaries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

BUFFER_ROWS = 100_000  # when bracketing ends; the values found do not depend on it
ACCURACY = 2_000


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _interpolate(lower: float, upper: float, share: float) -> float:
    return lower + (upper - lower) * share


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    buffer_rows: int = BUFFER_ROWS,
    accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, per column; nulls and NaN are left out."""
    numeric = df.select(*[_number(c).alias(c) for c in columns])
    counts = numeric.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    wanted = {
        (c, rank)
        for c in columns if counts[c]
        for p in probabilities
        for rank in {math.floor(p * (counts[c] - 1)), math.ceil(p * (counts[c] - 1))}
    }
    found = _order_statistics(numeric, wanted, counts, buffer_rows, accuracy)
    out: dict[str, list[float | None]] = {}
    for c in columns:
        n = counts[c]
        out[c] = [
            None if not n else _interpolate(
                found[c, math.floor(p * (n - 1))],
                found[c, math.ceil(p * (n - 1))],
                p * (n - 1) - math.floor(p * (n - 1)),
            )
            for p in probabilities
        ]
    return out


def _literal(value: float) -> str:
    return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"


class _Bracket:
    """An open value range, the rows below or at its low end, and the rows inside."""

    def __init__(self, column: str, rank: int, rows: int):
        self.column, self.rank = column, rank
        self.low, self.high, self.below, self.inside = None, None, 0, rows
        self.value: float | None = None

    def members(self) -> str:
        """SQL text: the value where it lies inside, else null."""
        name = f"`{self.column}`"
        limits = []
        if self.low is not None:
            limits.append(f"{name} > {_literal(self.low)}")
        if self.high is not None:
            limits.append(f"{name} < {_literal(self.high)}")
        return f"CASE WHEN {' AND '.join(limits)} THEN {name} END" if limits else name

    def position(self) -> int:
        return self.rank - self.below

    def fractions(self, margin: float) -> tuple[float, float]:
        """Where to look, rounded so that neighbouring ranks ask for the same."""
        middle = round((self.position() + 0.5) / self.inside / margin) * margin
        return max(0.0, middle - margin), min(1.0, middle + margin)

    def narrow(self, first: tuple[float, int, int], second: tuple[float, int, int]) -> None:
        """Takes the part around two inner values, (value, rows below, rows up to it), that holds the rank."""
        place = self.position()
        for value, below, upto in (first, second):
            if below <= place < upto:
                self.value = value
                return
        if place < first[1]:
            self.high, self.inside = first[0], first[1]
        elif place < second[1]:
            self.low, self.high = first[0], second[0]
            self.below, self.inside = self.below + first[2], second[1] - first[2]
        else:
            self.low, self.below, self.inside = second[0], self.below + second[2], self.inside - second[2]


def _order_statistics(
    df: DataFrame, wanted: set[tuple[str, int]], counts: dict[str, int], buffer_rows: int, accuracy: int
) -> dict[tuple[str, int], float]:
    """Value at each 0-based rank. Values at the edges of a range are counted apart,
    so a value repeated any number of times is settled at once."""
    brackets = [_Bracket(c, rank, counts[c]) for c, rank in sorted(wanted)]
    while open_ := [b for b in brackets if b.value is None]:
        # Ranks that still share a range share its column, its sketch and its counts.
        groups: dict[tuple, list[_Bracket]] = {}
        for b in open_:
            groups.setdefault((b.column, b.low, b.high), []).append(b)
        members = list(groups.values())
        inside = df.selectExpr(*[f"{group[0].members()} AS g{j}" for j, group in enumerate(members)])
        small = [(j, b) for j, group in enumerate(members) for b in group if b.inside <= buffer_rows]
        if small:
            # The half-step keeps the discrete percentile clear of rounding.
            row = inside.agg(*[
                F.expr(f"percentile_disc({(b.position() + 0.5) / b.inside!r}D) WITHIN GROUP (ORDER BY g{j})")
                for j, b in small
            ]).first()
            for (_, b), value in zip(small, row):
                b.value = value
            continue
        sketches = inside.agg(*[
            F.expr(
                f"percentile_approx(g{j}, array({', '.join(f'{f!r}D' for b in group for f in b.fractions(2.0 / accuracy))}), "
                f"{accuracy})"
            )
            for j, group in enumerate(members)
        ]).first()
        asked = [(j, value) for j, values in enumerate(sketches) for value in sorted(set(values))]
        row = inside.agg(*[
            F.expr(f"struct(count_if(g{j} < {_literal(value)}), count_if(g{j} <= {_literal(value)}))") for j, value in asked
        ]).first()
        ranks = {key: tuple(counted) for key, counted in zip(asked, row)}
        for j, group in enumerate(members):
            for i, b in enumerate(group):
                b.narrow(*((value, *ranks[j, value]) for value in sketches[j][2 * i:2 * i + 2]))
    return {(b.column, b.rank): b.value for b in brackets}
