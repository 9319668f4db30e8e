"""Column selection, filters and reshaping of whole tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F, types as T


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*columns)


def columns_of_type(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def text_and_boolean(df: DataFrame) -> DataFrame:
    """The categorical part of a table, chosen by type."""
    return df.select(*columns_of_type(df, T.StringType, T.BooleanType))


def countable_columns(df: DataFrame, categorical: list[str]) -> list[str]:
    return [c for c in df.columns if c not in categorical]


def align(df: DataFrame, order: list[str], fill: float = 0.0) -> DataFrame:
    """Exactly the given columns in order: extras go, missing ones become ``fill``.

    Nulls already in the table stay nulls.
    """
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in present else F.lit(fill).alias(c) for c in order])


def keep_all_within(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows whose every listed column lies in its inclusive range."""
    if not limits:
        return df
    return df.filter(reduce(and_, [F.col(c).between(*limits[c]) for c in limits]))


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """The first rows by a stated key."""
    return df.orderBy(key).limit(rows)


def unpivot(df: DataFrame, columns: list[str], kind: str, keep: list[str] | None = None) -> DataFrame:
    """(keep.., column, value) rows, all values cast to one type."""
    values = df.select(*(keep or []), *[F.col(c).cast(kind).alias(f"_{c}") for c in columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_{c}").alias("value")) for c in columns
    ])
    return values.select(*(keep or []), F.inline(pairs))
