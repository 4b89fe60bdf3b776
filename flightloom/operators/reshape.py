"""Reshaping, ranking and selection of small result frames, done in Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.functions import ascending, descending


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str
) -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(values), name, value)


def pivot_sum(
    df: DataFrame, index: str, columns: str, labels: Sequence[int], value: str
) -> DataFrame:
    """Long to wide with sums; an empty cell is 0 and rows without an index value go.

    The labels are given, so no extra job is needed to find them and the schema does
    not depend on the data.
    """
    wide = (
        df.filter(F.col(index).isNotNull())
        .groupBy(index)
        .pivot(columns, list(labels))
        .agg(F.sum(value))
    )
    return wide.na.fill(0)


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``k`` rows highest in ``by`` (nulls first), ties settled by ``tie_break``."""
    return df.orderBy(*descending(by), *ascending(*tie_break)).limit(k)


def keep_selected(df: DataFrame, column: str, selected: Sequence[str]) -> DataFrame:
    """Rows whose value is selected; an empty selection keeps everything, nulls included."""
    return df.filter(F.col(column).isin(*selected)) if selected else df


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values without null."""
    return df.select(column).dropna().distinct().orderBy(column)


def totals(df: DataFrame, *columns: str) -> DataFrame:
    """Sum of each column over the whole frame."""
    return df.agg(*[F.sum(c).alias(c) for c in columns])


def sum_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum per key, leaving out rows without a key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias(value))


def both_present(*columns: str) -> Column:
    first, *rest = [F.col(c).isNotNull() for c in columns]
    for condition in rest:
        first = first & condition
    return first
