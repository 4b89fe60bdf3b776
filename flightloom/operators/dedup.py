"""One row per key.

``row_number() = 1`` plans as a group limit on both sides of the shuffle, so a task
ships at most one row per key: a key that holds a third of all rows costs one row
per map task, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.functions import ascending, descending


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order; null is a key value like any other."""
    rank = "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def latest_per_key(df: DataFrame, keys: Sequence[str], recency: str) -> DataFrame:
    """Row with the highest ``recency`` per key (null counts as highest).

    Rows that tie are told apart by all other columns, so reruns agree.
    """
    rest = [c for c in df.columns if c not in (*keys, recency)]
    return first_per_key(df, keys, descending(recency, *rest))


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the lowest by all other columns, so reruns agree."""
    rest = [c for c in df.columns if c not in keys]
    return first_per_key(df, keys, ascending(*rest))
