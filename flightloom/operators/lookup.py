"""Left outer lookups.

There are no broadcast hints: Catalyst and AQE broadcast a dimension whose measured size
is below the limit. Beyond it they sort and merge, and AQE splits the partition of a hot
key over several tasks. That needs a shuffle right below the join on both sides, so a
dimension that is itself computed by the lookup key should be stored first, as the daily
job does; it would otherwise be joined in the partitioning it already has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    on: tuple[str, str],
    take: Mapping[str, str],
) -> DataFrame:
    """Add columns of a dimension with unique keys; no match gives nulls.

    ``on`` is (column of ``df``, key of ``dimension``); ``take`` maps dimension
    columns to the names they get. The dimension may be looked up again in another
    role under other names.
    """
    left_key, right_key = on
    key = "__lookup_key"
    side = dimension.select(
        F.col(right_key).alias(key),
        *[F.col(source).alias(target) for source, target in take.items()],
    )
    return df.join(side, df[left_key] == side[key], "left").drop(key)


def within(df: DataFrame, column: Column, codes: Sequence[str]) -> DataFrame:
    """Rows whose code is one of a short fixed list."""
    return df.filter(column.isin(*codes))
