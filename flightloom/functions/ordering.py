"""Sort order with nulls treated as the largest value, in both directions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascending(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def descending(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_first() for n in names]
