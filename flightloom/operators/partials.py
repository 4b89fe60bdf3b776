"""Stored partial states of an aggregate: by key and day, then by key and month.

Sums, counts, minima and maxima merge, so an aggregate over all days is a merge of states, and
when some days change only their states are computed again. The days of a key in a month are a
bitmap, a number with one bit per day: united by OR, its bits count distinct days exactly, however
states overlap.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY, MONTH, DAYS = "day", "month", "days"
FIRST_DAY, LAST_DAY, ACTIVE_DAYS = "first_day", "last_day", "active_days"

_MERGE: Mapping[str, Callable[[str], Column]] = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Partial:
    """An aggregate that merges.

    ``rows`` picks the rows that count, with a column ``day`` and the keys; ``measures`` gives
    the aggregates of one day, and ``merged_by`` how each goes on: by sum, min or max.
    """

    name: str
    keys: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame]
    measures: Callable[[], Mapping[str, Column]]
    merged_by: Mapping[str, str]

    def by_day(self, df: DataFrame) -> DataFrame:
        """State of each key and day of the given rows."""
        aggregates = [column.alias(name) for name, column in self.measures().items()]
        month = F.trunc(DAY, "month").alias(MONTH)
        return self.rows(df).groupBy(DAY, *self.keys).agg(*aggregates).select("*", month)

    def by_month(self, daily: DataFrame) -> DataFrame:
        """State of each key and month from the states of its days."""
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(DAY) - 1)
        days = [F.bit_or(bit).alias(DAYS), F.min(DAY).alias(FIRST_DAY), F.max(DAY).alias(LAST_DAY)]
        return daily.groupBy(MONTH, *self.keys).agg(*self._merged(), *days)

    def united(self, months: DataFrame) -> DataFrame:
        """One state of each key and month from several, whose days may overlap."""
        days = [F.bit_or(DAYS).alias(DAYS), F.min(FIRST_DAY).alias(FIRST_DAY), F.max(LAST_DAY).alias(LAST_DAY)]
        return months.groupBy(MONTH, *self.keys).agg(*self._merged(), *days)

    def total(self, months: DataFrame) -> DataFrame:
        """Each key over all days, from one state a month, with its number of active days."""
        return months.groupBy(*self.keys).agg(
            *self._merged(),
            F.sum(F.bit_count(DAYS).cast("bigint")).alias(ACTIVE_DAYS),
            F.min(FIRST_DAY).alias(FIRST_DAY),
            F.max(LAST_DAY).alias(LAST_DAY),
        )

    def _merged(self) -> list[Column]:
        return [_MERGE[kind](name).alias(name) for name, kind in self.merged_by.items()]


def days_of(months: DataFrame) -> DataFrame:
    """The different days that the bitmaps of some states hold."""
    held = months.groupBy(MONTH).agg(F.bit_or(DAYS).alias(DAYS))
    of_month = F.filter(
        F.sequence(F.lit(0), F.lit(30)),
        lambda d: F.call_function("getbit", F.col(DAYS), d) == 1,
    )
    return held.select(F.explode(F.transform(of_month, lambda d: F.date_add(F.col(MONTH), d))).alias(DAY))


def months_of(days: Sequence, grain: str) -> list[str]:
    """First days, as text, of the months that the given periods touch."""
    length = {"day": 1, "week": 2, "month": 1, "quarter": 3, "year": 12}[grain]
    found = set()
    for day in days:
        start = day.year * 12 + day.month - 1
        found |= {start + i for i in range(length)}
    return sorted(f"{m // 12:04d}-{m % 12 + 1:02d}-01" for m in found)
