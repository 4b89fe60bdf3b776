"""Type-2 history: one row per version of a key, with its validity interval.

Versions of a key never overlap. ``valid_from`` is inclusive, ``valid_to`` exclusive
and null for the open version. The change time is an argument, so results repeat.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.functions import history_row_id

# Names of the columns the history adds.
ROW_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"


@dataclass(frozen=True)
class HistorySpec:
    """Which column identifies a row and which columns open a new version."""

    key: str
    checked: tuple[str, ...]
    carried: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.carried]


def first_versions(source: DataFrame, spec: HistorySpec, at: datetime) -> DataFrame:
    """Every row of the source as an open version."""
    when = _moment(at)
    return source.select(
        *spec.columns,
        history_row_id(spec.key, when).alias(ROW_ID),
        when.alias(UPDATED_AT),
        when.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


def open_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col(VALID_TO).isNull())


def revise_open(open_rows: DataFrame, source: DataFrame, spec: HistorySpec, at: datetime) -> DataFrame:
    """What the open versions become: kept, closed, or followed by a new version.

    One full outer join of two frames with unique keys; each pair turns into one row
    or, for a changed key, two. Keys that left the source stay open, and a change
    outside the checked columns leaves the stored row as it is.
    """
    when = _moment(at)
    stored = open_rows.select(F.struct(*open_rows.columns).alias("old"))
    fresh = first_versions(source, spec, at)
    incoming = fresh.select(F.struct(*open_rows.columns).alias("new"))
    joined = stored.join(incoming, F.col(f"old.{spec.key}") == F.col(f"new.{spec.key}"), "full_outer")

    old, new = F.col("old"), F.col("new")
    changed = reduce(or_, [~old[c].eqNullSafe(new[c]) for c in spec.checked])
    outcome = (
        F.when(old.isNull(), F.array(new))
        .when(new.isNull() | ~changed, F.array(old))
        .otherwise(F.array(_closed(old, open_rows.columns, when), new))
    )
    return joined.select(F.inline(outcome))


def next_history(history: DataFrame, source: DataFrame, spec: HistorySpec, at: datetime) -> DataFrame:
    """Whole history after one more round; closed versions pass through unjoined."""
    closed = history.filter(F.col(VALID_TO).isNotNull())
    return closed.unionByName(revise_open(open_versions(history), source, spec, at))


def as_of(history: DataFrame, moment: datetime) -> DataFrame:
    """Versions valid at one moment."""
    return history.filter(_covers(F.col(VALID_FROM), F.col(VALID_TO), _moment(moment)))


def attribute_at_event(
    events: DataFrame,
    history: DataFrame,
    key: str,
    event_time: str,
    take: Sequence[str],
) -> DataFrame:
    """Events with the attributes valid when they happened; nulls where none was.

    An equi join on the key with the interval as a residual condition. Intervals of
    one key do not overlap, so each event keeps exactly one row, and a key has at most
    one version per snapshot round, which bounds the versions tested per event. AQE
    splits the event side of a hot key.
    """
    versions = history.select(
        F.col(key).alias("__key"),
        F.col(VALID_FROM).alias("__from"),
        F.col(VALID_TO).alias("__to"),
        *[F.col(c).alias(c) for c in take],
    )
    matches = (events[key] == versions["__key"]) & _covers(
        versions["__from"], versions["__to"], events[event_time]
    )
    return events.join(versions, matches, "left").drop("__key", "__from", "__to")


def attribute_in_order(
    events: DataFrame,
    history: DataFrame,
    key: str,
    event_time: str,
    take: Sequence[str],
) -> DataFrame:
    """As ``attribute_at_event``, for keys with many versions: no event meets them all.

    Two ordered passes carry the last version forward. The first runs over the versions of a
    key and the different days of its events, and gives the version with which each day begins;
    the second over the events and versions of one day. So a key with very many events is
    spread by day, and each row is sorted among those of its day. Events without key or time
    have no attributes and go around both.
    """
    at, day, kind, version = "__at", "__day", "__kind", "__version"
    begin, change, event = 0, 1, 2
    placed = F.col(key).isNotNull() & F.col(event_time).isNotNull()
    known = events.filter(placed).select(
        F.col(key).alias("__key"),
        F.col(event_time).cast("timestamp_ntz").alias(at),
        F.struct(*events.columns).alias("__event"),
    )
    changes = history.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"),
        F.col(VALID_FROM).alias(at),
        F.struct(F.col(VALID_TO).alias("__to"), *take).alias(version),
    )
    held = changes.schema[version].dataType

    def carried(rows: DataFrame, *partition: str) -> DataFrame:
        so_far = Window.partitionBy(*partition).orderBy(at, kind).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn(version, F.last(version, ignorenulls=True).over(so_far))

    nothing = F.lit(None).cast(held).alias(version)
    days = known.select("__key", F.col(at).cast("date").cast("timestamp_ntz").alias(at)).distinct()
    of_keys = changes.withColumn(kind, F.lit(change)).unionByName(
        days.select("__key", at, nothing, F.lit(event).alias(kind))
    )
    # A change at the very start of a day is found in both passes.
    starts = carried(of_keys, "__key").filter(F.col(kind) == event)
    none = F.lit(None).cast(known.schema["__event"].dataType).alias("__event")
    rows = [
        starts.select("__key", at, version, none, F.lit(begin).alias(kind)),
        changes.select("__key", at, version, none, F.lit(change).alias(kind)),
        known.select("__key", at, nothing, "__event", F.lit(event).alias(kind)),
    ]
    of_days = reduce(DataFrame.unionByName, rows).withColumn(day, F.col(at).cast("date"))
    found = carried(of_days, "__key", day).filter(F.col(kind) == event)
    ended = F.col(f"{version}.__to") <= F.col(at)
    valid = F.when(F.col(version).isNotNull() & F.coalesce(~ended, F.lit(True)), F.col(version))
    answered = found.withColumn(version, valid).select("__event.*", *[F.col(f"{version}.{c}").alias(c) for c in take])
    kinds = {c: held[c].dataType for c in take}
    around = events.filter(~placed).select("*", *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()])
    return answered.unionByName(around)


def _covers(valid_from: Column, valid_to: Column, moment: Column) -> Column:
    return (valid_from <= moment) & (valid_to.isNull() | (moment < valid_to))


def _closed(row: Column, columns: Sequence[str], when: Column) -> Column:
    return F.struct(*[(when if c == VALID_TO else row[c]).alias(c) for c in columns])


def _moment(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
