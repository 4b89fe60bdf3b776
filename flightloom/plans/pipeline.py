"""The daily job: load, build, check, keep history."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.operators import history, partials, quality
from flightloom.operators.lookup import within
from flightloom.operators.partials import Partial
from flightloom.plans.checks import CHECKS
from flightloom.plans.ledger import Ledger
from flightloom.plans.marts import AIRCRAFT_DAYS
from flightloom.plans.models import MODEL, MODELS, Model
from flightloom.plans.staging import indexed_airport, stg_aircraft
from flightloom.plans.star import AIRCRAFT_HISTORY, dim_airports
from flightloom.schemas import CONTRACTS, FLIGHT_KEY, LOAD_ID
from flightloom.session import scratch_dir
from flightloom.sinks.tables import Layers
from flightloom.sources import landing
from flightloom.sources.reference import read_aircraft

log = logging.getLogger(__name__)

# Partition of a raw flight: the day it was first seen, which its key determines.
SEEN_ON = "seen_on"

# Partition of a history row: "open", or when its version was closed.
VALIDITY = "validity"
OPEN = "open"

RESULTS_SCHEMA = (
    "run_at timestamp_ntz, model string, column string, check string, failures bigint,"
    " status string, rows_written bigint"
)


def prepare_flights(landed: DataFrame, load_id: str, grain: str = "day") -> DataFrame:
    """Landed records as rows of the raw table, with their partition value."""
    rows = landing.stamp_load(landing.snake_case(landed.drop("day")), load_id)
    seen = F.date_add(
        F.lit(date(1970, 1, 1)),
        F.floor(F.col("first_seen") / F.lit(landing.SECONDS_PER_DAY)).cast("int"),
    )
    return rows.withColumn(SEEN_ON, seen if grain == "day" else F.trunc(seen, grain).cast("date"))


def merge_flights(layers: Layers, rows: DataFrame) -> list[str | None]:
    """Merge prepared rows; the ledger has the days that change before they do."""
    note = Ledger(layers).open
    return layers.merge("raw", "flights", rows, FLIGHT_KEY, LOAD_ID, SEEN_ON, announce=note)


def ingest(
    layers: Layers,
    base: str,
    days: Sequence[date],
    load_id: str,
    grain: str = "day",
    scope: Sequence[str] | None = None,
) -> list[str | None]:
    """Load the given days; again or out of order makes no difference.

    Returns the partitions of raw flights that changed; they are open in the ledger until
    ``update`` or ``build`` has brought them into the models.

    The usual call names yesterday, a backfill names any past days. A slice that is
    missing is logged and skipped. With ``scope`` only events indexed at those airports
    are loaded, and slices delivered by airport are expected of each of them.
    """
    landing.warn_missing(layers.spark, base, days, scope)
    rows = prepare_flights(landing.read_landed(layers.spark, base, days), load_id, grain)
    if scope is not None:
        rows = within(rows, indexed_airport(), scope)
    return merge_flights(layers, rows)


def reload_aircraft(layers: Layers, path: str) -> int:
    """Replace the aircraft table by a new file and return its row count."""
    return layers.save_table("raw", "aircraft", read_aircraft(layers.spark, path))


def run(
    layers: Layers,
    base: str,
    airports: DataFrame,
    now: datetime,
    scope: Sequence[str] | None = None,
) -> Report:
    """The daily job at ``now``: load yesterday, UTC, then build what follows from all open days.

    Events are loaded for the airports of the dimension, or for those in ``scope``.
    """
    moment = now.astimezone(timezone.utc)
    if scope is None:
        scope = sorted(row[0] for row in airports.select("icao_code").distinct().collect())
    load_id = str(int(moment.timestamp()))
    ingest(layers, base, [landing.yesterday(moment)], load_id, scope=scope)
    return update(layers, airports, moment.replace(tzinfo=None))


def read_history(layers: Layers) -> DataFrame:
    return layers.table("snapshots", "aircraft_snapshot").drop(VALIDITY)


def history_as_of(layers: Layers, moment: datetime) -> DataFrame:
    """Versions valid at one moment; partitions of versions closed until then are not read."""
    stored = layers.table("snapshots", "aircraft_snapshot")
    open_or_later = (F.col(VALIDITY) == OPEN) | (F.col(VALIDITY) > _closing(moment))
    return history.as_of(stored.filter(open_or_later).drop(VALIDITY), moment)


def _closing(at: datetime) -> str:
    """Partition of the versions closed at a moment; names are in the order of time."""
    return at.strftime("%Y%m%dT%H%M%S.%f")


class OlderRound(ValueError):
    """A snapshot round before the newest one."""


def advance_history(layers: Layers, aircraft: DataFrame, at: datetime) -> None:
    """One snapshot round.

    Closed versions live in a partition per closing time; a round reads and replaces the
    open partition and adds one of its own. Running a round again first takes back what it
    did: versions it opened go, versions it closed are open again. A round before the
    newest one is refused.
    """
    target = ("snapshots", "aircraft_snapshot")
    layers.recover(*target)
    closing = _closing(at)
    moment = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    if layers.exists(*target):
        newest = layers.partitions(*target, VALIDITY, [OPEN]).agg(F.max(history.VALID_FROM)).first()[0]
        if newest is not None and at < newest:
            raise OlderRound(f"round {at} is older than {newest}")
        stored = layers.partitions(*target, VALIDITY, [OPEN, closing]).drop(VALIDITY)
        reopened = F.when(F.col(history.VALID_TO) < moment, F.col(history.VALID_TO))
        current = stored.filter(F.col(history.VALID_FROM) < moment).withColumn(history.VALID_TO, reopened)
        rows = history.revise_open(current, aircraft, AIRCRAFT_HISTORY, at)
    else:
        rows = history.first_versions(aircraft, AIRCRAFT_HISTORY, at)
    closed_at = F.date_format(history.VALID_TO, "yyyyMMdd'T'HHmmss.SSSSSS")
    placed = rows.withColumn(VALIDITY, F.coalesce(closed_at, F.lit(OPEN)))
    layers.replace_partitions(*target, placed, VALIDITY, cleared=[closing, OPEN])


class Outcome(NamedTuple):
    """Result of one column check."""

    model: str
    column: str
    check: str
    failures: int
    status: str


@dataclass
class Report:
    """What a build did: rows written per table, check outcomes, models left out."""

    rows: dict[str, int] = field(default_factory=dict)
    outcomes: list[Outcome] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)


def build(
    layers: Layers,
    airports: DataFrame,
    run_at: datetime,
    on_failure: str = "skip",
    partitioned: bool = True,
    at_once: int = 4,
) -> Report:
    """Build all models from the raw tables, checking each, dependencies first.

    With ``on_failure="skip"`` whatever depends on a model with a failed check is left
    as it was; ``"record"`` goes on regardless. Either way all outcomes are appended to
    ``quality.results``. A broken contract raises before the table is touched.
    ``partitioned=False`` leaves out the partitions that tables declare, which days
    with few rows would not fill. Staging models are stored as tables: their checks and
    the fact read them, and as views each would deduplicate the raw table again. Up to
    ``at_once`` models that do not depend on each other are built side by side, each as
    soon as its inputs are there. All open days are then closed in the ledger, for models
    that passed.
    """
    if on_failure not in ("skip", "record"):
        raise ValueError(on_failure)
    frames: dict[str, DataFrame] = {
        "raw_flights": layers.table("raw", "flights"),
        "raw_aircraft": layers.table("raw", "aircraft"),
        "airports": airports,
    }
    report = Report()
    ledger = Ledger(layers)
    # Before anything is read: days that are opened from now on stay open.
    mark = ledger.mark()

    def make(model: Model) -> tuple[DataFrame, int, list[Outcome]]:
        inputs = [frames[i] for i in model.inputs]
        if model.partial is None:
            df = model.build(*inputs)
        else:
            _build_states(layers, model.partial, inputs[0], partitioned)
            df = _from_states(layers, model, inputs[1:])
        outcomes = _contract(model, df)
        if any(o.failures for o in outcomes):
            report.outcomes += outcomes
        stored, rows = _store(layers, model, df, model.partition_by if partitioned else None)
        if model.index is not None:
            _build_states(layers, model.index, stored, partitioned)
        return stored, rows, [*outcomes, *_check(model.name, stored)]

    report.outcomes.append(_freshness(layers, run_at))
    waiting = list(MODELS)
    try:
        with ThreadPoolExecutor(at_once) as pool:
            running = {}
            while True:
                for model in [m for m in waiting if all(i in frames for i in m.inputs)]:
                    waiting.remove(model)
                    running[pool.submit(make, model)] = model
                if not running:
                    break
                done, _ = wait(running, return_when=FIRST_COMPLETED)
                for future in done:
                    model = running.pop(future)
                    stored, rows, outcomes = future.result()
                    report.outcomes += outcomes
                    report.rows[model.name] = rows
                    if on_failure == "skip" and any(o.failures for o in outcomes):
                        log.warning("%s failed its checks: dependents skipped", model.name)
                    else:
                        frames[model.name] = stored
        report.skipped = [m.name for m in waiting]
        ledger.close_all([name for name in FOLLOWING if name in frames], mark)
        if "stg_aircraft" in frames:
            advance_history(layers, frames["stg_aircraft"], run_at)
        else:
            report.skipped.append("aircraft_snapshot")
    finally:
        _record(layers, report, run_at)
    return report


# Models kept by day, with the column that says a row's day.
_BY_DAY = {
    "stg_flights": "first_seen_at",
    "fct_flights": "first_seen_at",
    "mart_airport_traffic": "traffic_date",
    "mart_traffic_patterns": "traffic_date",
}

# Models that the ledger follows, and those that show attributes of the aircraft.
FOLLOWING = (*_BY_DAY, *(m.name for m in MODELS if m.partial is not None))
SHOWING_AIRCRAFT = ("fct_flights", "mart_airline_reliability", "mart_on_time_performance")

# Tables of an aggregate's states, by day and by month.
STATES = "staging"


def update(
    layers: Layers,
    airports: DataFrame,
    run_at: datetime,
    touched: Sequence[str | None] = (),
    grain: str = "day",
    on_failure: str = "skip",
    partitioned: bool = True,
) -> Report:
    """Bring all models up to date with the days that are open in the ledger.

    The tables are those of ``build`` over everything. A flight's key determines its day, so
    days that are not open stay as they are: staging, fact and the two daily tables
    replace the open ones, checks look at these, and tables over all days are merged from
    states of which only those of open days are computed again. The fact shows the current
    operator of each aircraft: for aircraft that changed, an index gives the days they flew
    on, which are opened for what shows it. A day is closed for a model that has stored it and passed
    its checks, so days that failed, or that a crash left out, come again with the next
    run. Tables that are not there yet and a change of the airports ask for the whole build.
    ``touched`` names further days; ``grain`` is that of the raw partitions.
    """
    ledger = Ledger(layers)
    aircraft = stg_aircraft(layers.table("raw", "aircraft"))
    if not _all_there(layers) or _differ(dim_airports(airports), layers.table("marts", "dim_airports")):
        return build(layers, airports, run_at, on_failure, partitioned)
    _open_days_of_aircraft(layers, ledger, aircraft, grain)
    days = {
        name: {**dict.fromkeys(touched, 0), **opened}
        for name, opened in ledger.open_days(FOLLOWING).items()
    }
    report = Report()
    report.outcomes.append(_freshness(layers, run_at))
    frames = {"raw_aircraft": layers.table("raw", "aircraft"), "airports": airports}
    failed: set[str] = set()
    closed: dict[str, dict[str | None, int]] = {}
    try:
        for model in MODELS:
            if failed & set(model.inputs):
                failed.add(model.name)
                report.skipped.append(model.name)
                continue
            own = days.get(model.name, {})
            changed = _Days(own, grain)
            inputs = [
                _input_days(layers, i, changed) if i in _BY_DAY or i == "raw_flights" else frames[i]
                for i in model.inputs
            ]
            if model.partial is None:
                df = model.build(*inputs)
            else:
                _replace_states(layers, model.partial, inputs[0], changed, partitioned)
                df = _from_states(layers, model, inputs[1:])
            report.outcomes += _contract(model, df)
            if model.name not in _BY_DAY:
                stored, rows = _store(layers, model, df, None)
                frames[model.name] = stored
            else:
                rows = _replace_days(layers, model, df, changed, partitioned)
                stored = _input_days(layers, model.name, changed)
                if model.index is not None:
                    _replace_states(layers, model.index, stored, changed, partitioned)
            outcomes = _check(model.name, stored)
            report.outcomes += outcomes
            report.rows[model.name] = rows
            if on_failure == "skip" and any(o.failures for o in outcomes):
                log.warning("%s failed its checks: dependents skipped", model.name)
                failed.add(model.name)
            else:
                closed[model.name] = {day: mark for day, mark in own.items() if mark}
        if "stg_aircraft" in failed:
            report.skipped.append("aircraft_snapshot")
        else:
            advance_history(layers, aircraft, run_at)
    finally:
        ledger.close(closed)
        _record(layers, report, run_at)
    ledger.settle(FOLLOWING)
    return report


def _all_there(layers: Layers) -> bool:
    states = [p for m in MODELS for p in (m.partial, m.index) if p is not None]
    names = [(m.schema, m.name) for m in MODELS]
    names += [(STATES, name) for p in states for name in (by_day(p), by_month(p))]
    return all(layers.exists(*name) for name in names)


def by_day(partial: Partial) -> str:
    return f"{partial.name}_by_day"


def by_month(partial: Partial) -> str:
    return f"{partial.name}_by_month"


def _build_states(layers: Layers, partial: Partial, rows: DataFrame, partitioned: bool) -> None:
    place = partials.MONTH if partitioned else None
    layers.save_table(STATES, by_day(partial), partial.by_day(rows), place)
    daily = layers.table(STATES, by_day(partial))
    layers.save_table(STATES, by_month(partial), partial.by_month(daily), place)


def _replace_states(
    layers: Layers, partial: Partial, rows: DataFrame, changed: _Days, partitioned: bool
) -> None:
    """States of the changed days anew, from their rows, and of the months they are in."""
    if not changed.listed:
        return
    touched, fresh = changed.holds(partials.DAY), partial.by_day(rows)
    months = partials.months_of(changed.listed, changed.grain)
    if not partitioned:
        kept = layers.table(STATES, by_day(partial)).filter(~touched)
        layers.save_table(STATES, by_day(partial), kept.unionByName(fresh))
        anew = F.coalesce(F.col(partials.MONTH).isin(*map(date.fromisoformat, months)), F.lit(False))
        daily = layers.table(STATES, by_day(partial)).filter(anew)
        others = layers.table(STATES, by_month(partial)).filter(~anew)
        layers.save_table(STATES, by_month(partial), others.unionByName(partial.by_month(daily)))
        return

    def replace(name: str, df: DataFrame) -> None:
        # Months that have lost all their rows go as well.
        layers.replace_partitions(STATES, name, df, partials.MONTH, cleared=months)

    kept = layers.partitions(STATES, by_day(partial), partials.MONTH, months).filter(~touched)
    replace(by_day(partial), kept.unionByName(fresh))
    daily = layers.partitions(STATES, by_day(partial), partials.MONTH, months)
    replace(by_month(partial), partial.by_month(daily))


def _from_states(layers: Layers, model: Model, dimensions: Sequence[DataFrame]) -> DataFrame:
    months = layers.table(STATES, by_month(model.partial))
    return model.finish(model.partial.total(months), *dimensions)


def _open_days_of_aircraft(layers: Layers, ledger: Ledger, aircraft: DataFrame, grain: str) -> None:
    """Open the days on which aircraft flew whose attributes have changed.

    This comes before the aircraft are stored: once they are, the change no longer shows.
    """
    place = scratch_dir(layers.spark, "changed-aircraft")
    _unequal(aircraft, layers.table("staging", "stg_aircraft")).select("icao24").distinct().write.parquet(place)
    keys = layers.spark.read.parquet(place)
    if keys.isEmpty():
        return
    months = layers.table(STATES, by_month(AIRCRAFT_DAYS)).join(keys, "icao24", "left_semi")
    period = F.col(partials.DAY) if grain == "day" else F.trunc(partials.DAY, grain)
    found = partials.days_of(months).select(period.cast("string")).distinct().collect()
    if found:
        ledger.open([row[0] for row in found], models=SHOWING_AIRCRAFT)


class _Days:
    """Some days (or the periods of raw partitions) and the condition that a row is of them."""

    def __init__(self, days: Iterable[str | None], grain: str) -> None:
        self.all = list(days)
        # Flights without a time have a raw partition, but are in no model.
        self.listed = sorted(date.fromisoformat(d) for d in self.all if d is not None)
        self.grain = grain

    def holds(self, column: str) -> Column:
        day = F.col(column).cast("date")
        period = day if self.grain == "day" else F.trunc(day, self.grain)
        return F.coalesce(period.isin(*self.listed), F.lit(False))


def _input_days(layers: Layers, name: str, days: _Days) -> DataFrame:
    """Rows of a table of the given days, by its partitions if it has them."""
    if name == "raw_flights":
        return layers.partitions("raw", "flights", SEEN_ON, days.all)
    model = MODEL[name]
    table = layers.table(model.schema, name)
    column = model.partition_by if model.partition_by in table.columns else _BY_DAY[name]
    return table.filter(days.holds(column)).select(*[c for c in table.columns if c != SEEN_ON])


def _replace_days(
    layers: Layers, model: Model, df: DataFrame, days: _Days, partitioned: bool
) -> int:
    if model.name in CONTRACTS:
        df = quality.enforce_contract(df, CONTRACTS[model.name], model.name)
    if not days.listed:
        return 0
    if partitioned and model.partition_by:
        return layers.replace_partitions(model.schema, model.name, _placed(model, df), model.partition_by)
    kept = layers.table(model.schema, model.name).filter(~days.holds(_BY_DAY[model.name]))
    return layers.save_table(model.schema, model.name, kept.unionByName(df))


def _placed(model: Model, df: DataFrame) -> DataFrame:
    """With the partition column, which a model may not have among its own."""
    if model.partition_by in df.columns:
        return df
    return df.withColumn(model.partition_by, F.col(_BY_DAY[model.name]).cast("date"))


def _stored(layers: Layers, model: Model, columns: Sequence[str]) -> DataFrame:
    return layers.table(model.schema, model.name).select(*columns)


def _differ(new: DataFrame, old: DataFrame) -> bool:
    """Whether two tables with unique rows differ."""
    return not _unequal(new, old).isEmpty()


def _unequal(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows that one of two tables with unique rows has and the other lacks."""
    sides = new.withColumn("side", F.lit(1)).unionByName(old.withColumn("side", F.lit(-1)))
    balance = sides.groupBy(*new.columns).agg(F.sum("side").alias("n"))
    return balance.filter(F.col("n") != 0).drop("n")


def _freshness(layers: Layers, run_at: datetime) -> Outcome:
    """From the ledger, where merges note their loads; the raw table is scanned only if none did."""
    loads = Ledger(layers).loads(LOAD_ID)
    raw = layers.table("raw", "flights") if loads is None else loads
    found = quality.freshness(raw, LOAD_ID, run_at).first()
    late = 0 if found["status"] == "pass" else 1
    return Outcome("raw_flights", LOAD_ID, "freshness", late, found["status"])


def _contract(model: Model, df: DataFrame) -> list[Outcome]:
    if model.name not in CONTRACTS:
        return []
    n = len(quality.contract_differences(df, CONTRACTS[model.name]))
    return [Outcome(model.name, "", "contract", n, "fail" if n else "pass")]


def _store(
    layers: Layers, model: Model, df: DataFrame, partition_by: str | None
) -> tuple[DataFrame, int]:
    if model.name in CONTRACTS:
        df = quality.enforce_contract(df, CONTRACTS[model.name], model.name)
    placed = _placed(model, df) if partition_by else df
    rows = layers.save_table(model.schema, model.name, placed, partition_by)
    return _stored(layers, model, df.columns), rows


def _check(model: str, df: DataFrame) -> list[Outcome]:
    """All checks of a model in one pass, plus one for each further unique column."""
    mine = [c for c in CHECKS if c.model == model]
    if not mine:
        return []
    unique = [c.column for c in mine if c.kind == "unique"]
    passes = [
        quality.failure_counts(
            df,
            unique[0] if unique else None,
            [c.column for c in mine if c.kind == "not_null"],
            {c.column: c.values for c in mine if c.kind == "accepted_values"},
        )
    ]
    passes += [quality.failure_counts(df, column, [], {}) for column in unique[1:]]
    failures: dict[str, int | None] = {}
    for counts in passes:
        failures.update(counts)
    outcomes = []
    for check in mine:
        # A sum over no rows at all is null: nothing failed.
        failed = failures[f"{check.kind}:{check.column}"] or 0
        status = "fail" if failed else "pass"
        outcomes.append(Outcome(model, check.column, check.kind, failed, status))
    return outcomes


def _record(layers: Layers, report: Report, run_at: datetime) -> None:
    """Append what is known of a run: check outcomes, rows by model, models left out."""
    rows = [(run_at, *outcome, None) for outcome in report.outcomes]
    rows += [(run_at, name, "", "build", 0, "built", n) for name, n in report.rows.items()]
    rows += [(run_at, name, "", "build", 0, "skipped", None) for name in report.skipped]
    if rows:
        layers.append("quality", "results", layers.spark.createDataFrame(rows, RESULTS_SCHEMA))
