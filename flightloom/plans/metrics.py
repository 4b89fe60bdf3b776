"""Metric layer: logical tables with dimensions, time dimensions and measures.

``metric_query`` turns names into one grouped aggregation. A query that groups flights
by an attribute of a dimension table first combines the fact per join key and then
joins the few combined rows, so the fact itself is never shuffled for the join.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.functions import ascending, descending, start_of
from flightloom.operators.lookup import lookup


@dataclass(frozen=True)
class Measure:
    """A column with its aggregation.

    ``aggregation`` is the aggregate the measure itself declares; a measure that is a
    bare column has none and takes ``default_aggregation``.
    """

    column: str
    default_aggregation: str
    aggregation: str | None = None

    @property
    def effective(self) -> str:
        return self.aggregation or self.default_aggregation


@dataclass(frozen=True)
class LogicalTable:
    """A physical table with the names that may be queried on it."""

    name: str
    primary_key: tuple[str, ...]
    dimensions: tuple[str, ...]
    time_dimensions: tuple[str, ...] = ()
    measures: Mapping[str, Measure] = field(default_factory=dict)
    # Dimension tables in reach: table name -> (own column, key of that table).
    joins: Mapping[str, tuple[str, str]] = field(default_factory=dict)


def _sums(**columns: str) -> dict[str, Measure]:
    return {name: Measure(column, "sum", "sum") for name, column in columns.items()}


_AIRLINE_DIMENSIONS = (
    "airline_id",
    "operator_icao",
    "operator_iata",
    "airline_name",
    "operator_callsign",
)

# The names and aggregations that queries rely on.
REGISTRY = {
    t.name: t
    for t in (
        LogicalTable(
            name="fct_flights",
            primary_key=("flight_id",),
            dimensions=(
                "flight_id",
                "icao24",
                "callsign",
                "flight_type",
                "airport_icao",
                "est_departure_airport",
                "est_arrival_airport",
                "operator_icao",
                "manufacturer",
            ),
            time_dimensions=("first_seen_at", "last_seen_at"),
            measures={
                "flight_count": Measure("flight_id", "count", "count"),
                "avg_flight_duration_minutes": Measure("flight_duration_minutes", "avg", "avg"),
                "total_flight_duration_minutes": Measure("flight_duration_minutes", "sum", "sum"),
            },
            joins={
                "dim_airports": ("airport_icao", "icao_code"),
                "dim_airlines": ("operator_icao", "operator_icao"),
            },
        ),
        LogicalTable(
            name="dim_airports",
            primary_key=("airport_id",),
            dimensions=("airport_id", "icao_code", "iata_code", "name", "city", "country"),
        ),
        LogicalTable(
            name="dim_airlines", primary_key=("airline_id",), dimensions=_AIRLINE_DIMENSIONS
        ),
        LogicalTable(
            name="mart_airport_traffic",
            primary_key=("airport_icao", "traffic_date"),
            dimensions=("airport_icao", "airport_iata", "airport_name", "city", "country"),
            time_dimensions=("traffic_date", "traffic_week"),
            measures=_sums(
                total_flights="total_flights",
                total_arrivals="arrivals",
                total_departures="departures",
            ),
        ),
        LogicalTable(
            name="mart_airline_reliability",
            primary_key=("operator_icao",),
            dimensions=_AIRLINE_DIMENSIONS,
            measures={
                "total_flights": Measure("total_flights", "sum"),
                "total_arrivals": Measure("total_arrivals", "sum"),
                "total_departures": Measure("total_departures", "sum"),
                # An average of the airlines' averages, each airline counting once.
                "avg_flight_duration_minutes": Measure("avg_flight_duration_minutes", "avg"),
                "active_days": Measure("active_days", "sum"),
            },
        ),
        LogicalTable(
            name="mart_route_popularity",
            primary_key=("departure_icao", "arrival_icao"),
            dimensions=tuple(
                f"{role}_{part}"
                for role in ("departure", "arrival")
                for part in ("icao", "iata", "airport_name", "city", "country")
            ),
            time_dimensions=("first_seen_date", "last_seen_date"),
            measures={"flight_count": Measure("flight_count", "sum")},
        ),
    )
}

@dataclass(frozen=True)
class Rollup:
    """How a smaller table answers questions about a larger one.

    ``keys`` are the dimensions that both have, ``time`` the smaller table's value for a time
    dimension and the grains it can be truncated to, ``counts`` its columns that hold counts by measure.
    A table that lacks rows without an entry in a dimension table answers only questions that are
    filtered through that table.
    """

    table: str
    of: str
    keys: tuple[str, ...]
    counts: Mapping[str, str]
    time: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    grains: tuple[str, ...] = ()
    only_through: str | None = None


_FROM_DAYS = ("day", "week", "month", "quarter", "year")

# From small to large: the first that covers a question answers it.
ROLLUPS = (
    Rollup(
        "mart_airline_reliability",
        "fct_flights",
        ("operator_icao",),
        {"flight_count": "total_flights"},
        only_through="dim_airlines",
    ),
    Rollup(
        "mart_airport_traffic",
        "fct_flights",
        ("airport_icao",),
        {"flight_count": "total_flights"},
        {"first_seen_at": lambda: F.col("traffic_date")},
        _FROM_DAYS,
    ),
    Rollup(
        "mart_traffic_patterns",
        "fct_flights",
        ("airport_icao", "flight_type"),
        {"flight_count": "flight_count"},
        {"first_seen_at": lambda: F.col("traffic_date") + F.col("hour_of_day") * F.expr("interval '1' hour")},
        ("hour", *_FROM_DAYS),
    ),
)


def _total(column: str) -> Column:
    """Sum of counts, which is zero over no rows at all."""
    return F.coalesce(F.sum(column), F.lit(0))


_AGGREGATES = {"count": F.count, "sum": F.sum, "avg": F.avg, "total": _total}


class UnknownName(KeyError):
    """A measure or dimension that the logical table does not offer."""


def metric_query(
    tables: Mapping[str, DataFrame],
    table: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    where: Column | str | None = None,
    grain: str | None = None,
    order: Sequence[tuple[str, str]] = (),
    limit: int | None = None,
    where_dimension: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Measures of a logical table, grouped.

    ``by`` names dimensions of the table, or ``dim_table.column`` of a dimension table
    in reach; the result columns are named after the dimension, without the table.
    ``grain`` truncates the time dimensions in ``by``. ``where`` filters rows of the
    table before grouping; ``where_dimension`` keeps rows whose entry in a dimension table
    fulfils a condition, which need not be grouped by. ``order`` holds (result column, "asc"
    or "desc") pairs; remaining group columns settle ties. ``limit`` needs an order. With
    no ``by`` the result is one row.
    """
    return _answer(
        tables, _table(table), tables[table], measures, by, where, grain, order, limit, where_dimension
    )


def routed_query(
    tables: Mapping[str, DataFrame],
    table: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    where: Column | str | None = None,
    grain: str | None = None,
    order: Sequence[tuple[str, str]] = (),
    limit: int | None = None,
    where_dimension: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """``metric_query`` on the smallest stored table that holds the answer.

    A rollup is taken if it has every measure, dimension and joined key, the time at the
    grain asked for, and the columns of ``where``; without one the table itself answers.
    """
    logical, rows = _table(table), tables[table]
    filtered = _columns_in(where, rows)
    for rollup in ROLLUPS:
        if rollup.of != table or rollup.table not in tables:
            continue
        # The times of a rollup are not those of the rows it counts: filters by time need the rows.
        if filtered <= set(rollup.keys) and _covers(rollup, logical, measures, by, grain, where_dimension or {}):
            logical, rows = _narrowed(logical, rollup), _as_larger(rollup, tables[rollup.table])
            break
    return _answer(tables, logical, rows, measures, by, where, grain, order, limit, where_dimension)


def _covers(
    rollup: Rollup,
    logical: LogicalTable,
    measures: Sequence[str],
    by: Sequence[str],
    grain: str | None,
    where_dimension: Mapping[str, Column | str],
) -> bool:
    joined = [*(d.split(".")[0] for d in by if "." in d), *where_dimension]
    needed = [d for d in by if "." not in d and d not in rollup.time]
    needed += [logical.joins[d][0] for d in joined if d in logical.joins]
    timed = any(d in rollup.time for d in by)
    return (
        set(measures) <= set(rollup.counts)
        and set(needed) <= set(rollup.keys)
        and (not timed or grain in rollup.grains)
        and (rollup.only_through is None or rollup.only_through in where_dimension)
    )


def _as_larger(rollup: Rollup, rows: DataFrame) -> DataFrame:
    """Rows of the rollup under the names of the larger table."""
    return rows.select(
        *rollup.keys,
        *[column().alias(name) for name, column in rollup.time.items()],
        *[F.col(column).alias(f"__{measure}_counted") for measure, column in rollup.counts.items()],
    )


def _narrowed(logical: LogicalTable, rollup: Rollup) -> LogicalTable:
    return LogicalTable(
        name=rollup.table,
        primary_key=(),
        dimensions=rollup.keys,
        time_dimensions=tuple(rollup.time),
        measures={m: Measure(f"__{m}_counted", "total", "total") for m in rollup.counts},
        joins={d: keys for d, keys in logical.joins.items() if keys[0] in rollup.keys},
    )


def _columns_in(where: Column | str | None, rows: DataFrame) -> set[str]:
    """Columns that a condition names, as far as its text tells; quoted text names none."""
    text = re.sub(r"'[^']*'", "", where) if isinstance(where, str) else str(where)
    words = {w.lower() for w in re.findall(r"\w+", text)}
    return {c for c in rows.columns if c.lower() in words}


def _answer(
    tables: Mapping[str, DataFrame],
    logical: LogicalTable,
    rows: DataFrame,
    measures: Sequence[str],
    by: Sequence[str],
    where: Column | str | None,
    grain: str | None,
    order: Sequence[tuple[str, str]],
    limit: int | None,
    where_dimension: Mapping[str, Column | str] | None,
) -> DataFrame:
    if limit is not None and not order:
        raise ValueError("limit without order would pick arbitrary rows")
    names = [d.split(".")[-1] for d in by]
    if len(set(names)) < len(names):
        raise ValueError(f"dimensions of the same name: {list(by)}")
    wanted = {name: _measure(logical, name) for name in measures}
    own = [d for d in by if "." not in d]
    foreign = [tuple(d.split(".", 1)) for d in by if "." in d]

    if where is not None:
        rows = rows.filter(where)
    keys = [_group_column(logical, d, grain) for d in own]
    if foreign or where_dimension:
        result = _through_dimensions(
            tables, logical, rows, keys, own, foreign, wanted, where_dimension or {}
        )
    else:
        result = rows.groupBy(*keys).agg(
            *[_AGGREGATES[m.effective](m.column).alias(n) for n, m in wanted.items()]
        )

    result = result.select(*names, *wanted)
    if order:
        sorted_by = {name for name, _ in order}
        ties = [n for n in names if n not in sorted_by]
        result = result.orderBy(*_sort_columns(order), *ascending(*ties))
    return result if limit is None else result.limit(limit)


def _through_dimensions(
    tables: Mapping[str, DataFrame],
    logical: LogicalTable,
    rows: DataFrame,
    keys: Sequence[Column],
    own: Sequence[str],
    foreign: Sequence[tuple[str, str]],
    wanted: Mapping[str, Measure],
    conditions: Mapping[str, Column | str],
) -> DataFrame:
    """Group by the keys of dimensions, join the few partial rows, group again."""
    reached = list(dict.fromkeys([*(table for table, _ in foreign), *conditions]))
    join_keys = {}
    for dimension in reached:
        if dimension not in logical.joins:
            raise UnknownName(f"{logical.name} does not join {dimension}")
        join_keys[dimension] = f"__{dimension}"

    partial = rows.groupBy(
        *keys, *[F.col(logical.joins[d][0]).alias(join_keys[d]) for d in reached]
    ).agg(*[part for name, m in wanted.items() for part in _partial(name, m)])
    for dimension, condition in conditions.items():
        chosen = tables[dimension].filter(condition)
        chosen = chosen.select(F.col(logical.joins[dimension][1]).alias(join_keys[dimension]))
        partial = partial.join(chosen, join_keys[dimension], "left_semi")
    for dimension in dict.fromkeys(table for table, _ in foreign):
        take = {column: column for table, column in foreign if table == dimension}
        for column in take:
            _check(column in _table(dimension).dimensions, f"{dimension}.{column}")
        partial = lookup(
            partial,
            tables[dimension],
            (join_keys[dimension], logical.joins[dimension][1]),
            take,
        )
    names = [*own, *[column for _, column in foreign]]
    return partial.groupBy(*names).agg(*[_final(name, m) for name, m in wanted.items()])


def _partial(name: str, measure: Measure) -> list[Column]:
    if measure.effective == "avg":
        return [
            F.sum(measure.column).alias(f"__{name}_sum"),
            F.count(measure.column).alias(f"__{name}_count"),
        ]
    return [_AGGREGATES[measure.effective](measure.column).alias(f"__{name}")]


def _final(name: str, measure: Measure) -> Column:
    if measure.effective == "avg":
        total, count = F.sum(f"__{name}_sum"), F.sum(f"__{name}_count")
        return (total / F.nullif(count, F.lit(0))).alias(name)
    total = F.sum(f"__{name}")
    # Over no rows at all a count is zero.
    counted = measure.effective in ("count", "total")
    return (F.coalesce(total, F.lit(0)) if counted else total).alias(name)


def _group_column(logical: LogicalTable, name: str, grain: str | None) -> Column:
    _check(name in logical.dimensions + logical.time_dimensions, f"{logical.name}.{name}")
    column = F.col(name)
    if grain and name in logical.time_dimensions:
        column = start_of(grain, column)
    return column.alias(name)


def _measure(logical: LogicalTable, name: str) -> Measure:
    _check(name in logical.measures, f"{logical.name}.{name}")
    return logical.measures[name]


def _table(name: str) -> LogicalTable:
    _check(name in REGISTRY, name)
    return REGISTRY[name]


def _check(known: bool, name: str) -> None:
    if not known:
        raise UnknownName(name)


def _sort_columns(order: Sequence[tuple[str, str]]) -> list[Column]:
    columns = []
    for name, direction in order:
        columns += descending(name) if direction == "desc" else ascending(name)
    return columns
