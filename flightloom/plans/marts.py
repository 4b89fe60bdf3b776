"""Aggregate tables over the flight fact.

Every table groups first and looks names up afterwards: the grouping combines on the
map side, so a hot airport or operator shuffles one partial row per task, and the
lookup then joins a few aggregated rows rather than the fact. Tables are not sorted
when built; :func:`in_report_order` sorts at reading time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.functions import ascending, descending, hour_of, start_of
from flightloom.operators.lookup import lookup
from flightloom.operators.partials import ACTIVE_DAYS, DAY, FIRST_DAY, LAST_DAY, Partial


def flights() -> Column:
    return F.count(F.lit(1))


def events_of(flight_type: str) -> Column:
    return F.count_if(F.col("flight_type") == flight_type)


def mart_airport_traffic(fct_flights: DataFrame, dim_airports: DataFrame) -> DataFrame:
    """Airport by day. The week follows from the day, so it is no grouping key."""
    day = F.col("first_seen_at").cast("date").alias("day")
    daily = fct_flights.groupBy("airport_icao", day).agg(
        events_of("arrival").alias("arrivals"),
        events_of("departure").alias("departures"),
        flights().alias("total_flights"),
    )
    named = lookup(
        daily,
        dim_airports,
        ("airport_icao", "icao_code"),
        {"iata_code": "airport_iata", "name": "airport_name", "city": "city", "country": "country"},
    )
    return named.select(
        start_of("day", F.col("day")).alias("traffic_date"),
        start_of("week", F.col("day")).alias("traffic_week"),
        "airport_icao",
        "airport_iata",
        "airport_name",
        "city",
        "country",
        "arrivals",
        "departures",
        "total_flights",
    )


def mart_route_popularity(fct_flights: DataFrame, dim_airports: DataFrame) -> DataFrame:
    """Departure by arrival airport, both known."""
    day = F.col("first_seen_at").cast("date")
    routes = _between_airports(fct_flights).groupBy(*ROUTE).agg(
        flights().alias("flight_count"), F.min(day).alias(FIRST_DAY), F.max(day).alias(LAST_DAY)
    )
    return named_routes(routes, dim_airports)


ROUTE = ("departure_icao", "arrival_icao")


def _between_airports(fct_flights: DataFrame) -> DataFrame:
    return fct_flights.withColumnsRenamed(
        {"est_departure_airport": "departure_icao", "est_arrival_airport": "arrival_icao"}
    ).filter(F.col("departure_icao").isNotNull() & F.col("arrival_icao").isNotNull())


def named_routes(routes: DataFrame, dim_airports: DataFrame) -> DataFrame:
    """The table of routes from their counts and first and last days."""
    routes = routes.select(
        *ROUTE,
        "flight_count",
        start_of("day", F.col(FIRST_DAY)).alias("first_seen_date"),
        start_of("day", F.col(LAST_DAY)).alias("last_seen_date"),
    )
    for role in ("departure", "arrival"):
        routes = lookup(
            routes,
            dim_airports,
            (f"{role}_icao", "icao_code"),
            {
                "iata_code": f"{role}_iata",
                "name": f"{role}_airport_name",
                "city": f"{role}_city",
                "country": f"{role}_country",
            },
        )
    return routes.select(
        *[
            f"{role}_{part}"
            for role in ("departure", "arrival")
            for part in ("icao", "iata", "airport_name", "city", "country")
        ],
        "flight_count",
        "first_seen_date",
        "last_seen_date",
    )


def mart_airline_reliability(fct_flights: DataFrame, dim_airlines: DataFrame) -> DataFrame:
    """Operator. Key and names come from the airline dimension."""
    per_operator = (
        _operated(fct_flights)
        .groupBy("operator_icao")
        .agg(
            *_named(_airline_measures()),
            F.countDistinct(F.col("first_seen_at").cast("date")).alias(ACTIVE_DAYS),
        )
    )
    return named_airlines(per_operator, dim_airlines)


def _operated(fct_flights: DataFrame) -> DataFrame:
    return fct_flights.filter(F.col("operator_icao").isNotNull())


def _airline_measures() -> dict[str, Column]:
    return {
        "total_flights": flights(),
        "total_departures": events_of("departure"),
        "total_arrivals": events_of("arrival"),
        **_duration_measures(),
    }


def _duration_measures() -> dict[str, Column]:
    minutes = F.col("flight_duration_minutes")
    return {"minutes": F.sum(minutes), "timed": F.count(minutes)}


def _average_minutes() -> Column:
    mean = F.try_divide(F.col("minutes").cast("double"), F.col("timed"))
    return F.round(mean, 1).alias("avg_flight_duration_minutes")


def _named(measures: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in measures.items()]


def named_airlines(per_operator: DataFrame, dim_airlines: DataFrame) -> DataFrame:
    """The table of airlines from their counts, minutes and active days."""
    airline = ("airline_id", "operator_icao", "operator_iata", "airline_name", "operator_callsign")
    measured = per_operator.select(
        F.col("operator_icao").alias("operator"),
        "total_flights",
        "total_departures",
        "total_arrivals",
        _average_minutes(),
        ACTIVE_DAYS,
    )
    named = lookup(measured, dim_airlines, ("operator", "operator_icao"), {c: c for c in airline})
    return named.select(*airline, *measured.columns[1:])


def mart_on_time_performance(fct_flights: DataFrame, dim_airlines: DataFrame) -> DataFrame:
    """Operator by route, from flights with both airports and a positive duration."""
    per_route = _timed(fct_flights).groupBy(*AIRLINE_ROUTE).agg(*_named(_on_time_measures()))
    return named_airline_routes(per_route, dim_airlines)


AIRLINE_ROUTE = ("operator_icao", *ROUTE)


def _timed(fct_flights: DataFrame) -> DataFrame:
    return _operated(_between_airports(fct_flights)).filter(F.col("flight_duration_minutes") > 0)


def _on_time_measures() -> dict[str, Column]:
    minutes = F.col("flight_duration_minutes")
    return {
        "flight_count": flights(),
        **_duration_measures(),
        "min_flight_duration_minutes": F.min(minutes),
        "max_flight_duration_minutes": F.max(minutes),
    }


def named_airline_routes(per_route: DataFrame, dim_airlines: DataFrame) -> DataFrame:
    """The table of airlines by route from their counts and minutes."""
    airline = ("airline_id", "operator_icao", "operator_iata", "airline_name")
    measured = per_route.select(
        F.col("operator_icao").alias("operator"),
        *ROUTE,
        "flight_count",
        _average_minutes(),
        "min_flight_duration_minutes",
        "max_flight_duration_minutes",
    )
    named = lookup(measured, dim_airlines, ("operator", "operator_icao"), {c: c for c in airline})
    return named.select(*airline, *measured.columns[1:])


def mart_traffic_patterns(fct_flights: DataFrame, dim_airports: DataFrame) -> DataFrame:
    """Airport by day by hour by type of event."""
    seen = F.col("first_seen_at")
    hourly = (
        fct_flights.filter(seen.isNotNull())
        .groupBy(
            "airport_icao",
            seen.cast("date").alias("day"),
            hour_of(seen).alias("hour_of_day"),
            "flight_type",
        )
        .agg(flights().alias("flight_count"))
    )
    named = lookup(
        hourly,
        dim_airports,
        ("airport_icao", "icao_code"),
        {"iata_code": "airport_iata", "name": "airport_name", "city": "city"},
    )
    return named.select(
        start_of("day", F.col("day")).alias("traffic_date"),
        "hour_of_day",
        "airport_icao",
        "airport_iata",
        "airport_name",
        "city",
        "flight_type",
        "flight_count",
    )


def _on_its_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn(DAY, F.col("first_seen_at").cast("date"))


# The tables over all days, as aggregates whose states are kept by day and month.
ROUTES = Partial(
    "routes",
    ROUTE,
    lambda fact: _on_its_day(_between_airports(fact)),
    lambda: {"flight_count": flights()},
    {"flight_count": "sum"},
)
AIRLINES = Partial(
    "airlines",
    ("operator_icao",),
    lambda fact: _on_its_day(_operated(fact)),
    _airline_measures,
    dict.fromkeys(("total_flights", "total_departures", "total_arrivals", "minutes", "timed"), "sum"),
)
AIRLINE_ROUTES = Partial(
    "airline_routes",
    AIRLINE_ROUTE,
    lambda fact: _on_its_day(_timed(fact)),
    _on_time_measures,
    {
        **dict.fromkeys(("flight_count", "minutes", "timed"), "sum"),
        "min_flight_duration_minutes": "min",
        "max_flight_duration_minutes": "max",
    },
)
# Which aircraft flew on which days: what a changed aircraft changes in the fact.
AIRCRAFT_DAYS = Partial(
    "aircraft",
    ("icao24",),
    _on_its_day,
    lambda: {"events": flights()},
    {"events": "sum"},
)


# Reading order of each table: columns descending, then ascending down to its key.
REPORT_ORDER = {
    "mart_airport_traffic": ((), ("traffic_date", "airport_icao")),
    "mart_route_popularity": (("flight_count",), ("departure_icao", "arrival_icao")),
    "mart_airline_reliability": (("total_flights",), ("operator_icao",)),
    "mart_on_time_performance": (
        (),
        ("airline_name", "departure_icao", "arrival_icao", "operator_icao"),
    ),
    "mart_traffic_patterns": (
        (),
        ("traffic_date", "hour_of_day", "airport_icao", "flight_type"),
    ),
}


def in_report_order(table: str, df: DataFrame) -> DataFrame:
    """Rows in the order the table is read in reports, ties settled by its key."""
    down, up = REPORT_ORDER[table]
    return df.orderBy(*descending(*down), *ascending(*up))
