"""Frames behind the dashboard pages. Post-processing stays in Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.functions import ascending, descending, joined_label
from flightloom.operators.reshape import (
    both_present,
    keep_selected,
    melt,
    pivot_sum,
    sum_by,
    top_k,
    totals,
)

HOURS = range(24)


def airport_traffic(mart_airport_traffic: DataFrame) -> DataFrame:
    per_airport = mart_airport_traffic.groupBy("airport_iata", "airport_name", "city").agg(
        F.sum("total_flights").alias("total_flights"),
        F.sum("arrivals").alias("total_arrivals"),
        F.sum("departures").alias("total_departures"),
    )
    return per_airport.orderBy(
        *descending("total_flights"), *ascending("airport_iata", "airport_name", "city")
    )


def traffic_totals(traffic: DataFrame) -> DataFrame:
    return totals(traffic, "total_flights", "total_arrivals", "total_departures")


def arrivals_and_departures(traffic: DataFrame) -> DataFrame:
    return melt(
        traffic, ["airport_iata"], ["total_arrivals", "total_departures"], "Type", "Flights"
    )


def top_routes(mart_route_popularity: DataFrame, k: int = 20) -> DataFrame:
    """Top routes with labels.

    Routes with an unknown end leave after the ranking, so there may be fewer than ``k``.
    """
    ranked = top_k(mart_route_popularity, "flight_count", k, ["departure_icao", "arrival_icao"])
    known = ranked.select(
        "departure_iata",
        "departure_city",
        "arrival_iata",
        "arrival_city",
        "flight_count",
        "first_seen_date",
        "last_seen_date",
    ).filter(both_present("departure_iata", "arrival_iata"))
    return known.withColumns(
        {
            "route": joined_label(F.col("departure_iata"), F.col("arrival_iata")),
            "label": joined_label(F.col("departure_city"), F.col("arrival_city")),
        }
    )


# Column headings shown to readers.
ROUTE_HEADINGS = {
    "route": "Route",
    "label": "Cities",
    "flight_count": "Flights",
    "first_seen_date": "First Seen",
    "last_seen_date": "Last Seen",
}
AIRLINE_HEADINGS = {
    "airline_name": "Airline",
    "operator_icao": "ICAO",
    "operator_iata": "IATA",
    "total_flights": "Total Flights",
    "total_arrivals": "Arrivals",
    "total_departures": "Departures",
    "avg_flight_duration_minutes": "Avg Duration (min)",
    "active_days": "Active Days",
}
HOUR_HEADINGS = {"hour_of_day": "Hour", "flight_count": "Flights"}


def with_headings(df: DataFrame, headings: dict[str, str]) -> DataFrame:
    """The columns that have a heading, under that heading."""
    return df.select(*headings).withColumnsRenamed(headings)


def airlines(mart_airline_reliability: DataFrame, k: int = 30) -> DataFrame:
    named = mart_airline_reliability.filter(F.col("airline_name").isNotNull())
    return top_k(named, "total_flights", k, ["operator_icao"]).select(*AIRLINE_HEADINGS)


def leading(ranked_airlines: DataFrame, k: int = 15) -> DataFrame:
    """Head of an already ranked frame; ranks again, as row order is not a property of data."""
    return top_k(ranked_airlines, "total_flights", k, ["operator_icao"])


def airport_hours(mart_traffic_patterns: DataFrame) -> DataFrame:
    per_hour = mart_traffic_patterns.groupBy("airport_iata", "hour_of_day").agg(
        F.sum("flight_count").alias("flight_count")
    )
    return per_hour.orderBy(*ascending("airport_iata", "hour_of_day"))


def hour_heatmap(hours: DataFrame, selected: Sequence[str] = ()) -> DataFrame:
    """Airport by hour; all 24 hours have a column."""
    chosen = keep_selected(hours, "airport_iata", selected)
    return pivot_sum(chosen, "airport_iata", "hour_of_day", list(HOURS), "flight_count")


def hourly_totals(hours: DataFrame, selected: Sequence[str] = ()) -> DataFrame:
    chosen = keep_selected(hours, "airport_iata", selected)
    return sum_by(chosen, "hour_of_day", "flight_count")
