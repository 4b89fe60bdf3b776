"""Curated questions, each a function of the tables by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.functions import ascending, descending
from flightloom.operators.reshape import top_k
from flightloom.plans.metrics import metric_query

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Curated:
    question: str
    answer: Callable[[Tables], DataFrame]


def busiest_airports(tables: Tables) -> DataFrame:
    return metric_query(
        tables,
        "mart_airport_traffic",
        ["total_flights"],
        by=["airport_name", "city"],
        order=[("total_flights", "desc")],
    )


def top_routes(tables: Tables, k: int = 10) -> DataFrame:
    ranked = top_k(
        tables["mart_route_popularity"], "flight_count", k, ["departure_icao", "arrival_icao"]
    )
    return ranked.select(
        "departure_iata", "arrival_iata", "departure_city", "arrival_city", "flight_count"
    )


def most_active_airlines(tables: Tables, k: int = 20) -> DataFrame:
    named = tables["mart_airline_reliability"].filter(F.col("airline_name").isNotNull())
    return top_k(named, "total_flights", k, ["operator_icao"]).select(
        "airline_name", "operator_iata", "total_flights", "avg_flight_duration_minutes"
    )


def daily_traffic(tables: Tables, airport_iata: str) -> DataFrame:
    days = tables["mart_airport_traffic"].filter(F.col("airport_iata") == airport_iata)
    return days.agg(F.avg("total_flights").alias("avg_daily_flights"))


def arrivals_vs_departures(tables: Tables) -> DataFrame:
    """Totals per airport and their ratio, null where nothing departed."""
    per_airport = metric_query(
        tables,
        "mart_airport_traffic",
        ["total_arrivals", "total_departures"],
        by=["airport_iata", "airport_name"],
    )
    ratio = F.col("total_arrivals") / F.nullif(F.col("total_departures"), F.lit(0))
    with_ratio = per_airport.withColumn("arrival_departure_ratio", F.round(ratio, 2))
    return with_ratio.orderBy(
        *descending("total_arrivals"), *ascending("airport_iata", "airport_name")
    )


def weekly_traffic(tables: Tables) -> DataFrame:
    return metric_query(
        tables,
        "mart_airport_traffic",
        ["total_flights"],
        by=["traffic_week"],
        order=[("traffic_week", "asc")],
    )


def routes_from(tables: Tables, departure_iata: str) -> DataFrame:
    routes = tables["mart_route_popularity"].filter(F.col("departure_iata") == departure_iata)
    return routes.orderBy(*descending("flight_count"), *ascending("arrival_icao")).select(
        "arrival_iata", "arrival_city", "arrival_country", "flight_count"
    )


def longest_average_flights(tables: Tables, k: int = 15, more_than: int = 10) -> DataFrame:
    """Named airlines by average duration, leaving out those with few flights."""
    airlines = tables["mart_airline_reliability"].filter(
        F.col("airline_name").isNotNull() & (F.col("total_flights") > more_than)
    )
    return top_k(airlines, "avg_flight_duration_minutes", k, ["operator_icao"]).select(
        "airline_name", "operator_iata", "avg_flight_duration_minutes", "total_flights"
    )


# The names under which the questions are found.
CURATED: dict[str, Curated] = {
    "busiest_airports": Curated("Which airports see the most flights?", busiest_airports),
    "top_routes": Curated("Which ten routes are flown most?", top_routes),
    "most_active_airlines": Curated("Which airlines fly the most?", most_active_airlines),
    "daily_traffic_heathrow": Curated(
        "How many flights a day does Heathrow see on average?",
        lambda tables: daily_traffic(tables, "LHR"),
    ),
    "arrivals_vs_departures_by_airport": Curated(
        "How do arrivals compare with departures at each airport?", arrivals_vs_departures
    ),
    "weekly_traffic_trend": Curated("How does traffic develop by week?", weekly_traffic),
    "routes_from_paris": Curated(
        "Where do flights from Paris CDG go most?", lambda tables: routes_from(tables, "CDG")
    ),
    "airline_avg_duration": Curated(
        "Which airlines fly longest on average?", longest_average_flights
    ),
}


def answer(name: str, tables: Tables) -> DataFrame:
    """Answer of a curated question, found by its name."""
    return CURATED[name].answer(tables)
