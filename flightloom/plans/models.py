"""The models, in dependency order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from flightloom.operators.partials import Partial
from flightloom.plans import marts, staging, star


@dataclass(frozen=True)
class Model:
    """A table or view computed from others by a function of their frames."""

    name: str
    schema: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    view: bool = False
    partition_by: str | None = None
    # Tables over all days: the states they are merged from, and how these become the table.
    partial: Partial | None = None
    finish: Callable[..., DataFrame] | None = None
    # States kept of the model's own rows.
    index: Partial | None = None


MODELS = (
    Model(
        "stg_flights",
        "staging",
        ("raw_flights",),
        staging.stg_flights,
        view=True,
        partition_by="seen_on",
    ),
    Model("stg_aircraft", "staging", ("raw_aircraft",), staging.stg_aircraft, view=True),
    Model("dim_airports", "marts", ("airports",), star.dim_airports),
    Model("dim_airlines", "marts", ("stg_aircraft",), star.dim_airlines),
    Model(
        "fct_flights",
        "marts",
        ("stg_flights", "stg_aircraft"),
        star.fct_flights,
        partition_by="flight_date",
        index=marts.AIRCRAFT_DAYS,
    ),
    Model(
        "mart_airport_traffic",
        "marts",
        ("fct_flights", "dim_airports"),
        marts.mart_airport_traffic,
    ),
    Model(
        "mart_route_popularity",
        "marts",
        ("fct_flights", "dim_airports"),
        marts.mart_route_popularity,
        partial=marts.ROUTES,
        finish=marts.named_routes,
    ),
    Model(
        "mart_airline_reliability",
        "marts",
        ("fct_flights", "dim_airlines"),
        marts.mart_airline_reliability,
        partial=marts.AIRLINES,
        finish=marts.named_airlines,
    ),
    Model(
        "mart_on_time_performance",
        "marts",
        ("fct_flights", "dim_airlines"),
        marts.mart_on_time_performance,
        partial=marts.AIRLINE_ROUTES,
        finish=marts.named_airline_routes,
    ),
    Model(
        "mart_traffic_patterns",
        "marts",
        ("fct_flights", "dim_airports"),
        marts.mart_traffic_patterns,
    ),
)
MODEL = {m.name: m for m in MODELS}
