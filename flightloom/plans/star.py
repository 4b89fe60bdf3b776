"""Star schema: the flight fact, its two dimensions and the aircraft history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.functions import ascending, minutes_between, surrogate_key
from flightloom.operators.dedup import first_per_key
from flightloom.operators.history import HistorySpec
from flightloom.operators.lookup import lookup
from flightloom.schemas import AIRPORT_COLUMNS

AIRCRAFT_ON_FLIGHT = (
    "operator",
    "operator_callsign",
    "operator_icao",
    "operator_iata",
    "manufacturer",
    "typecode",
)

# A change of the operator opens a new version; a change of the airframe data does not.
AIRCRAFT_HISTORY = HistorySpec(
    key="icao24",
    checked=("operator", "operator_icao", "operator_iata", "operator_callsign"),
    carried=(
        "manufacturer",
        "model",
        "typecode",
        "operator",
        "operator_callsign",
        "operator_icao",
        "operator_iata",
    ),
)


def dim_airports(airports: DataFrame) -> DataFrame:
    return airports.select(surrogate_key("icao_code").alias("airport_id"), *AIRPORT_COLUMNS)


def dim_airlines(stg_aircraft: DataFrame) -> DataFrame:
    """One row per operator code, described by its aircraft with the lowest icao24."""
    operated = stg_aircraft.filter(F.col("operator_icao").isNotNull()).select(
        "icao24", "operator_icao", "operator_iata", "operator", "operator_callsign"
    )
    return first_per_key(operated, ["operator_icao"], ascending("icao24")).select(
        surrogate_key("operator_icao").alias("airline_id"),
        "operator_icao",
        "operator_iata",
        F.col("operator").alias("airline_name"),
        "operator_callsign",
    )


def fct_flights(stg_flights: DataFrame, stg_aircraft: DataFrame) -> DataFrame:
    """One row per flight event with the current operator of its aircraft."""
    enriched = lookup(
        stg_flights, stg_aircraft, ("icao24", "icao24"), {c: c for c in AIRCRAFT_ON_FLIGHT}
    )
    return enriched.select(
        "flight_id",
        "icao24",
        "airport_icao",
        "flight_type",
        "callsign",
        "est_departure_airport",
        "est_arrival_airport",
        *AIRCRAFT_ON_FLIGHT,
        "first_seen_at",
        "last_seen_at",
        minutes_between(F.col("first_seen_at"), F.col("last_seen_at")).alias(
            "flight_duration_minutes"
        ),
        F.col("first_seen_at").cast("date").alias("flight_date"),
    )
