"""Staging: typed, cleaned, one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.functions import (
    blank_to_null,
    epoch_to_ntz,
    manufacturer_name,
    surrogate_key,
)
from flightloom.operators.dedup import any_per_key, latest_per_key
from flightloom.schemas import FLIGHT_KEY, LOAD_ID


def indexed_airport() -> Column:
    """Airport an event belongs to: where an arrival landed, where a departure left."""
    return F.when(F.col("flight_type") == "arrival", F.col("est_arrival_airport")).when(
        F.col("flight_type") == "departure", F.col("est_departure_airport")
    )


def stg_flights(raw_flights: DataFrame) -> DataFrame:
    """One row per (icao24, first_seen, flight_type): the most recently loaded.

    Derived columns, the 32-character key among them, are computed after the
    deduplication so that its shuffle carries the raw columns only.
    """
    needed = raw_flights.filter(F.col("first_seen").isNotNull()).select(
        *FLIGHT_KEY,
        "last_seen",
        "est_departure_airport",
        "est_arrival_airport",
        "callsign",
        LOAD_ID,
    )
    return latest_per_key(needed, FLIGHT_KEY, LOAD_ID).select(
        surrogate_key(*FLIGHT_KEY).alias("flight_id"),
        "icao24",
        F.trim("callsign").alias("callsign"),
        "flight_type",
        indexed_airport().alias("airport_icao"),
        "est_departure_airport",
        "est_arrival_airport",
        epoch_to_ntz(F.col("first_seen")).alias("first_seen_at"),
        epoch_to_ntz(F.col("last_seen")).alias("last_seen_at"),
        LOAD_ID,
    )


def stg_aircraft(raw_aircraft: DataFrame) -> DataFrame:
    """One row per icao24 with tidy manufacturer and operator fields."""
    cleaned = raw_aircraft.filter(F.col("icao24").isNotNull()).select(
        "icao24",
        manufacturer_name(F.col("manufacturername")).alias("manufacturer"),
        "model",
        "typecode",
        blank_to_null(F.col("operator")).alias("operator"),
        blank_to_null(F.col("operatorcallsign")).alias("operator_callsign"),
        blank_to_null(F.col("operatoricao")).alias("operator_icao"),
        blank_to_null(F.col("operatoriata")).alias("operator_iata"),
    )
    return any_per_key(cleaned, ["icao24"])
