"""Column checks declared on the models."""

from __future__ import annotations

from dataclasses import dataclass

from flightloom.schemas import FLIGHT_TYPES


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    values: tuple[str, ...] = ()


def _key(model: str, column: str) -> tuple[Check, Check]:
    return Check(model, column, "unique"), Check(model, column, "not_null")


# Which column of which model must satisfy what.
CHECKS = (
    *_key("stg_flights", "flight_id"),
    Check("stg_flights", "icao24", "not_null"),
    Check("stg_flights", "flight_type", "not_null"),
    Check("stg_flights", "flight_type", "accepted_values", FLIGHT_TYPES),
    Check("stg_flights", "airport_icao", "not_null"),
    *_key("stg_aircraft", "icao24"),
    *_key("dim_airports", "airport_id"),
    *_key("dim_airports", "icao_code"),
    *_key("dim_airlines", "airline_id"),
    *_key("dim_airlines", "operator_icao"),
    *_key("fct_flights", "flight_id"),
    Check("fct_flights", "icao24", "not_null"),
)
