"""Declared schemas: raw inputs and the contracts of the served tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names as they arrive in landed flight records, and the column
# each one becomes.
LANDED_FIELDS = {
    "icao24": "icao24",
    "firstSeen": "first_seen",
    "estDepartureAirport": "est_departure_airport",
    "lastSeen": "last_seen",
    "estArrivalAirport": "est_arrival_airport",
    "callsign": "callsign",
    "estDepartureAirportHorizDistance": "est_departure_airport_horiz_distance",
    "estDepartureAirportVertDistance": "est_departure_airport_vert_distance",
    "estArrivalAirportHorizDistance": "est_arrival_airport_horiz_distance",
    "estArrivalAirportVertDistance": "est_arrival_airport_vert_distance",
    "departureAirportCandidatesCount": "departure_airport_candidates_count",
    "arrivalAirportCandidatesCount": "arrival_airport_candidates_count",
}
TEXT_FIELDS = ("icao24", "estDepartureAirport", "estArrivalAirport", "callsign")

# Columns kept from the aircraft reference file, and the seed's header.
AIRCRAFT_COLUMNS = (
    "icao24",
    "registration",
    "manufacturername",
    "model",
    "typecode",
    "operator",
    "operatorcallsign",
    "operatoricao",
    "operatoriata",
)
AIRPORT_COLUMNS = ("icao_code", "iata_code", "name", "city", "country")

# The two kinds of flight event, and the key of a flight event.
FLIGHT_TYPES = ("arrival", "departure")
FLIGHT_KEY = ("icao24", "first_seen", "flight_type")
LOAD_ID = "_dlt_load_id"

# The airports in scope, in the order of AIRPORT_COLUMNS.
AIRPORTS = (
    ("LFPG", "CDG", "Charles de Gaulle", "Paris", "France"),
    ("EGLL", "LHR", "Heathrow", "London", "United Kingdom"),
    ("EHAM", "AMS", "Schiphol", "Amsterdam", "Netherlands"),
    ("EDDF", "FRA", "Frankfurt", "Frankfurt", "Germany"),
    ("LEMD", "MAD", "Adolfo Suárez Barajas", "Madrid", "Spain"),
    ("LIRF", "FCO", "Leonardo da Vinci Fiumicino", "Rome", "Italy"),
    ("LEBL", "BCN", "El Prat", "Barcelona", "Spain"),
    ("EBBR", "BRU", "Brussels", "Brussels", "Belgium"),
    ("LSZH", "ZRH", "Zurich", "Zurich", "Switzerland"),
    ("LPPT", "LIS", "Humberto Delgado", "Lisbon", "Portugal"),
)
AIRPORTS_IN_SCOPE = tuple(row[0] for row in AIRPORTS)


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """Nullable fields from ``name type`` pairs; needs no session, unlike a DDL string."""
    pairs = [pair.split() for pair in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


LANDED_FLIGHTS = T.StructType(
    [
        T.StructField(name, T.StringType() if name in TEXT_FIELDS else T.LongType())
        for name in LANDED_FIELDS
    ]
)
LANDED_SLICE = T.StructType(
    [T.StructField("day", T.DateType()), T.StructField("flight_type", T.StringType())]
)
AIRCRAFT_FILE = T.StructType([T.StructField(c, T.StringType()) for c in AIRCRAFT_COLUMNS])
AIRPORTS_FILE = T.StructType([T.StructField(c, T.StringType()) for c in AIRPORT_COLUMNS])

CONTRACTS: dict[str, T.StructType] = {
    "mart_airport_traffic": _struct(
        "traffic_date timestamp_ntz, traffic_week timestamp_ntz, airport_icao string,"
        " airport_iata string, airport_name string, city string, country string,"
        " arrivals bigint, departures bigint, total_flights bigint"
    ),
    "mart_route_popularity": _struct(
        "departure_icao string, departure_iata string, departure_airport_name string,"
        " departure_city string, departure_country string, arrival_icao string,"
        " arrival_iata string, arrival_airport_name string, arrival_city string,"
        " arrival_country string, flight_count bigint, first_seen_date timestamp_ntz,"
        " last_seen_date timestamp_ntz"
    ),
    "mart_airline_reliability": _struct(
        "airline_id string, operator_icao string, operator_iata string, airline_name string,"
        " operator_callsign string, total_flights bigint, total_departures bigint,"
        " total_arrivals bigint, avg_flight_duration_minutes double, active_days bigint"
    ),
    "mart_on_time_performance": _struct(
        "airline_id string, operator_icao string, operator_iata string, airline_name string,"
        " departure_icao string, arrival_icao string, flight_count bigint,"
        " avg_flight_duration_minutes double, min_flight_duration_minutes bigint,"
        " max_flight_duration_minutes bigint"
    ),
    "mart_traffic_patterns": _struct(
        "traffic_date timestamp_ntz, hour_of_day bigint, airport_icao string,"
        " airport_iata string, airport_name string, city string, flight_type string,"
        " flight_count bigint"
    ),
}
