from __future__ import annotations

from helpers import aircraft, flight, raw_aircraft, raw_flights, rows, ts

from flightloom.plans import marts, staging, star
from flightloom.sources.reference import default_airports


def fact(spark, flights, planes):
    return star.fct_flights(
        staging.stg_flights(raw_flights(spark, *flights)),
        staging.stg_aircraft(raw_aircraft(spark, *planes)),
    )


def test_latest_load_wins_and_a_load_without_id_counts_as_latest(spark):
    staged = staging.stg_flights(
        raw_flights(
            spark,
            flight(load="100", last=60),
            flight(load="200", last=120),
            flight(icao24="a2", load="200", last=60),
            flight(icao24="a2", load=None, last=180),
        )
    )
    assert rows(staged, "icao24", "last_seen_at") == [
        ("a1", ts("1970-01-01 00:02:00")),
        ("a2", ts("1970-01-01 00:03:00")),
    ]


def test_load_ids_compare_as_text(spark):
    staged = staging.stg_flights(raw_flights(spark, flight(load="9"), flight(load="10")))
    assert rows(staged, "_dlt_load_id") == [("9",)]


def test_rows_that_tie_give_the_same_pick_in_any_order(spark):
    tied = [flight(last=60, callsign="B"), flight(last=60, callsign="A")]
    picks = [
        rows(staging.stg_flights(raw_flights(spark, *order)), "callsign")
        for order in (tied, tied[::-1])
    ]
    assert picks[0] == picks[1] == [("B",)]


def test_staged_flight_columns(spark):
    staged = staging.stg_flights(
        raw_flights(
            spark,
            flight(callsign="   "),
            flight(kind="arrival", callsign=None),
            flight(kind="overflight", last=None),
            flight(icao24="a9", first=None),
        )
    )
    assert rows(staged, "flight_type", "callsign", "airport_icao", "last_seen_at") == [
        ("arrival", None, "LFPG", ts("1970-01-01 01:00:00")),
        ("departure", "", "EGLL", ts("1970-01-01 01:00:00")),
        ("overflight", "FL1", None, None),
    ]


def test_same_flight_as_departure_and_arrival_is_two_events(spark):
    staged = staging.stg_flights(raw_flights(spark, flight(), flight(kind="arrival")))
    assert staged.select("flight_id").distinct().count() == 2


def test_staged_aircraft_is_unique_and_blank_free(spark):
    staged = staging.stg_aircraft(
        raw_aircraft(
            spark,
            aircraft(operator=" Op ", icao="  ", iata=""),
            aircraft(operator=" Op ", icao="  ", iata=""),
            aircraft(icao24=None),
        )
    )
    assert rows(staged, "icao24", "operator", "operator_icao", "operator_iata") == [
        ("a1", "Op", None, None)
    ]


def test_airline_is_described_by_its_lowest_aircraft(spark):
    staged = staging.stg_aircraft(
        raw_aircraft(
            spark,
            aircraft(icao24="b", operator="Later"),
            aircraft(icao24="a", operator=None, iata="ZZ"),
            aircraft(icao24="c", icao=None),
        )
    )
    assert rows(star.dim_airlines(staged), "operator_icao", "airline_name", "operator_iata") == [
        ("OPR", None, "ZZ")
    ]


def test_unmatched_aircraft_keeps_its_flight(spark):
    made = fact(spark, [flight(), flight(icao24="zz")], [aircraft()])
    assert rows(made, "icao24", "operator_icao") == [("a1", "OPR"), ("zz", None)]
    assert len(made.columns) == 17


def test_traffic_groups_unknown_airports_and_counts_types(spark):
    flights = [
        flight(first=1_704_585_600),  # Sunday 2024-01-07
        flight(first=1_704_585_601, kind="arrival", arr="EGLL"),
        flight(first=1_704_585_602, kind="overflight", dep="EGLL"),
        flight(first=1_704_585_603, dep="KJFK"),
    ]
    made = marts.mart_airport_traffic(fact(spark, flights, []), default_airports(spark))
    columns = ("airport_icao", "airport_iata", "traffic_week", "arrivals", "departures", "total_flights")
    monday = ts("2024-01-01")
    assert rows(made, *columns) == sorted(
        [
            ("EGLL", "LHR", monday, 1, 1, 2),
            ("KJFK", None, monday, 0, 1, 1),
            (None, None, monday, 0, 0, 1),
        ],
        key=repr,
    )


def test_on_time_table_needs_known_ends_and_positive_duration(spark):
    flights = [
        flight(first=0, last=60),
        flight(first=100, last=100),
        flight(first=600, last=0),
        flight(first=200, last=None),
        flight(first=300, last=900, arr=None),
    ]
    planes = [aircraft()]
    airlines = star.dim_airlines(staging.stg_aircraft(raw_aircraft(spark, *planes)))
    made = marts.mart_on_time_performance(fact(spark, flights, planes), airlines)
    assert rows(made, "flight_count", "avg_flight_duration_minutes") == [(1, 1.0)]


def test_airline_missing_from_the_dimension_leaves_null_keys(spark):
    planes = [aircraft()]
    none = star.dim_airlines(staging.stg_aircraft(raw_aircraft(spark)))
    made = marts.mart_airline_reliability(fact(spark, [flight()], planes), none)
    assert rows(made, "operator_icao", "total_flights", "active_days") == [(None, 1, 1)]


def test_routes_span_their_days(spark):
    flights = [flight(first=0), flight(first=200_000), flight(first=5, dep=None)]
    made = marts.mart_route_popularity(fact(spark, flights, []), default_airports(spark))
    assert rows(made, "departure_iata", "arrival_city", "flight_count", "first_seen_date",
                "last_seen_date") == [
        ("LHR", "Paris", 2, ts("1970-01-01"), ts("1970-01-03"))
    ]


def test_report_order_puts_null_names_last(spark):
    planes = [aircraft(), aircraft(icao24="b1", icao="AAA", operator=None)]
    airlines = star.dim_airlines(staging.stg_aircraft(raw_aircraft(spark, *planes)))
    flights = [flight(), flight(icao24="b1")]
    made = marts.mart_on_time_performance(fact(spark, flights, planes), airlines)
    ordered = marts.in_report_order("mart_on_time_performance", made)
    assert [r.operator_icao for r in ordered.collect()] == ["OPR", "AAA"]
