from __future__ import annotations

import pytest
from helpers import aircraft, flight, plan_of, raw_aircraft, raw_flights, rows, ts

from flightloom.plans import curated, dashboard, marts, metrics, staging, star
from flightloom.sources.reference import default_airports


@pytest.fixture(scope="module")
def tables(spark):
    planes = staging.stg_aircraft(
        raw_aircraft(spark, aircraft(), aircraft(icao24="b1", icao="ZZZ", operator=None))
    )
    flights = staging.stg_flights(
        raw_flights(
            spark,
            flight(first=0, last=600),
            flight(first=86_400 * 40, last=86_400 * 40 + 1800),
            flight(icao24="b1", first=60, last=120, dep="LEMD"),
            flight(icao24="b1", first=90, last=None, dep="LEBL"),
            flight(icao24="zz", first=30, dep=None),
        )
    )
    airports = star.dim_airports(default_airports(spark))
    airlines = star.dim_airlines(planes)
    fact = star.fct_flights(flights, planes)
    return {
        "fct_flights": fact,
        "dim_airports": airports,
        "dim_airlines": airlines,
        "mart_airport_traffic": marts.mart_airport_traffic(fact, airports),
        "mart_route_popularity": marts.mart_route_popularity(fact, airports),
        "mart_airline_reliability": marts.mart_airline_reliability(fact, airlines),
        "mart_traffic_patterns": marts.mart_traffic_patterns(fact, airports),
    }


def test_measures_through_a_dimension(tables):
    found = metrics.metric_query(
        tables,
        "fct_flights",
        ["flight_count", "avg_flight_duration_minutes", "total_flight_duration_minutes"],
        by=["dim_airports.country"],
    )
    assert rows(found) == sorted(
        [
            ("United Kingdom", 2, 20.0, 40),
            ("Spain", 2, 1.0, 1),
            (None, 1, 60.0, 60),
        ],
        key=repr,
    )


def test_month_grain(tables):
    found = metrics.metric_query(
        tables, "mart_airport_traffic", ["total_flights"], by=["traffic_date"], grain="month",
        order=[("traffic_date", "desc")],
    )
    assert [tuple(r) for r in found.collect()] == [(ts("1970-02-01"), 1), (ts("1970-01-01"), 4)]


def test_no_groups_is_one_row(tables):
    found = metrics.metric_query(tables, "fct_flights", ["flight_count"], where="icao24 = 'none'")
    assert rows(found) == [(0,)]


def test_default_aggregation_of_a_bare_column(tables):
    found = metrics.metric_query(
        tables, "mart_airline_reliability", ["avg_flight_duration_minutes", "active_days"]
    )
    assert rows(found) == [(10.5, 3)]


@pytest.mark.parametrize(
    ("table", "measures", "by"),
    [
        ("fct_flights", ["nope"], []),
        ("fct_flights", ["flight_count"], ["model"]),
        ("fct_flights", ["flight_count"], ["dim_airports.nope"]),
        ("mart_airport_traffic", ["total_flights"], ["dim_airports.city"]),
        ("mart_traffic_patterns", ["flight_count"], []),
    ],
)
def test_unknown_names_are_refused(tables, table, measures, by):
    with pytest.raises(metrics.UnknownName):
        metrics.metric_query(tables, table, measures, by=by)


def test_dimensions_of_one_name_are_refused(tables):
    with pytest.raises(ValueError, match="same name"):
        metrics.metric_query(
            tables,
            "fct_flights",
            ["flight_count"],
            by=["operator_icao", "dim_airlines.operator_icao"],
        )


def test_time_grain_beside_a_dimension(tables):
    found = metrics.metric_query(
        tables,
        "fct_flights",
        ["flight_count"],
        by=["first_seen_at", "dim_airlines.operator_icao"],
        grain="year",
    )
    year = ts("1970-01-01")
    assert rows(found) == sorted([(year, "OPR", 2), (year, "ZZZ", 2), (year, None, 1)], key=repr)


def test_every_curated_question_answers(tables):
    assert {name: len(curated.answer(name, tables).columns) for name in curated.CURATED} == {
        "busiest_airports": 3,
        "top_routes": 5,
        "most_active_airlines": 4,
        "daily_traffic_heathrow": 1,
        "arrivals_vs_departures_by_airport": 5,
        "weekly_traffic_trend": 2,
        "routes_from_paris": 4,
        "airline_avg_duration": 4,
    }


def test_ratio_without_departures_is_null(tables):
    found = curated.arrivals_vs_departures(tables)
    assert ("LHR", 0, 2, 0.0) in rows(
        found, "airport_iata", "total_arrivals", "total_departures", "arrival_departure_ratio"
    )
    assert found.filter("airport_iata is null").first().total_departures == 1


def test_unknown_routes_leave_after_the_ranking(spark, tables):
    routes = tables["mart_route_popularity"]
    assert dashboard.top_routes(routes, k=3).count() == 3
    unknown = marts.mart_route_popularity(
        tables["fct_flights"], tables["dim_airports"].filter("icao_code <> 'EGLL'")
    )
    assert dashboard.top_routes(unknown, k=1).count() == 0


def test_heatmap_has_all_hours_and_selection_drops_unknown_airports(tables):
    hours = dashboard.airport_hours(tables["mart_traffic_patterns"])
    heat = dashboard.hour_heatmap(hours)
    assert heat.columns == ["airport_iata", *map(str, range(24))]
    assert {r.airport_iata: r["0"] for r in heat.collect()} == {"LHR": 2, "MAD": 1, "BCN": 1}
    everything = dashboard.hourly_totals(hours).collect()
    assert [(r.hour_of_day, r.flight_count) for r in everything] == [(0, 5)]
    chosen = dashboard.hourly_totals(hours, ["MAD", "BCN"]).collect()
    assert [(r.hour_of_day, r.flight_count) for r in chosen] == [(0, 2)]


def test_long_form_of_arrivals_and_departures(tables):
    traffic = dashboard.airport_traffic(tables["mart_airport_traffic"])
    long = dashboard.arrivals_and_departures(traffic)
    assert long.columns == ["airport_iata", "Type", "Flights"]
    assert ("LHR", "total_departures", 2) in rows(long)


def test_condition_on_a_dimension_that_is_not_grouped_by(tables):
    """Averages over all chosen airports together, not one per country."""
    found = metrics.metric_query(
        tables,
        "fct_flights",
        ["flight_count", "avg_flight_duration_minutes"],
        where_dimension={"dim_airports": "country IN ('Spain')"},
    )
    airports = tables["dim_airports"].filter("country = 'Spain'")
    kept = tables["fct_flights"].join(airports, tables["fct_flights"]["airport_icao"] == airports["icao_code"], "left_semi")
    want = kept.selectExpr("count(flight_id)", "avg(flight_duration_minutes)").first()
    assert tuple(found.first()) == tuple(want) and want[0] > 0
    nowhere = metrics.metric_query(
        tables, "fct_flights", ["flight_count"], where_dimension={"dim_airports": "country = 'Nowhere'"}
    )
    assert [tuple(r) for r in nowhere.collect()] == [(0,)]
    with pytest.raises(metrics.UnknownName):
        metrics.metric_query(tables, "fct_flights", ["flight_count"], where_dimension={"dim_parts": "true"})


def test_limit_needs_an_order(tables):
    with pytest.raises(ValueError, match="order"):
        metrics.metric_query(tables, "fct_flights", ["flight_count"], by=["operator_icao"], limit=3)


def answering(tables, monkeypatch, **question):
    """The table that a routed question reads, and whether the answer is that of the fact."""
    read = []
    answer = metrics._answer

    def noted(tables_, logical, *rest):
        read.append(logical.name)
        return answer(tables_, logical, *rest)

    with monkeypatch.context() as patched:
        patched.setattr(metrics, "_answer", noted)
        routed = metrics.routed_query(tables, "fct_flights", **question)
    direct = metrics.metric_query(tables, "fct_flights", **question)
    assert routed.columns == direct.columns
    assert rows(routed) == rows(direct)
    return read[0]


COUNT = ["flight_count"]


@pytest.mark.parametrize(("table", "question"), [
    ("mart_airport_traffic", {"measures": COUNT}),
    ("mart_airport_traffic", {"measures": COUNT, "by": ["airport_icao"]}),
    ("mart_airport_traffic", {"measures": COUNT, "by": ["dim_airports.country", "first_seen_at"], "grain": "week"}),
    ("mart_airport_traffic", {"measures": COUNT, "where": "airport_icao = 'EGLL'"}),
    ("mart_airport_traffic", {"measures": COUNT, "where": "airport_icao = 'nowhere'"}),
    ("mart_airport_traffic", {"measures": COUNT, "where_dimension": {"dim_airports": "country = 'Spain'"}}),
    ("mart_traffic_patterns", {"measures": COUNT, "by": ["flight_type"]}),
    ("mart_traffic_patterns", {"measures": COUNT, "by": ["first_seen_at"], "grain": "hour"}),
    ("mart_traffic_patterns", {"measures": COUNT, "where": "flight_type = 'arrival'"}),
    ("mart_airline_reliability", {"measures": COUNT, "by": ["operator_icao"], "where_dimension": {"dim_airlines": "airline_name IS NULL"}}),
    # Nulls that the airlines' table lacks, times finer than any, measures that no rollup holds.
    ("fct_flights", {"measures": COUNT, "by": ["operator_icao"]}),
    ("fct_flights", {"measures": COUNT, "by": ["first_seen_at"]}),
    ("fct_flights", {"measures": COUNT, "by": ["last_seen_at"], "grain": "day"}),
    ("fct_flights", {"measures": ["flight_count", "avg_flight_duration_minutes"], "by": ["airport_icao"]}),
    ("fct_flights", {"measures": COUNT, "where": "first_seen_at > timestamp_ntz'1970-01-01 00:01:00'"}),
    ("fct_flights", {"measures": COUNT, "by": ["airport_icao"], "where": "icao24 = 'a1'"}),
])
def test_questions_go_to_the_smallest_table(tables, monkeypatch, table, question):
    assert answering(tables, monkeypatch, **question) == table


def test_routed_questions_read_no_fact(tables, layers):
    layers.save_table("marts", "mart_traffic_patterns", tables["mart_traffic_patterns"])
    stored = tables | {"mart_traffic_patterns": layers.table("marts", "mart_traffic_patterns")}
    plan = plan_of(metrics.routed_query(stored, "fct_flights", COUNT, by=["flight_type"]))
    assert "mart_traffic_patterns" in plan and "flight_id" not in plan
