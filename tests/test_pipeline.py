from __future__ import annotations

import json
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from helpers import plan_of, rows, ts
from pyspark.sql import functions as F

from flightloom.operators import partials
from flightloom.operators.quality import ContractViolation
from flightloom.plans import ledger, marts, pipeline
from flightloom.plans.ledger import Ledger
from flightloom.plans.models import MODELS
from flightloom.schemas import AIRCRAFT_COLUMNS
from flightloom.sources.reference import default_airports

DAY = 1704067200  # 2024-01-01


def deliver(base, day, kind, *records):
    folder = base / f"day={day}" / f"flight_type={kind}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.json").write_text(json.dumps(list(records)))


def record(icao24="a1", first=DAY, last=DAY + 3600, dep="EGLL", arr="LFPG"):
    return {
        "icao24": icao24,
        "firstSeen": first,
        "lastSeen": last,
        "estDepartureAirport": dep,
        "estArrivalAirport": arr,
        "callsign": "FL1  ",
    }


@pytest.fixture
def inputs(tmp_path):
    base = tmp_path / "landing"
    deliver(base, "2024-01-01", "departure", record(), record("a2"))
    deliver(base, "2024-01-02", "departure", record("a1", DAY + 90_000, DAY + 95_000))
    deliver(base, "2024-01-02", "arrival", record("a2", DAY + 80_000, DAY + 90_000))
    file = tmp_path / "aircraft.csv"
    file.write_text(
        ",".join(AIRCRAFT_COLUMNS)
        + "\na1,R1,AIRBUS,A320,A320,Op,OPC,OPR,OP\na2,R2,Boing,B738,B738,,,,\n"
    )
    return str(base), str(file)


def load(layers, inputs, days=(1, 2), load_id="100"):
    base, file = inputs
    pipeline.ingest(layers, base, [date(2024, 1, d) for d in days], load_id)
    assert pipeline.reload_aircraft(layers, file) == 2


def test_whole_job(layers, spark, inputs):
    load(layers, inputs)
    report = pipeline.build(layers, default_airports(spark), ts("2024-01-03"))
    assert report.skipped == []
    assert sorted(report.rows) == sorted(m.name for m in MODELS)
    assert report.rows["fct_flights"] == 4
    traffic = layers.table("marts", "mart_airport_traffic")
    assert traffic.agg(F.sum("total_flights")).first()[0] == 4
    assert rows(traffic.filter("arrivals + departures <> total_flights")) == []
    patterns = layers.table("marts", "mart_traffic_patterns")
    assert patterns.agg(F.sum("flight_count")).first()[0] == 4
    results = layers.table("quality", "results")
    assert results.filter("check NOT IN ('build', 'contract', 'freshness')").count() == 19
    assert results.filter("status = 'fail'").count() == 0
    assert pipeline.read_history(layers).count() == 2
    fact = layers.table("marts", "fct_flights").filter("flight_date = date'2024-01-02'")
    assert "PartitionFilters: [isnotnull(flight_date" in (
        fact._jdf.queryExecution().executedPlan().toString()
    )


def test_days_may_come_again_and_out_of_order(layers, inputs):
    load(layers, inputs)
    before = rows(layers.table("raw", "flights"))
    load(layers, inputs, days=[2])
    load(layers, inputs, days=[1, 2])
    assert rows(layers.table("raw", "flights")) == before


def test_resent_flight_replaces_the_earlier_one(layers, inputs):
    load(layers, inputs)
    deliver(Path(inputs[0]), "2024-01-03", "departure", record(last=DAY + 7200))
    pipeline.ingest(layers, inputs[0], [date(2024, 1, 3)], "200")
    flights = layers.table("raw", "flights").filter("icao24 = 'a1' and first_seen = 1704067200")
    assert rows(flights, "last_seen", "_dlt_load_id") == [(DAY + 7200, "200")]


def test_failed_check_leaves_dependents_as_they_were(layers, spark, inputs):
    load(layers, inputs)
    airports = default_airports(spark)
    pipeline.build(layers, airports, ts("2024-01-03"))
    deliver(Path(inputs[0]), "2024-01-04", "departure", record("a7", dep=None))
    pipeline.ingest(layers, inputs[0], [date(2024, 1, 4)], "200")
    report = pipeline.build(layers, airports, ts("2024-01-05"))
    assert "fct_flights" in report.skipped and "mart_route_popularity" in report.skipped
    assert layers.table("marts", "fct_flights").count() == 4
    failed = layers.table("quality", "results").filter("status = 'fail'")
    assert rows(failed, "model", "column", "check", "failures") == [
        ("stg_flights", "airport_icao", "not_null", 1)
    ]
    recorded = pipeline.build(layers, airports, ts("2024-01-06"), on_failure="record")
    assert recorded.skipped == []
    assert layers.table("marts", "fct_flights").count() == 5


def test_broken_contract_stops_before_the_write(layers, spark, inputs, monkeypatch):
    load(layers, inputs)
    airports = default_airports(spark)
    pipeline.build(layers, airports, ts("2024-01-03"))
    broken = [
        m if m.name != "mart_traffic_patterns" else replace(
            m, build=lambda f, a: marts.mart_traffic_patterns(f, a).drop("city")
        )
        for m in MODELS
    ]
    monkeypatch.setattr(pipeline, "MODELS", broken)
    with pytest.raises(ContractViolation, match="city"):
        pipeline.build(layers, airports, ts("2024-01-04"))
    assert "city" in layers.table("marts", "mart_traffic_patterns").columns


def test_daily_run_loads_yesterday_and_builds(layers, spark, inputs):
    pipeline.reload_aircraft(layers, inputs[1])
    now = datetime(2024, 1, 3, 1, tzinfo=timezone(timedelta(hours=2)))  # still the 2nd in UTC
    report = pipeline.run(layers, inputs[0], default_airports(spark), now)
    assert report.rows["fct_flights"] == 2
    assert rows(layers.table("raw", "flights").select("_dlt_load_id").distinct()) == [
        (str(int(now.timestamp())),)
    ]
    assert rows(pipeline.read_history(layers), "dbt_valid_from")[0] == (ts("2024-01-02 23:00:00"),)


def test_scope_keeps_events_of_its_airports(layers, inputs):
    pipeline.ingest(layers, inputs[0], [date(2024, 1, 1), date(2024, 1, 2)], "100", scope=["LFPG"])
    assert rows(layers.table("raw", "flights"), "icao24", "flight_type") == [("a2", "arrival")]


def test_results_hold_rows_freshness_and_contracts(layers, spark, inputs):
    load(layers, inputs)
    report = pipeline.build(layers, default_airports(spark), ts("2024-01-03"))
    results = layers.table("quality", "results")
    built = results.filter("check = 'build' AND status = 'built'")
    assert rows(built, "model", "rows_written") == sorted(report.rows.items())
    assert results.filter("check = 'contract' AND status = 'pass'").count() == 5
    assert rows(results.filter("check = 'freshness'"), "model") == [("raw_flights",)]


def test_outcomes_are_recorded_when_a_contract_breaks(layers, spark, inputs, monkeypatch):
    load(layers, inputs)
    broken = [
        m if m.name != "mart_traffic_patterns" else replace(
            m, build=lambda f, a: marts.mart_traffic_patterns(f, a).drop("city")
        )
        for m in MODELS
    ]
    monkeypatch.setattr(pipeline, "MODELS", broken)
    with pytest.raises(ContractViolation):
        pipeline.build(layers, default_airports(spark), ts("2024-01-04"))
    results = layers.table("quality", "results")
    assert rows(results.filter("status = 'fail' AND check = 'contract'"), "model") == [("mart_traffic_patterns",)]
    assert results.filter("model = 'stg_flights' AND check = 'unique'").count() == 1


def test_run_takes_its_scope_from_the_airports(layers, spark, inputs):
    pipeline.reload_aircraft(layers, inputs[1])
    now = datetime(2024, 1, 3, 1, tzinfo=timezone.utc)
    one = default_airports(spark).filter("icao_code = 'LFPG'")
    pipeline.run(layers, inputs[0], one, now)
    kept = layers.table("raw", "flights")
    code = F.when(F.col("flight_type") == "arrival", F.col("est_arrival_airport")).otherwise(F.col("est_departure_airport"))
    assert kept.filter(code != "LFPG").isEmpty()


@pytest.mark.parametrize("partitioned", [True, False])
def test_updates_by_day_equal_a_whole_build(layers, spark, inputs, partitioned):
    airports, days = default_airports(spark), [date(2024, 1, 1), date(2024, 1, 2)]
    pipeline.reload_aircraft(layers, inputs[1])
    pipeline.ingest(layers, inputs[0], days[:1], "100")
    pipeline.build(layers, airports, ts("2024-01-02"), partitioned=partitioned)
    touched = pipeline.ingest(layers, inputs[0], days[1:], "200")
    # A record of the day before came late.
    assert sorted(touched) == ["2024-01-01", "2024-01-02"]
    report = pipeline.update(layers, airports, ts("2024-01-03"), touched, partitioned=partitioned)
    assert report.skipped == []
    after = {m.name: rows(layers.table(m.schema, m.name)) for m in MODELS}
    pipeline.build(layers, airports, ts("2024-01-04"), partitioned=partitioned)
    assert after == {m.name: rows(layers.table(m.schema, m.name)) for m in MODELS}


def test_a_changed_aircraft_rebuilds_the_fact(layers, spark, inputs):
    load(layers, inputs)
    airports = default_airports(spark)
    pipeline.build(layers, airports, ts("2024-01-03"))
    changed = layers.table("raw", "aircraft").withColumn("operator", F.lit("Other"))
    layers.save_table("raw", "aircraft", changed)
    pipeline.update(layers, airports, ts("2024-01-04"), [])
    assert rows(layers.table("marts", "fct_flights").filter("operator IS NOT NULL").select("operator").distinct()) == [("Other",)]


def tables_of(layers):
    return {m.name: rows(layers.table(m.schema, m.name)) for m in MODELS}


def test_days_of_a_failed_run_and_of_a_crash_come_again(layers, spark, inputs, monkeypatch):
    airports, base = default_airports(spark), Path(inputs[0])
    pipeline.reload_aircraft(layers, inputs[1])
    pipeline.ingest(layers, inputs[0], [date(2024, 1, 1)], "100")
    pipeline.build(layers, airports, ts("2024-01-02"))
    # Day 4 fails a check of staging: the fact stays, and the day stays open for it.
    deliver(base, "2024-01-04", "departure", record("a1", DAY + 3 * 86400, DAY + 3 * 86400 + 600, dep=None))
    pipeline.ingest(layers, inputs[0], [date(2024, 1, 4)], "200")
    report = pipeline.update(layers, airports, ts("2024-01-05"))
    assert "fct_flights" in report.skipped and layers.table("marts", "fct_flights").count() == 2
    # A day is loaded and the run ends before the models are updated.
    pipeline.ingest(layers, inputs[0], [date(2024, 1, 2)], "300")
    waiting = Ledger(layers).open_days(["stg_flights", "fct_flights"])
    assert set(waiting["fct_flights"]) == {"2024-01-04", "2024-01-02", "2024-01-01"}
    # The next run has a repaired day 4; it fails half way, and the one after does the rest.
    deliver(base, "2024-01-04", "departure", record("a1", DAY + 3 * 86400, DAY + 3 * 86400 + 600))
    pipeline.ingest(layers, inputs[0], [date(2024, 1, 4)], "400")

    def stop(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patched:
        patched.setattr(pipeline, "_from_states", stop)
        with pytest.raises(RuntimeError):
            pipeline.update(layers, airports, ts("2024-01-06"))
    assert Ledger(layers).open_days(["fct_flights"]) == {"fct_flights": {}}
    report = pipeline.update(layers, airports, ts("2024-01-07"))
    assert report.skipped == [] and report.rows["fct_flights"] == 0
    assert all(not days for days in Ledger(layers).open_days(pipeline.FOLLOWING).values())
    after = tables_of(layers)
    assert len(after["fct_flights"]) == 5
    pipeline.build(layers, airports, ts("2024-01-08"))
    assert after == tables_of(layers)


def test_a_second_load_writes_nothing_and_opens_nothing(layers, inputs, monkeypatch):
    load(layers, inputs)
    before = rows(layers.table("raw", "flights"))

    def refuse(*_, **__):
        raise AssertionError("a partition is written")

    with monkeypatch.context() as patched:
        patched.setattr(layers, "replace_partitions", refuse)
        assert pipeline.ingest(layers, inputs[0], [date(2024, 1, 1), date(2024, 1, 2)], "100") == []
        # An older load loses against what is stored.
        assert pipeline.ingest(layers, inputs[0], [date(2024, 1, 1)], "050") == []
    assert rows(layers.table("raw", "flights")) == before
    # The same rows in a newer load: stored, but no model has to know.
    assert pipeline.ingest(layers, inputs[0], [date(2024, 1, 2)], "200") == []
    assert layers.table("raw", "flights").filter("_dlt_load_id = '200'").count() == 2
    loads = Ledger(layers).loads("load")
    assert loads.agg(F.max("load")).first()[0] == "200"


def test_a_changed_aircraft_rewrites_only_its_days(layers, spark, inputs, monkeypatch):
    load(layers, inputs)
    deliver(Path(inputs[0]), "2024-01-03", "departure", record("a2", DAY + 2 * 86400, DAY + 2 * 86400 + 600))
    pipeline.ingest(layers, inputs[0], [date(2024, 1, 3)], "200")
    airports = default_airports(spark)
    pipeline.build(layers, airports, ts("2024-01-04"))
    # a1 flew on the 1st and the 2nd, a2 on the 3rd alone as well.
    other = F.when(F.col("icao24") == "a1", F.lit("NEW")).otherwise(F.col("operatoricao"))
    layers.save_table("raw", "aircraft", layers.table("raw", "aircraft").withColumn("operatoricao", other))
    written = []
    replace_partitions = layers.replace_partitions

    def noted(schema, model, df, *rest, **named):
        if model == "fct_flights":
            written.extend(r[0] for r in df.select(F.col("flight_date").cast("string")).distinct().collect())
        return replace_partitions(schema, model, df, *rest, **named)

    monkeypatch.setattr(layers, "replace_partitions", noted)
    report = pipeline.update(layers, airports, ts("2024-01-05"))
    assert sorted(written) == ["2024-01-01", "2024-01-02"]
    assert report.rows["stg_flights"] == 0 and report.rows["mart_airport_traffic"] == 0
    after = tables_of(layers)
    assert [r[1] for r in after["dim_airlines"]] == ["NEW"]
    monkeypatch.undo()
    pipeline.build(layers, airports, ts("2024-01-06"))
    assert after == tables_of(layers)


def test_tables_over_all_days_read_touched_days_only(layers, spark, inputs, monkeypatch):
    load(layers, inputs, days=[1])
    airports = default_airports(spark)
    pipeline.build(layers, airports, ts("2024-01-02"))
    deliver(Path(inputs[0]), "2024-02-01", "departure", record("a1", DAY + 31 * 86400, DAY + 31 * 86400 + 600))
    pipeline.ingest(layers, inputs[0], [date(2024, 2, 1)], "200")
    plans = []
    replace_states = pipeline._replace_states

    def noted(layers_, partial, df, changed, partitioned):
        plans.append(plan_of(partial.by_day(df)))
        replace_states(layers_, partial, df, changed, partitioned)

    monkeypatch.setattr(pipeline, "_replace_states", noted)
    pipeline.update(layers, airports, ts("2024-02-02"))
    assert len(plans) == 4
    for plan in plans:
        filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
        assert "flight_date" in filters and "2024-02-01" in filters
    table = plan_of(layers.table("marts", "mart_route_popularity"))
    assert "fct_flights" not in table


def test_only_months_of_open_days_are_merged_again(layers, spark, inputs, monkeypatch):
    """Also in tables without partitions, whose other months are written as they are."""
    deliver(Path(inputs[0]), "2024-02-01", "departure", record("a1", DAY + 31 * 86400, DAY + 31 * 86400 + 600))
    load(layers, inputs)
    pipeline.ingest(layers, inputs[0], [date(2024, 2, 1)], "150")
    airports, settings = default_airports(spark), {"partitioned": False}
    pipeline.build(layers, airports, ts("2024-02-02"), **settings)
    deliver(Path(inputs[0]), "2024-02-02", "departure", record("a2", DAY + 32 * 86400, DAY + 32 * 86400 + 600))
    pipeline.ingest(layers, inputs[0], [date(2024, 2, 2)], "200")
    months, by_month = [], partials.Partial.by_month

    def noted(self, daily):
        months.append(rows(daily.select(F.col("month").cast("string")).distinct()))
        return by_month(self, daily)

    monkeypatch.setattr(partials.Partial, "by_month", noted)
    pipeline.update(layers, airports, ts("2024-02-03"), **settings)
    assert len(months) == 4 and {m for found in months for m in found} == {("2024-02-01",)}
    monkeypatch.undo()
    states = [(pipeline.STATES, pipeline.by_month(p)) for m in MODELS for p in (m.partial, m.index) if p]
    after = [rows(layers.table(*name)) for name in states] + [tables_of(layers)]
    pipeline.build(layers, airports, ts("2024-02-04"), **settings)
    assert after == [rows(layers.table(*name)) for name in states] + [tables_of(layers)]


def test_an_airport_that_changes_renames_all_days(layers, spark, inputs):
    load(layers, inputs)
    airports = default_airports(spark)
    pipeline.build(layers, airports, ts("2024-01-03"))
    pipeline.update(layers, airports.withColumn("city", F.upper("city")), ts("2024-01-04"))
    assert rows(layers.table("marts", "mart_airport_traffic").filter("city <> upper(city)")) == []


def test_history_waits_for_the_checks_of_the_aircraft(layers, spark, inputs):
    load(layers, inputs)
    airports = default_airports(spark)
    pipeline.build(layers, airports, ts("2024-01-03"))
    twice = layers.table("raw", "aircraft")
    nameless = twice.limit(1).withColumn("icao24", F.lit(None).cast("string"))
    layers.save_table("raw", "aircraft", twice.unionByName(nameless))
    report = pipeline.update(layers, airports, ts("2024-01-04"))
    if "fct_flights" in report.skipped:
        assert "aircraft_snapshot" in report.skipped


def test_settled_entries_leave_the_ledger(layers, spark, monkeypatch):
    monkeypatch.setattr(ledger, "MANY", 5)
    book = Ledger(layers)
    assert book.mark() == 0 and book.loads("load") is None and book.open_days(["m"]) == {"m": {}}
    for day in ("2024-01-01", "2024-01-02", None):
        book.open([day], "100")
    book.open([], "300")
    for name in ("m", "n"):
        book.close({name: book.open_days([name])[name] | {"2024-01-02": 0}})
    assert book.open_days(["m"]) == {"m": {"2024-01-02": 2}}
    book.settle(["m", "n"])
    assert book.mark() == 4 and layers.table("quality", "ledger").count() == 4
    assert book.open_days(["m", "n"]) == {"m": {"2024-01-02": 2}, "n": {"2024-01-02": 2}}
    assert book.loads("load").agg(F.max("load")).first()[0] == "300"
    book.close_all(["m"], book.mark())
    assert book.open_days(["m"]) == {"m": {}}
    book.open(["2024-01-02"], models=["m"])
    assert book.open_days(["m"]) == {"m": {"2024-01-02": 5}}
