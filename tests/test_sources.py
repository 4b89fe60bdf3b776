from __future__ import annotations

import json
import logging
from datetime import date, datetime, timezone

import pytest
from helpers import rows
from py4j.protocol import Py4JJavaError

from flightloom.fixtures import queries
from flightloom.fixtures.workspace import Workspace
from flightloom.schemas import AIRCRAFT_COLUMNS
from flightloom.sources import landing, reference, tables
from flightloom.streaming.landing import follow_landing


def deliver(base, day, kind, text):
    folder = base / f"day={day}" / f"flight_type={kind}"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text(text)


def record(icao24, first):
    return {"icao24": icao24, "firstSeen": first, "estDepartureAirport": "EGLL", "extra": {"x": 1}}


@pytest.fixture
def base(tmp_path):
    folder = tmp_path / "landing"
    deliver(folder, "2024-01-01", "arrival", json.dumps([record("a1", 1), record("a2", 2)]))
    lines = "\n".join(json.dumps(record(i, n)) for i, n in (("a3", 3), ("a4", 4)))
    deliver(folder, "2024-01-01", "departure", lines)
    deliver(folder, "2024-01-02", "arrival", "[]")
    deliver(folder, "2024-01-03", "departure", json.dumps(record("a5", 5)))
    return folder


def test_arrays_lines_and_empty_bodies(spark, base):
    landed = landing.snake_case(landing.read_landed(spark, str(base)))
    assert rows(landed, "icao24", "first_seen", "flight_type") == [
        ("a1", 1, "arrival"),
        ("a2", 2, "arrival"),
        ("a3", 3, "departure"),
        ("a4", 4, "departure"),
        ("a5", 5, "departure"),
    ]
    assert "est_arrival_airport_horiz_distance" in landed.columns


def test_absent_day_is_zero_rows_and_a_warning(spark, base, caplog):
    days = [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 9)]
    assert landing.read_landed(spark, str(base), [date(2024, 1, 9)]).count() == 0
    with caplog.at_level(logging.WARNING):
        landing.warn_missing(spark, str(base), days)
    assert sorted(r.getMessage() for r in caplog.records) == [
        "no arrival records landed for 1 day(s), skipped: 2024-01-09",
        "no departure records landed for 2 day(s), skipped: 2024-01-02, 2024-01-09",
    ]


def test_only_the_asked_days_are_read(spark, base):
    landed = landing.read_landed(spark, str(base), [date(2024, 1, 3)])
    assert rows(landed, "icao24") == [("a5",)]
    assert {f.split("day=")[1][:10] for f in landed.inputFiles()} == {"2024-01-03"}


def test_folders_of_other_days_are_not_listed(spark, base):
    # A level that contradicts the others would fail any listing of the whole folder.
    (base / "day=2024-01-09" / "odd=1" / "flight_type=arrival").mkdir(parents=True)
    (base / "day=2024-01-09" / "odd=1" / "flight_type=arrival" / "x.json").write_text("{broken")
    (base / "elsewhere=1").mkdir()
    (base / "elsewhere=1" / "x.json").write_text("{broken")
    days = [date(2024, 1, 3)]
    assert landing.read_landed(spark, str(base), days).count() == 1
    assert rows(landing.landed_slices(spark, str(base), days)) == [(date(2024, 1, 3), "departure", None)]


def test_slices_are_missed_by_airport(spark, tmp_path, caplog):
    base = tmp_path / "by_airport"
    for kind, airport in (("arrival", "EGLL"), ("arrival", "LFPG"), ("departure", "EGLL")):
        folder = base / "day=2024-01-01" / f"flight_type={kind}" / f"airport={airport}"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text("[]")
    with caplog.at_level(logging.WARNING):
        landing.warn_missing(spark, str(base), [date(2024, 1, 1)], ["EGLL", "LFPG"])
    assert [r.getMessage() for r in caplog.records] == [
        "no departure records of LFPG landed for 1 day(s), skipped: 2024-01-01"
    ]


def test_a_folder_per_airport_makes_no_difference(spark, tmp_path):
    folder = tmp_path / "by_airport" / "day=2024-01-01" / "airport=EGLL" / "flight_type=arrival"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text(json.dumps([record("a1", 1)]))
    landed = landing.read_landed(spark, str(tmp_path / "by_airport"), [date(2024, 1, 1)])
    assert landed.columns == landing.LANDED_SCHEMA.names
    assert rows(landed, "icao24", "day", "flight_type") == [("a1", date(2024, 1, 1), "arrival")]


def test_malformed_record_raises(spark, base):
    deliver(base, "2024-01-04", "arrival", '{"icao24": "a6", "firstSeen": "no"')
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        landing.read_landed(spark, str(base)).collect()


def test_day_window_and_default_day():
    assert landing.day_window(date(2024, 1, 1)) == (1704067200, 1704153600)
    late = datetime(2024, 1, 1, 23, 30, tzinfo=timezone.utc)
    assert landing.yesterday(late) == date(2023, 12, 31)


def test_stream_loads_each_delivery_once(spark, base, layers, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    follow_landing(layers, str(base), checkpoint, "100", files_per_batch=1)
    assert layers.table("raw", "flights").count() == 5
    deliver(base, "2024-01-05", "arrival", json.dumps([record("a1", 1), record("a9", 9)]))
    follow_landing(layers, str(base), checkpoint, "200")
    stored = layers.table("raw", "flights")
    assert rows(stored, "icao24", "_dlt_load_id") == [
        ("a1", "200"),
        ("a2", "100"),
        ("a3", "100"),
        ("a4", "100"),
        ("a5", "100"),
        ("a9", "200"),
    ]


def test_aircraft_file_by_header(spark, tmp_path):
    names = ["serial", *reversed(AIRCRAFT_COLUMNS)]
    values = ["7", "NA", " ", "Call ""X""", 'Say ""Hi"", Ltd', "A320", "", "nan", "R1", "a1"]
    text = ",".join(names) + "\n" + ",".join(f'"{v}"' for v in values) + "\n"
    (tmp_path / "a.csv").write_text(text)
    found = reference.read_aircraft(spark, str(tmp_path / "a.csv"))
    assert found.columns == list(AIRCRAFT_COLUMNS)
    assert found.first().asDict() == {
        "icao24": "a1",
        "registration": "R1",
        "manufacturername": None,
        "model": None,
        "typecode": "A320",
        "operator": 'Say "Hi", Ltd',
        "operatorcallsign": "Call X",
        "operatoricao": " ",
        "operatoriata": None,
    }


def test_airport_seed_must_have_its_header(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("icao_code,iata_code,name,city,country\nLEMD,MAD,Adolfo Suárez,Madrid,Spain\n")
    bad.write_text("iata_code,icao_code,name,city,country\nMAD,LEMD,Adolfo,Madrid,Spain\n")
    assert reference.read_airports(spark, str(good)).first().name == "Adolfo Suárez"
    with pytest.raises(Py4JJavaError, match="does not conform"):
        reference.read_airports(spark, str(bad)).collect()


def test_sql_over_views(spark):
    found = tables.run_sql(spark, "select sum(id) as s from {some_rows}", {"some_rows": spark.range(4)})
    assert rows(found) == [(6,)]


def test_scattered_files_grow_in_number_and_are_followed_in_six_batches_or_fewer(spark, monkeypatch):
    space = Workspace(spark, "/root/testdata/sf0.001")
    followed = []

    def follow(layers, path, *_, files_per_batch, **__):
        found = spark.read.format("binaryFile").load(path).select("flight_type").collect()
        followed.append((len(found), files_per_batch))
        layers.save_table("raw", "flights", space.table("raw_flights"))

    monkeypatch.setattr(queries, "follow_landing", follow)
    queries.stream_any_batch_size(space)
    monkeypatch.setattr(queries, "SCATTERED_BYTES", 20_000)
    queries.stream_any_batch_size(space)
    (few, one), (many, several) = followed
    assert (few, one) == (6, 1)
    assert many > 6 and -(-many // several) <= 6
