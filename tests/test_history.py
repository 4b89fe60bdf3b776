from __future__ import annotations

from datetime import timedelta

import pytest
from helpers import plan_of, rows, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightloom.operators import history
from flightloom.plans.pipeline import OlderRound, advance_history, history_as_of, read_history
from flightloom.plans.star import AIRCRAFT_HISTORY as SPEC
from flightloom.sinks.tables import Layers

COLUMNS = (
    "icao24 string, manufacturer string, model string, typecode string, operator string,"
    " operator_callsign string, operator_icao string, operator_iata string"
)
T1, T2, T3 = ts("2024-01-01"), ts("2024-02-01"), ts("2024-03-01")
SHOWN = ("icao24", "model", "operator", "dbt_valid_from", "dbt_valid_to")


def source(spark, *planes):
    made = [(i, "Mk", model, "T", op, None, None, None) for i, model, op in planes]
    return spark.createDataFrame(made, COLUMNS)


def two_rounds(spark):
    first = source(spark, ("same", "m", "A"), ("moves", "m", "A"), ("gone", "m", "A"),
                   ("named", "m", None), ("refit", "m", "A"))
    second = source(spark, ("same", "m", "A"), ("moves", "m", "B"), ("new", "m", "C"),
                    ("named", "m", "D"), ("refit", "m2", "A"))
    return first, second


EXPECTED = [
    ("gone", "m", "A", T1, None),
    ("moves", "m", "A", T1, T2),
    ("moves", "m", "B", T2, None),
    ("named", "m", "D", T2, None),
    ("named", "m", None, T1, T2),
    ("new", "m", "C", T2, None),
    ("refit", "m", "A", T1, None),
    ("same", "m", "A", T1, None),
]


def test_round_closes_changed_keys_only(spark):
    first, second = two_rounds(spark)
    versions = history.next_history(history.first_versions(first, SPEC, T1), second, SPEC, T2)
    assert rows(versions, *SHOWN) == EXPECTED
    again = history.next_history(versions, second, SPEC, T3)
    assert rows(again) == rows(versions)


def test_closed_row_keeps_its_identifier(spark):
    first, second = two_rounds(spark)
    before = history.first_versions(first, SPEC, T1)
    after = history.next_history(before, second, SPEC, T2)
    ids = dict(rows(before, "icao24", "dbt_scd_id"))
    closed = after.filter(F.col("dbt_valid_to").isNotNull())
    assert {r.icao24: r.dbt_scd_id for r in closed.collect()}.items() <= ids.items()
    assert after.select("dbt_scd_id").distinct().count() == after.count()


def test_as_of_takes_the_later_version_at_the_boundary(spark):
    first, second = two_rounds(spark)
    versions = history.next_history(history.first_versions(first, SPEC, T1), second, SPEC, T2)
    at = history.as_of(versions, T2).filter("icao24 = 'moves'")
    assert rows(at, "operator") == [("B",)]
    assert history.as_of(versions, ts("2023-12-31")).count() == 0


def test_stored_history_adds_partitions_and_leaves_closed_ones(layers, spark):
    first, second = two_rounds(spark)
    advance_history(layers, first, T1)
    advance_history(layers, second, T2)
    assert rows(read_history(layers), *SHOWN) == EXPECTED
    table = layers.table("snapshots", "aircraft_snapshot")
    files = table.filter("validity <> 'open'").select(F.input_file_name()).distinct()
    closed_files = rows(files)
    third = source(spark, ("same", "m", "Z"), ("new", "m", "C"))
    advance_history(layers, third, T3)
    advance_history(layers, third, ts("2024-04-01"))
    table = layers.table("snapshots", "aircraft_snapshot")
    assert set(closed_files) <= set(rows(table.select(F.input_file_name()).distinct()))
    same = read_history(layers).filter("icao24 = 'same'")
    assert rows(same, "operator", "dbt_valid_from", "dbt_valid_to") == [
        ("A", T1, T3),
        ("Z", T3, None),
    ]


def test_a_repeated_round_takes_back_its_first_run(layers, spark):
    first, second = two_rounds(spark)
    wrong = source(spark, ("same", "m", "Q"), ("moves", "m", "A"), ("new", "m", "Q"))
    for rows_, at in ((wrong, T1), (first, T1), (wrong, T2), (second, T2), (second, T2)):
        advance_history(layers, rows_, at)
    assert rows(read_history(layers), *SHOWN) == EXPECTED
    # A run that closes nothing takes back what an earlier run of the round had closed.
    advance_history(layers, first, T2)
    assert read_history(layers).filter("dbt_valid_to IS NOT NULL").isEmpty()


def test_an_older_round_is_refused(layers, spark):
    first, second = two_rounds(spark)
    advance_history(layers, first, T2)
    with pytest.raises(OlderRound):
        advance_history(layers, second, T1)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.dictionaries(st.sampled_from("abc"), st.sampled_from("XYZ"), min_size=1), st.integers(0, 2)), min_size=1, max_size=4))
def test_stored_rounds_equal_the_last_run_of_each(spark, tmp_path_factory, runs):
    place = str(tmp_path_factory.mktemp("rounds"))
    layers = Layers(spark, place, environment=f"r{abs(hash(place))}")
    last: dict[int, dict] = {}
    at = 0
    for given_rows, step in runs:
        at += step
        last[at] = given_rows
        advance_history(layers, source(spark, *[(k, "m", v) for k, v in given_rows.items()]), ts(f"2024-01-0{at + 1}"))
    versions: dict[str, list] = {}
    for when, given_rows in sorted(last.items()):
        moment = ts(f"2024-01-0{when + 1}")
        for key, value in given_rows.items():
            own = versions.setdefault(key, [])
            if not own or own[-1][0] != value:
                if own:
                    own[-1][2] = moment
                own.append([value, moment, None])
    want = sorted(((k, *v) for k, own in versions.items() for v in own), key=repr)
    assert rows(read_history(layers), "icao24", "operator", "dbt_valid_from", "dbt_valid_to") == want
    layers.drop_environment()


def test_events_get_the_operator_of_their_time(spark):
    first, second = two_rounds(spark)
    versions = history.next_history(history.first_versions(first, SPEC, T1), second, SPEC, T2)
    events = spark.createDataFrame(
        [
            ("e1", "moves", ts("2024-01-15")),
            ("e2", "moves", T2),
            ("e3", "moves", ts("2023-06-01")),
            ("e4", "nobody", T2),
            ("e5", "moves", None),
        ],
        "id string, icao24 string, at timestamp_ntz",
    )
    joined = history.attribute_at_event(events, versions, "icao24", "at", ["operator"])
    assert rows(joined, "id", "operator") == [
        ("e1", "A"),
        ("e2", "B"),
        ("e3", None),
        ("e4", None),
        ("e5", None),
    ]


def test_ordered_passes_agree_with_the_join(spark):
    import random

    draw = random.Random(4)
    start = ts("2024-01-01")
    schema = "icao24 string, op string, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz"
    versions = []
    # A key with 10,000 versions, some apart from the next, one with few, one whose last is closed.
    for i in range(10_000):
        begin = start + timedelta(minutes=30 * i)
        versions.append(("many", f"m{i}", begin, begin + timedelta(minutes=draw.choice([30, 30, 20]))))
    versions += [("few", None, start, start + timedelta(days=2)), ("few", "f2", start + timedelta(days=2), None)]
    versions += [("shut", "s", start + timedelta(days=1), start + timedelta(days=2)), (None, "none", start, None)]
    # A third of all events are of one aircraft; some come at the very moment of a change.
    events = [("many", start + timedelta(minutes=draw.randrange(-3000, 320_000))) for _ in range(1500)]
    events += [(draw.choice(["few", "shut", "strange", None]), start + timedelta(minutes=draw.randrange(0, 6000))) for _ in range(500)]
    events += [("many", start + timedelta(minutes=30 * i)) for i in range(0, 400)]
    events += [("few", start), ("few", start + timedelta(days=2)), ("few", None), (None, None), ("shut", start + timedelta(days=2))]
    history_ = spark.createDataFrame(versions, schema)
    seen = spark.createDataFrame([(i, *e) for i, e in enumerate(events)], "n int, icao24 string, at timestamp_ntz")
    joined = history.attribute_at_event(seen, history_, "icao24", "at", ["op"])
    ordered = history.attribute_in_order(seen, history_, "icao24", "at", ["op"])
    assert ordered.columns == joined.columns
    assert rows(ordered) == rows(joined)
    assert rows(history.attribute_in_order(seen, history_.limit(0), "icao24", "at", ["op"]), "op") == [(None,)] * len(events)
    assert rows(history.attribute_in_order(seen.limit(0), history_, "icao24", "at", ["op"])) == []


def test_closed_partitions_before_the_moment_are_not_read(layers, spark):
    first, second = two_rounds(spark)
    third = source(spark, ("same", "m", "Z"), ("moves", "m", "B"))
    for frame, at in ((first, T1), (second, T2), (third, T3)):
        advance_history(layers, frame, at)
    for moment in (T1, T2, T3, ts("2024-02-15"), ts("2023-01-01")):
        assert rows(history_as_of(layers, moment)) == rows(history.as_of(read_history(layers), moment))
    filters = plan_of(history_as_of(layers, T2)).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "validity" in filters and "20240201T000000.000000" in filters
