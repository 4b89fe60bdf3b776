"""Merge and history against plain Python on random rounds."""

from __future__ import annotations

from datetime import datetime, timedelta

from helpers import raw_flights, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flightloom.operators import history
from flightloom.operators.merge import merge_rows
from flightloom.plans.star import AIRCRAFT_HISTORY as SPEC
from flightloom.schemas import FLIGHT_KEY, LOAD_ID

SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KEYS = list(FLIGHT_KEY)

a_flight = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.sampled_from([1, 2, None]),
    st.sampled_from(["arrival", "departure"]),
    st.integers(0, 9),
)
a_batch = st.lists(a_flight, max_size=8)


@given(st.lists(a_batch, min_size=1, max_size=3))
@SLOW
def test_merged_batches_equal_a_dictionary_of_keys(spark, batches):
    table = raw_flights(spark).select(*KEYS, "last_seen", LOAD_ID)
    expected = {}
    for number, batch in enumerate(batches):
        load = str(100 + number)
        made = [(i, f, k, last, "EGLL", "LFPG", "FL", load) for i, f, k, last in batch]
        table = merge_rows(
            table, raw_flights(spark, *made).select(*KEYS, "last_seen", LOAD_ID), KEYS, LOAD_ID
        )
        for *key, last in sorted(batch, key=lambda f: f[3]):
            expected[tuple(key)] = (last, load)
    assert rows(table) == sorted(((*k, *v) for k, v in expected.items()), key=repr)


a_source = st.dictionaries(
    st.sampled_from(["a", "b", "c"]),
    st.tuples(st.sampled_from(["m1", "m2"]), st.sampled_from(["X", "Y", None])),
)
COLUMNS = (
    "icao24 string, manufacturer string, model string, typecode string, operator string,"
    " operator_callsign string, operator_icao string, operator_iata string"
)


@given(st.lists(a_source, min_size=2, max_size=4))
@SLOW
def test_history_equals_a_replay_of_its_rounds(spark, rounds):
    start = datetime(2024, 1, 1)
    versions, replayed, current = None, [], {}
    for number, source in enumerate(rounds):
        at = start + timedelta(days=number)
        frame = spark.createDataFrame(
            [(k, "M", model, "T", op, None, None, None) for k, (model, op) in source.items()],
            COLUMNS,
        )
        if versions is None:
            versions = history.first_versions(frame, SPEC, at)
        else:
            versions = history.next_history(versions, frame, SPEC, at)
        for key, (model, operator) in source.items():
            if key in current and current[key][2] == operator:
                continue
            if key in current:
                replayed.append((*current[key], at))
            current[key] = (key, model, operator, at)
    replayed += [(*row, None) for row in current.values()]
    shown = ("icao24", "model", "operator", history.VALID_FROM, history.VALID_TO)
    assert rows(versions, *shown) == sorted(replayed, key=repr)
