from __future__ import annotations

import hashlib

import pytest
from helpers import rows, ts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from flightloom.functions import (
    blank_to_null,
    epoch_to_ntz,
    history_row_id,
    joined_label,
    manufacturer_name,
    minutes_between,
    start_of,
    surrogate_key,
)
from flightloom.session import session_conf

ZONES = ("UTC", "America/New_York", "Asia/Kathmandu")


@pytest.mark.parametrize("zone", ZONES)
@pytest.mark.parametrize(
    ("start", "end", "minutes"),
    [
        ("2024-01-01 00:00:59", "2024-01-01 00:02:01", 2),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:59", 0),
        ("2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
        ("2024-03-10 01:30:00", "2024-03-10 03:30:00", 120),
        ("2024-01-02 00:00:00", "2024-01-01 23:59:59", -1),
        ("2023-12-31 23:59:59", "2024-01-01 00:00:00", 1),
    ],
)
def test_minutes_count_boundaries_in_any_zone(spark, zone, start, end, minutes):
    cast = lambda text: F.lit(text).cast("timestamp_ntz")
    with session_conf(spark, {"spark.sql.session.timeZone": zone}):
        found = spark.range(1).select(minutes_between(cast(start), cast(end))).first()[0]
    assert found == minutes


@given(
    st.integers(min_value=-(10**9), max_value=4 * 10**9),
    st.integers(min_value=-(10**6), max_value=10**6),
)
@settings(max_examples=15, deadline=None)
def test_minutes_equal_difference_of_whole_minutes(spark, first, length):
    start, end = epoch_to_ntz(F.lit(first)), epoch_to_ntz(F.lit(first + length))
    found = spark.range(1).select(minutes_between(start, end)).first()[0]
    assert found == (first + length) // 60 - first // 60


@pytest.mark.parametrize("zone", ZONES)
def test_epoch_is_utc_in_any_zone(spark, zone):
    with session_conf(spark, {"spark.sql.session.timeZone": zone}):
        found = spark.range(1).select(epoch_to_ntz(F.lit("1704067200")).alias("t"))
        assert found.schema["t"].dataType.simpleString() == "timestamp_ntz"
        assert found.first().t == ts("2024-01-01")


def test_epoch_that_is_no_number_raises(spark):
    frame = spark.createDataFrame([("soon",)], "s string").select(epoch_to_ntz(F.col("s")))
    with pytest.raises(NumberFormatException):
        frame.collect()


@pytest.mark.parametrize(
    ("grain", "start"),
    [
        ("hour", "2024-01-07 23:00:00"),
        ("day", "2024-01-07"),
        ("week", "2024-01-01"),
        ("month", "2024-01-01"),
        ("year", "2024-01-01"),
    ],
)
def test_start_of_a_sunday_evening(spark, grain, start):
    moment = F.lit("2024-01-07 23:45:10").cast("timestamp_ntz")
    assert spark.range(1).select(start_of(grain, moment)).first()[0] == ts(start)


def test_unknown_grain_is_refused(spark):
    with pytest.raises(ValueError, match="fortnight"):
        start_of("fortnight", F.lit(None).cast("timestamp_ntz"))


def test_surrogate_key_marks_nulls(spark):
    frame = spark.createDataFrame([("a", None), (None, "a"), ("", "a")], "x string, y string")
    text = ("a-_dbt_utils_surrogate_key_null_", "_dbt_utils_surrogate_key_null_-a", "-a")
    expected = sorted((hashlib.md5(t.encode()).hexdigest(),) for t in text)
    assert rows(frame.select(surrogate_key("x", "y"))) == expected


def test_history_row_id(spark):
    moment = F.lit("2024-01-01 06:00:00").cast("timestamp_ntz")
    found = spark.range(1).select(history_row_id(F.lit("a1"), moment)).first()[0]
    assert found == hashlib.md5(b"a1|2024-01-01 06:00:00").hexdigest()


def test_blank_to_null_trims_spaces_only(spark):
    frame = spark.createDataFrame([(" x ",), ("  ",), ("",), (None,), ("\t",)], "s string")
    assert rows(frame.select(blank_to_null(F.col("s")))) == sorted(
        [("x",), (None,), (None,), (None,), ("\t",)], key=repr
    )


@pytest.mark.parametrize(
    ("raw", "name"),
    [
        ("AIRBUS SAS", "Airbus"),
        ("Boing", "Boeing"),
        ("Empresa Brasileira De Aeronautica", "Embraer"),
        ("Bombardier (Airbus Canada)", "Airbus"),
        ("Cessna", "Cessna"),
        ("", ""),
        (None, None),
    ],
)
def test_manufacturer_name(spark, raw, name):
    value = F.lit(raw).cast("string")
    assert spark.range(1).select(manufacturer_name(value)).first()[0] == name


def test_label_needs_both_sides(spark):
    frame = spark.createDataFrame([("A", "B"), ("A", None)], "x string, y string")
    assert rows(frame.select(joined_label(F.col("x"), F.col("y")))) == [("A → B",), (None,)]


@pytest.mark.parametrize(
    ("part", "whole", "rounded"), [(41, 40, 1.03), (-41, 40, -1.03), (1, 8, 0.13), (2, 3, 0.67)]
)
def test_ratios_round_half_away_from_zero(spark, part, whole, rounded):
    assert spark.range(1).select(F.round(F.lit(part) / F.lit(whole), 2)).first()[0] == rounded
