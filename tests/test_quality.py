from __future__ import annotations

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from flightloom.operators import quality
from flightloom.schemas import CONTRACTS


@pytest.fixture
def frame(spark):
    data = [("a", "x"), ("a", "y"), (None, "x"), (None, None), ("b", "z")]
    return spark.createDataFrame(data, "k string, v string")


def test_repeated_values_ignore_nulls(frame):
    assert rows(quality.repeated_values(frame, "k")) == [("a", 2)]


def test_null_rows(frame):
    assert quality.null_rows(frame, "k").count() == 2


def test_unaccepted_values_ignore_nulls(frame):
    assert rows(quality.unaccepted_values(frame, "v", ["x", "y"])) == [("z", 1)]


@pytest.mark.parametrize("unique", ["k", None])
def test_check_counts_agree_with_single_checks(frame, unique):
    counts = quality.check_counts(frame, unique, ["k", "v"], {"v": ["x", "y"]}).first().asDict()
    expected = {"not_null:k": 2, "not_null:v": 1, "accepted_values:v": 1}
    assert counts == ({"unique:k": 1} if unique else {}) | expected


@pytest.mark.parametrize("unique", ["k", "w", None])
def test_failures_by_hash_are_those_by_value(spark, frame, unique):
    wider = frame.withColumn("w", F.concat_ws("-", F.lit("w"), F.monotonically_increasing_id()))
    given = (unique, ["k", "v"], {"v": ["x", "y"]})
    assert quality.failure_counts(wider, *given) == quality.check_counts(wider, *given).first().asDict()


def test_values_are_grouped_only_if_a_hash_is_repeated(spark, frame, monkeypatch):
    asked, count = [], quality.check_counts
    monkeypatch.setattr(quality, "check_counts", lambda df, unique, *a: asked.append(unique) or count(df, unique, *a))
    assert quality.failure_counts(frame.filter("k = 'b' or k is null"), "k", [], {}) == {"unique:k": 0}
    assert asked == ["__hash"]
    assert quality.failure_counts(frame, "k", [], {}) == {"unique:k": 1}
    assert asked[1:] == ["__hash", "k"]


def test_hashes_are_grouped_without_other_counts(frame, monkeypatch):
    asked, count = [], quality.check_counts
    monkeypatch.setattr(quality, "check_counts", lambda df, *a: asked.append((df.columns, *a)) or count(df, *a))
    single = frame.filter("k = 'b' or v is null")
    assert quality.failure_counts(single, "k", ["v"], {}) == {"unique:k": 0, "not_null:v": 1}
    assert asked == [(["__hash"], "__hash", [], {}), (["k", "v"], None, ["v"], {})]


@pytest.mark.parametrize(
    ("hours", "status"), [(0, "pass"), (25, "pass"), (25.5, "warn"), (49, "warn"), (50, "error")]
)
def test_freshness_thresholds(spark, hours, status):
    loads = spark.createDataFrame([("999",), ("1704067200",)], "_dlt_load_id string")
    moment = ts("2024-01-01") if hours == 0 else ts("2024-01-01").fromtimestamp(
        1704067200 + hours * 3600, tz=__import__("datetime").timezone.utc
    )
    assert quality.freshness(loads, "_dlt_load_id", moment).first().status == status


def test_no_load_at_all_is_an_error(spark):
    none = spark.createDataFrame([], "_dlt_load_id string")
    assert quality.freshness(none, "_dlt_load_id", ts("2024-01-01")).first().status == "error"


def test_contract_names_every_difference(spark):
    contract = CONTRACTS["mart_traffic_patterns"]
    good = spark.createDataFrame([], contract)
    assert quality.enforce_contract(good.select(*reversed(good.columns)), contract, "t").columns == good.columns
    bad = good.drop("city").withColumn("hour_of_day", F.lit(1)).withColumn("extra", F.lit("x"))
    with pytest.raises(quality.ContractViolation) as error:
        quality.enforce_contract(bad, contract, "t")
    for part in ("city: declared string, found none", "hour_of_day: declared bigint, found int",
                 "extra: declared none, found string"):
        assert part in str(error.value)
