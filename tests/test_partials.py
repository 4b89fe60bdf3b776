"""Aggregates that merge."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from flightloom.operators import partials
from flightloom.operators.merge import changes
from flightloom.operators.partials import Partial

PARTIAL = Partial(
    "keys",
    ("k",),
    lambda df: df,
    lambda: {"n": F.count(F.lit(1)), "low": F.min("x"), "high": F.max("x")},
    {"n": "sum", "low": "min", "high": "max"},
)


def some_rows(spark, seed, n=400):
    draw = random.Random(seed)
    start = date(2023, 11, 20)
    listed = [(draw.choice(["a", "b", None]), start + timedelta(draw.randrange(90)), draw.randrange(1000)) for _ in range(n)]
    return spark.createDataFrame(listed, "k string, day date, x int")


def totals(df):
    return rows(df.groupBy("k").agg(
        F.count(F.lit(1)), F.min("x"), F.max("x"), F.countDistinct("day"), F.min("day"), F.max("day")
    ))


def test_states_by_month_give_the_totals(spark):
    df = some_rows(spark, 1)
    assert rows(PARTIAL.total(PARTIAL.by_month(PARTIAL.by_day(df)))) == totals(df)


def test_overlapping_states_unite_to_exact_distinct_days(spark):
    one, two = some_rows(spark, 1), some_rows(spark, 2)
    months = [PARTIAL.by_month(PARTIAL.by_day(df)) for df in (one, two)]
    assert rows(PARTIAL.total(PARTIAL.united(months[0].unionByName(months[1])))) == totals(one.unionByName(two))


def test_days_of_bitmaps(spark):
    df = some_rows(spark, 3)
    months = PARTIAL.by_month(PARTIAL.by_day(df))
    assert rows(partials.days_of(months)) == rows(df.select("day").distinct())
    a = df.filter("k = 'a'").select("day").distinct()
    assert rows(partials.days_of(months.filter("k = 'a'"))) == rows(a)


@pytest.mark.parametrize(("grain", "months"), [
    ("day", ["2023-12-01"]), ("month", ["2023-12-01"]), ("quarter", ["2023-12-01", "2024-01-01", "2024-02-01"]),
])
def test_months_of_periods(grain, months):
    assert partials.months_of([date(2023, 12, 1)], grain) == months


def test_what_a_batch_changes(spark):
    schema = "k int, load string, x int, y string"
    stored = spark.createDataFrame(
        [(1, "5", 1, "a"), (2, "5", 1, "a"), (3, "5", 1, None), (4, "5", 1, "a"), (5, None, 1, "a"), (None, "5", 1, "a")], schema
    )
    batch = spark.createDataFrame(
        [
            (1, "5", 1, "a"),  # the same
            (2, "6", 1, "a"),  # the same, more recent
            (3, "6", 2, None),  # another value
            (4, "4", 2, "a"),  # another value, but less recent
            (5, "9", 1, "b"),  # null is the most recent
            (6, "1", 1, "a"),  # a new key
            (None, "5", 1, "a"),  # null is a key
        ],
        schema,
    )
    found = {r["k"]: (r["written"], r["changed"]) for r in changes(batch, stored, ["k"], "load").collect()}
    assert found == {
        1: (False, False), 2: (True, False), 3: (True, True), 4: (False, False), 5: (False, False), 6: (True, True),
        None: (False, False),
    }
    lacking = {r["k"]: r["changed"] for r in changes(batch.drop("y"), stored, ["k"], "load").collect()}
    assert lacking == {1: True, 2: True, 3: True, 4: False, 5: False, 6: True, None: True}
