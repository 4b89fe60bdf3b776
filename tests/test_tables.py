from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from helpers import RAW_FLIGHTS, flight, plan_of, raw_flights, rows
from pyspark.sql import functions as F

from flightloom import files
from flightloom.operators.merge import changes, merge_rows, merged_news
from flightloom.schemas import FLIGHT_KEY, LOAD_ID
from flightloom.sinks import tables
from flightloom.sinks.tables import UnknownColumns

KEYS = list(FLIGHT_KEY)


def with_day(df):
    return df.withColumn("seen_on", F.date_add(F.lit("1970-01-01"), (F.col("first_seen") / 86400).cast("int")))


def merge(layers, df):
    layers.merge("raw", "flights", with_day(df), KEYS, LOAD_ID, "seen_on")


def stored(layers):
    return rows(layers.table("raw", "flights"), "icao24", "first_seen", "last_seen")


def test_merge_replaces_matching_keys_and_keeps_the_rest(spark):
    existing = raw_flights(spark, flight(last=1), flight(icao24="a2", last=1))
    batch = raw_flights(spark, flight(last=2, load="200"), flight(icao24="a3", last=2))
    merged = merge_rows(existing, batch, KEYS, LOAD_ID)
    assert rows(merged, "icao24", "last_seen") == [("a1", 2), ("a2", 1), ("a3", 2)]


def test_merge_with_null_keys_can_be_repeated(spark):
    batch = raw_flights(spark, flight(first=None), flight(first=None), flight(icao24=None))
    once = merge_rows(spark.createDataFrame([], RAW_FLIGHTS), batch, KEYS, LOAD_ID)
    twice = merge_rows(once, batch, KEYS, LOAD_ID)
    assert rows(once) == rows(twice)
    assert len(rows(once)) == 2


def test_table_merge_is_idempotent_and_leaves_other_days_alone(layers, spark):
    merge(layers, raw_flights(spark, flight(), flight(first=90_000), flight(first=None)))
    files = {r.f for r in layers.table("raw", "flights").select(F.input_file_name().alias("f")).collect()}
    batch = raw_flights(spark, flight(first=90_000, last=5, load="200"), flight(first=None))
    for _ in range(2):
        merge(layers, batch)
        assert stored(layers) == sorted(
            [("a1", 0, 3600), ("a1", 90_000, 5), ("a1", None, 3600)], key=repr
        )
    after = {r.f for r in layers.table("raw", "flights").select(F.input_file_name().alias("f")).collect()}
    assert {f for f in files if "1970-01-01" in f} <= after


def test_interrupted_publication_is_finished_by_the_next_merge(layers, spark, monkeypatch):
    merge(layers, raw_flights(spark, flight(), flight(icao24="a2"), flight(first=90_000)))
    complete = raw_flights(spark, flight(last=7, load="200"), flight(first=90_000, last=8, load="200"))
    moved, move = [], files.move

    def failing(session, source, target):
        if "seen_on=" in target and moved:
            raise RuntimeError("lost")
        moved.append(target)
        move(session, source, target)

    with monkeypatch.context() as patched:
        patched.setattr(files, "move", failing)
        moved.clear()
        patched.setattr(layers, "finish_replacement", lambda *_: None)
        merge(layers, complete)
        patched.undo()
        patched.setattr(files, "move", failing)
        with pytest.raises(RuntimeError):
            layers.finish_replacement("raw", "flights")
    merge(layers, raw_flights(spark, flight(icao24="a3", last=9)))
    assert stored(layers) == [("a1", 0, 7), ("a1", 90_000, 8), ("a2", 0, 3600), ("a3", 0, 9)]
    assert not files.exists(spark, layers.location("raw", "flights") + "__pending")


@pytest.mark.parametrize("renames", [1, 2])
def test_interrupted_swap_is_finished_by_the_next_writer(layers, spark, monkeypatch, renames):
    layers.save_table("marts", "t", spark.range(3))
    done, rename = [], layers._rename

    def failing(old, new):
        if len(done) == renames:
            raise RuntimeError("lost")
        done.append(new)
        rename(old, new)

    with monkeypatch.context() as patched:
        patched.setattr(layers, "_rename", failing)
        with pytest.raises(RuntimeError):
            layers.save_table("marts", "t", spark.range(5))
    layers.recover("marts", "t")
    assert layers.table("marts", "t").count() == 5
    assert layers.save_table("marts", "t", spark.range(2)) == 2
    listed = spark.catalog.listTables(layers.name("marts", "x").split(".")[0])
    assert {t.name for t in listed if not t.isTemporary} == {"t"}


def test_older_load_never_replaces_a_newer_one(layers, spark):
    merge(layers, raw_flights(spark, flight(last=2, load="200")))
    merge(layers, raw_flights(spark, flight(last=1, load="100")))
    assert stored(layers) == [("a1", 0, 2)]


def test_unknown_columns_are_refused_and_missing_ones_are_null(layers, spark):
    merge(layers, raw_flights(spark, flight()))
    with pytest.raises(UnknownColumns, match="extra"):
        merge(layers, raw_flights(spark, flight(icao24="a2")).withColumn("extra", F.lit(1)))
    merge(layers, raw_flights(spark, flight(icao24="a2")).drop("last_seen"))
    assert stored(layers) == [("a1", 0, 3600), ("a2", 0, None)]


def test_a_merge_scans_its_batch_once_and_lists_only_its_partitions(layers, spark, monkeypatch):
    days = [flight(icao24=f"a{d}", first=d * 86_400) for d in range(4)]
    merge(layers, raw_flights(spark, *days))
    listed = []
    partitions = layers.partitions
    monkeypatch.setattr(layers, "partitions", lambda *a: listed.append(partitions(*a)) or listed[-1])
    merge(layers, raw_flights(spark, flight(icao24="a2", first=2 * 86_400, last=5, load="200")))
    assert {f.split("seen_on=")[1].split("/")[0] for f in listed[0].inputFiles()} == {"1970-01-03"}
    plan = plan_of(merge_rows(raw_flights(spark, days[0]), raw_flights(spark, days[1]), KEYS, LOAD_ID))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_refresh_may_read_the_table_it_replaces(layers, spark):
    layers.save_table("marts", "t", spark.range(3))
    written = layers.save_table("marts", "t", layers.table("marts", "t").filter("id > 0"))
    assert written == 2
    assert rows(layers.table("marts", "t")) == [(1,), (2,)]


def test_partitioned_table_survives_the_swap(layers, spark):
    for _ in range(2):
        frame = spark.range(10).withColumn("part", F.col("id") % 3)
        assert layers.save_table("marts", "p", frame, partition_by="part") == 10
    assert layers.table("marts", "p").filter("part = 0").count() == 4


def test_schemas_keep_their_names(layers, spark):
    layers.save_table("raw", "one", spark.range(1))
    layers.save_table("marts", "one", spark.range(2))
    assert layers.table("raw", "one").count() == 1
    assert layers.table("marts", "one").count() == 2
    assert layers.name("marts", "one").endswith("_marts.one")


def test_view_reads_its_source_anew(layers, spark):
    layers.save_table("raw", "src", spark.range(1))
    view = layers.save_view("staging", "v_src", layers.table("raw", "src").filter("id >= 0"))
    assert view.count() == 1
    layers.append("raw", "src", spark.range(2))
    assert spark.table(layers.view_name("staging", "v_src")).count() == 3


def test_a_merge_deals_rows_once_and_says_what_changes(spark):
    keys = ["k", "day"]
    schema = "k int, day date, v string, load string"
    day = date(2024, 1, 1)
    one = lambda k, v, load: (k, None if k is None else day, v, load)
    stored = [one(None, "a", "1"), one(1, "a", "1"), one(2, "a", "2"), one(3, "a", None), one(4, None, "1"), one(9, "z", "1")]
    given = [one(None, "b", "2"), one(1, "a", "1"), one(2, "b", "1"), one(3, "b", "9"), one(4, None, "2"), one(5, "n", "1")]
    existing, batch = spark.createDataFrame(stored, schema), spark.createDataFrame(given, schema)
    found = merged_news(existing, batch, keys, "load", "day", buckets=3)
    assert plan_of(found).count("Exchange ") == 1
    rows = found.collect()
    assert Counter(r[:4] for r in rows) == Counter(map(tuple, merge_rows(existing, batch, keys, "load").collect()))
    told = {r["k"]: (r["written"], r["changed"]) for r in changes(batch, existing, keys, "load").collect()}
    assert {r["k"]: r[4:] for r in rows} == {**told, 9: (False, False)}


def test_partitions_that_a_table_lacks_are_written_without_a_merge(spark, layers, monkeypatch):
    schema = "k int, day date, v string, load string"
    days = [date(2024, 1, d) for d in (1, 2, 3)]

    def merge(rows):
        return layers.merge("raw", "met", spark.createDataFrame(rows, schema), ["k", "day"], "load", "day")

    merge([(1, days[0], "a", "1")])
    met = []
    monkeypatch.setattr(tables, "merged_news", lambda old, batch, *rest, **named: (
        met.extend(r[0] for r in batch.select("day").collect()) or merged_news(old, batch, *rest, **named)
    ))
    assert merge([(2, days[1], "b", "1"), (2, days[1], "a", "0")]) == ["2024-01-02"]
    assert met == []
    assert sorted(merge([(1, days[0], "c", "2"), (2, days[1], "b", "1"), (3, days[2], "n", "1")])) == ["2024-01-01", "2024-01-03"]
    assert sorted(met) == days[:2]
    got = sorted(tuple(r) for r in layers.table("raw", "met").select("k", "day", "v", "load").collect())
    assert got == [(1, days[0], "c", "2"), (2, days[1], "b", "1"), (3, days[2], "n", "1")]


def test_environments_share_the_lock_of_the_session_settings(spark, layers, tmp_path):
    other = tables.Layers(spark, str(tmp_path / "other"), environment=f"{layers.prefix}other")
    assert other._settings is layers._settings and layers.in_session(spark)._settings is layers._settings
    other.drop_environment()
