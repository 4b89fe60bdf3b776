from __future__ import annotations

import pytest
from helpers import flight, plan_of, raw_flights, rows
from pyspark.sql import functions as F
from test_tables import KEYS, with_day

from flightloom import files
from flightloom.operators.merge import changes, merge_rows, news
from flightloom.schemas import LOAD_ID
from flightloom.sinks.snapshots import SnapshotTable
from flightloom.sinks.tables import UnknownColumns

DAY = 86_400


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "flights"), KEYS, LOAD_ID, "seen_on")


def seen(df):
    return rows(df, "icao24", "first_seen", "last_seen")


def batches(spark):
    return [
        raw_flights(spark, flight(), flight(icao24="a2"), flight(first=DAY), flight(first=None)),
        raw_flights(spark, flight(last=7, load="300"), flight(icao24="a3", last=9, load="300")),
        raw_flights(spark, flight(last=5, load="200"), flight(first=None, last=4, load="200")),
        raw_flights(spark, flight(first=2 * DAY, load="400"), flight(icao24=None, first=DAY, load="400")),
    ]


@pytest.mark.parametrize("only_changes", [True, False])
def test_rows_are_those_of_a_merge_whatever_the_order_of_batches(spark, table, tmp_path, only_changes):
    given = [with_day(b) for b in batches(spark)]
    merged = given[0].limit(0)
    for batch in given:
        merged = merge_rows(merged, batch, KEYS, LOAD_ID)
        table.write(batch, only_changes)
    want = rows(merged, *merged.columns)
    assert rows(table.read(), *merged.columns) == want
    other = SnapshotTable(spark, str(tmp_path / "other"), KEYS, LOAD_ID, "seen_on")
    for batch in reversed(given):
        other.write(batch, only_changes)
    assert rows(other.read(), *merged.columns) == want
    other.compact(most=0)
    assert all(len(held) == 1 for held in other.snapshot().parts.values())
    assert rows(other.read(), *merged.columns) == want


def test_a_late_row_writes_one_small_file_and_reads_its_own_day_only(spark, table):
    table.write(with_day(batches(spark)[0]))
    before = table.snapshot()
    after = table.write(with_day(raw_flights(spark, flight(icao24="late", first=DAY + 5, load="900"))))
    new = {b for held in after.parts.values() for b in held} - {b for held in before.parts.values() for b in held}
    assert len(new) == 1
    (batch,) = new
    folder = f"{table.root}/data/batch={batch}"
    (day,) = (f for f in files.folders(spark, folder) if "=" in f)
    assert day == "seen_on=1970-01-02"
    assert len([n for n in files.names(spark, f"{folder}/{day}") if n.endswith(".parquet")]) == 1
    assert {p: b for p, b in after.parts.items() if p != day} == {p: b for p, b in before.parts.items() if p != day}
    assert "Window" not in plan_of(table.read(values=["1970-01-01"]))
    assert "Window" in plan_of(table.read(values=["1970-01-02"]))
    assert seen(table.read(values=["1970-01-02"])) == [("a1", DAY, 3600), ("late", DAY + 5, 3600)]
    assert seen(table.read(values=[None])) == [("a1", None, 3600)]
    assert seen(table.read(values=["1999-01-01"])) == []


def test_a_repeated_batch_makes_no_snapshot(spark, table):
    for batch in batches(spark)[:2]:
        table.write(with_day(batch))
    folders = files.folders(spark, f"{table.root}/data")
    for batch in batches(spark)[:2]:
        assert table.write(with_day(batch)).number == 2
    assert table.write(with_day(batches(spark)[0]).limit(0)).number == 2
    assert files.folders(spark, f"{table.root}/data") == folders


@pytest.mark.parametrize("step", range(12))
def test_a_reader_sees_the_old_or_the_new_rows_at_every_step(spark, table, monkeypatch, step):
    """A writer lost at any call to the file system leaves the old state; the next one succeeds."""
    table.write(with_day(batches(spark)[0]))
    old, calls = seen(table.read()), []

    def counted(call):
        def run(*args):
            if len(calls) == step:
                raise ConnectionError("lost")
            calls.append(call)
            return call(*args)

        return run

    lost = False
    with monkeypatch.context() as patched:
        for name in ("names", "folders", "publish", "remove"):
            patched.setattr(files, name, counted(getattr(files, name)))
        try:
            table.write(with_day(batches(spark)[1]))
        except ConnectionError:
            lost = True
    new = [("a1", 0, 7), ("a1", DAY, 3600), ("a1", None, 3600), ("a2", 0, 3600), ("a3", 0, 9)]
    assert seen(table.read()) == (old if lost else sorted(new, key=repr))
    table.write(with_day(batches(spark)[1]))
    assert seen(table.read()) == sorted(new, key=repr)
    kept = seen(table.read())
    table.expire(keep=1)
    assert seen(table.read()) == kept


def test_an_open_reader_keeps_its_snapshot(spark, table):
    for batch in batches(spark):
        table.write(with_day(batch))
    first = table.read(1)
    old = seen(first)
    table.compact(most=0)
    table.replace(with_day(raw_flights(spark, flight(icao24="z"))))
    assert seen(first) == old and seen(table.read(1)) == old
    assert seen(table.read()) == [("z", 0, 3600)]
    assert table.expire(keep=2) == [1, 2, 3, 4]
    assert table.numbers() == [5, 6]
    assert len(seen(table.read(5))) == 7
    with pytest.raises(Exception):  # noqa: B017
        table.read(1)


def test_replace_may_read_the_table_and_take_new_columns(spark, table):
    table.write(with_day(batches(spark)[0]))
    table.replace(table.read().where("first_seen = 0").withColumn("more", F.lit(1)))
    assert rows(table.read(), "icao24", "more") == [("a1", 1), ("a2", 1)]
    table.write(with_day(raw_flights(spark, flight(icao24="a4"))))
    assert rows(table.read(), "icao24", "more") == [("a1", 1), ("a2", 1), ("a4", None)]


def test_compaction_leaves_partitions_with_few_deltas_alone(spark, table):
    table.write(with_day(batches(spark)[0]))
    for last in range(4):
        table.write(with_day(raw_flights(spark, flight(last=last, load=f"50{last}"))))
    before = table.snapshot()
    assert table.compact(most=4) == before
    after = table.compact(most=3)
    changed = {p for p in after.parts if after.parts[p] != before.parts[p]}
    assert changed == {"seen_on=1970-01-01"}
    assert ("a1", 0, 3) in seen(table.read())


def test_refusals(spark, table):
    with pytest.raises(LookupError):
        table.read()
    assert table.compact() is None and table.expire() == []
    table.write(with_day(batches(spark)[0]))
    with pytest.raises(UnknownColumns):
        table.write(with_day(batches(spark)[1]).withColumn("odd", F.lit(1)))
    with pytest.raises(FileExistsError):
        table._commit(None, table.snapshot().columns, {})
    assert len(seen(table.read())) == 4


def test_news_are_the_written_rows_in_one_shuffle(spark):
    stored = with_day(batches(spark)[0])
    older = with_day(batches(spark)[2])
    batch = with_day(
        raw_flights(
            spark,
            flight(last=7, load="300"),  # more recent
            flight(icao24="a2"),  # the same
            flight(first=DAY, last=1, load="050"),  # older
            flight(first=None, last=9, load="100"),  # older than the second batch
            flight(icao24=None, first=DAY, load="400"),  # new, without a name
            flight(icao24="a2", first=5, last=6, load=None),
        )
    )
    found = news(batch, stored.union(older), KEYS, LOAD_ID)
    plan = plan_of(found)
    assert plan.count("Exchange") == 1 and "Join" not in plan
    one = merge_rows(stored, older, KEYS, LOAD_ID)
    want = changes(batch, one, KEYS, LOAD_ID).where("written").select(*batch.columns)
    assert rows(found) == rows(want)
    assert len(rows(want)) == 3
