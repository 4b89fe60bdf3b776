"""The physical plans hold what the scale of the data needs."""

from __future__ import annotations

import re

from helpers import plan_of, rows
from pyspark.sql import functions as F

from flightloom.fixtures.queries import _balance, registered
from flightloom.fixtures.workspace import Workspace, workspace
from flightloom.operators.dedup import latest_per_key
from flightloom.operators.lookup import lookup
from flightloom.session import session_conf

SF = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = plan_of(workspace(spark, SF).build("stg_flights"))
    partial, exchange, final = (
        plan.index(part) for part in ("1, Partial", "Exchange", "1, Final")
    )
    assert final < exchange < partial  # printed top down
    assert "md5" in plan[:exchange]
    assert "md5" not in plan[exchange:]
    assert "PushedFilters: [IsNotNull(first_seen)]" in plan


def test_raw_tables_are_stored_as_they_are_derived(spark, monkeypatch):
    """No shuffle for the layout of files, and no table for a view over a large one."""
    space = Workspace(spark, SF)
    written, write = {}, space._written
    monkeypatch.setattr(space, "_written", lambda name, df: written.setdefault(name, plan_of(df)) and write(name, df))
    assert space.table("stg_flights").count() > 0
    assert "raw_flights" in written and "stg_flights" not in written
    assert "Exchange" not in written["raw_flights"]
    assert {f.rsplit(".", 3)[-2] for f in space.table("raw_flights").inputFiles()} == {"zstd"}
    assert {f.rsplit(".", 1)[-1] for f in spark.read.format("binaryFile").load(space.landing).inputFiles()} == {"gz"}


def test_marts_read_only_their_columns(spark):
    space = workspace(spark, SF)
    for name, columns in (
        ("mart_airport_traffic", {"airport_icao", "flight_type", "first_seen_at"}),
        ("mart_route_popularity", {"est_departure_airport", "est_arrival_airport", "first_seen_at"}),
        ("mart_traffic_patterns", {"airport_icao", "flight_type", "first_seen_at"}),
    ):
        plan = space.build(name)._jdf.queryExecution().executedPlan().toString()
        schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
        assert {c.split(":")[0] for c in schema.split(",")} == columns


def test_names_are_looked_up_after_the_grouping(spark):
    plan = plan_of(workspace(spark, SF).build("mart_airport_traffic"))
    assert plan.index("BroadcastHashJoin") < plan.index("HashAggregate")
    assert plan.count("Exchange hashpartitioning") == 1


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(registered()["vq_top_routes"](spark, SF))


def test_metric_groups_the_fact_before_joining(spark):
    with session_conf(spark, NO_BROADCAST):
        plan = plan_of(registered()["join_star"](spark, SF))
    fact_scan = plan.index("FileScan parquet [flight_id")
    below_joins = plan[plan.rindex("SortMergeJoin", 0, fact_scan) : fact_scan]
    assert "HashAggregate" in below_joins


def test_hot_key_is_split_by_the_join(spark):
    """A third of the events share one key; sort-merge join splits its partition."""
    events = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    names = spark.range(300_000).select(F.col("id").cast("string").alias("key"), "id")
    names = names.unionByName(spark.createDataFrame([("hot", -1)], "key string, id long"))
    settings = {
        **NO_BROADCAST,
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
    }
    with session_conf(spark, settings):
        joined = lookup(events, names, ("k", "key"), {"id": "name"})
        counted = joined.groupBy((F.col("name") == -1).alias("hot")).agg(F.count("payload").alias("n"))
        assert rows(counted) == [(False, 200_000), (True, 100_000)]
        assert "SortMergeJoin(skew=true)" in plan_of(counted)


def test_stored_dimension_lets_the_fact_join_split_hot_keys(spark):
    with session_conf(spark, NO_BROADCAST):
        plan = plan_of(workspace(spark, SF).build("fct_flights"))
    join = plan[plan.index("SortMergeJoin") :]
    sides = re.findall(r"[:+]- Sort \[[^\n]*\n[ :]*\+- Exchange hashpartitioning\((\w+)", join)
    assert sides[0] == "icao24" and "__lookup_key" in sides


def test_hot_group_of_copies_ships_one_row_per_task(spark):
    copies = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("load"),
    )
    kept = latest_per_key(copies, ["k"], "load")
    assert kept.count() == 60_001
    # As text, the highest id divisible by three is 9999.
    assert rows(kept.filter("k = -1"), "load") == [("9999",)]
    assert plan_of(kept).count("WindowGroupLimit") == 2


def test_tables_are_compared_in_the_tasks_asked_for(spark):
    """Rows meet by their values before they are counted: nothing is gathered below the shuffle."""
    columns = "k string, v double"
    one = spark.createDataFrame([("a", 1.0), ("a", 1.0), (None, None), ("b", 0.0), ("c", float("nan"))], columns)
    two = spark.createDataFrame([(None, None), ("a", 1.0), ("b", -0.0), ("c", float("nan")), ("d", None)], columns)
    found = _balance(one, two, tasks=7).select("row.k", "row.v", "n_after", "balance")
    assert rows(found.drop("v")) == sorted([("a", 2, 1), (None, 1, 0), ("b", 1, 0), ("c", 1, 0), ("d", 0, -1)], key=repr)
    plan = plan_of(_balance(one.select("k"), two.select("k"), tasks=7))
    assert plan.count("Exchange") == 1 and "hashpartitioning(row" in plan
    assert "HashAggregate" not in plan[plan.index("Exchange") :]
    assert _balance(one.select("k"), two.select("k"), tasks=7).rdd.getNumPartitions() == 7
