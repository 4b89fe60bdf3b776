"""One query per operator, over the fixture inputs derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom import files
from flightloom.fixtures.workspace import Workspace, workspace
from flightloom.functions import (
    ascending,
    blank_to_null,
    epoch_to_ntz,
    hour_of,
    joined_label,
    manufacturer_name,
    minutes_between,
    start_of,
    surrogate_key,
)
from flightloom.operators import dedup, history, lookup, merge, quality, reshape
from flightloom.plans import curated, dashboard, marts, metrics, pipeline, staging
from flightloom.plans.marts import flights
from flightloom.plans.models import MODEL, MODELS
from flightloom.plans.star import AIRCRAFT_HISTORY
from flightloom.schemas import (
    AIRPORTS_IN_SCOPE,
    CONTRACTS,
    FLIGHT_KEY,
    FLIGHT_TYPES,
    LANDED_FIELDS,
    LOAD_ID,
)
from flightloom.session import MIB, scratch_dir
from flightloom.sinks.snapshots import SnapshotTable
from flightloom.sources import landing, reference, tables
from flightloom.streaming.landing import follow_landing

Query = Callable[[SparkSession, str], DataFrame]

# Rounds of the fixture snapshot, and a moment between them.
FIRST_ROUND = datetime(1997, 1, 1)
SECOND_ROUND = datetime(1999, 1, 1)
BETWEEN_ROUNDS = datetime(1998, 1, 1)

# The load id that marks the re-loaded part of the raw flights.
RELOAD_FROM = "1700086400"
FRESHNESS_AS_OF = datetime(2023, 11, 17)
WINDOW_DAY = date(1998, 6, 15)
GAP_AIRPORT = AIRPORTS_IN_SCOPE[0]
# Line items, in bytes, whose flights one task writes to the scattered folder.
SCATTERED_BYTES = 4 * MIB
# Rows of two tables that one task compares.
ROWS_MET = 500_000

_REGISTERED: dict[str, Callable[[Workspace], DataFrame]] = {}


def registered() -> dict[str, Query]:
    return {name: _bind(fn) for name, fn in _REGISTERED.items()}


def _bind(fn: Callable[[Workspace], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(workspace(spark, sf_dir))

    return run


def query(fn: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    _REGISTERED[fn.__name__.rstrip("_")] = fn
    return fn


# --- sources -----------------------------------------------------------------------


@query
def src_flights_json(ws: Workspace) -> DataFrame:
    landed = landing.read_landed(ws.spark, ws.landing)
    return landing.snake_case(landed).select(*EVENT_COLUMNS)


EVENT_COLUMNS = (
    "icao24",
    "first_seen",
    "est_departure_airport",
    "last_seen",
    "est_arrival_airport",
    "callsign",
    "flight_type",
)


@query
def src_missing_slice(ws: Workspace) -> DataFrame:
    """Years, types and airports without a delivery, in a landing folder with known gaps.

    Departures of one airport were never delivered in odd years.
    """
    path = scratch_dir(ws.spark, "gaps")
    seen = ws.table("raw_flights").filter(F.col("first_seen").isNotNull())
    events = seen.select(
        F.col("icao24"),
        F.col("first_seen").alias("firstSeen"),
        F.trunc(epoch_to_ntz(F.col("first_seen")).cast("date"), "year").alias("day"),
        "flight_type",
        staging.indexed_airport().alias("airport"),
    )
    gap = (F.col("flight_type") == "departure") & (F.col("airport") == GAP_AIRPORT)
    delivered = lookup.within(events, F.col("airport"), AIRPORTS_IN_SCOPE).filter(
        ~(gap & (F.year("day") % 2 == 1))
    )
    gathered = delivered.hint("rebalance", F.col("day"), F.col("flight_type"), F.col("airport"))
    gathered.write.partitionBy("day", "flight_type", "airport").json(path)
    slices = landing.landed_slices(ws.spark, path)
    return landing.missing_slices(slices, slices.select("day").distinct(), AIRPORTS_IN_SCOPE)


@query
def src_day_window(ws: Workspace) -> DataFrame:
    rows = ws.table("raw_flights").select(*EVENT_COLUMNS, LOAD_ID)
    return rows.filter(landing.in_day_window(F.col("first_seen"), WINDOW_DAY))


@query
def src_airport_scope(ws: Workspace) -> DataFrame:
    indexed = ws.table("raw_flights").select(
        *FLIGHT_KEY, staging.indexed_airport().alias("airport_icao")
    )
    return lookup.within(indexed, F.col("airport_icao"), AIRPORTS_IN_SCOPE)


@query
def src_union_tagged(ws: Workspace) -> DataFrame:
    raw = ws.table("raw_flights").select(*EVENT_COLUMNS)
    slices = {k: raw.filter(F.col("flight_type") == k).drop("flight_type") for k in FLIGHT_TYPES}
    slices["arrival"] = slices["arrival"].drop("callsign")
    return landing.tagged_union(slices).select(*EVENT_COLUMNS)


@query
def src_snake_case(ws: Workspace) -> DataFrame:
    as_landed = ws.table("raw_flights").withColumnsRenamed({v: k for k, v in LANDED_FIELDS.items()})
    return landing.snake_case(as_landed).select(*EVENT_COLUMNS)


@query
def src_load_id(ws: Workspace) -> DataFrame:
    return landing.stamp_load(ws.table("raw_flights").select(*FLIGHT_KEY), "1700172800")


@query
def src_aircraft_csv(ws: Workspace) -> DataFrame:
    return reference.read_aircraft(ws.spark, ws.aircraft_file)


@query
def src_column_subset(ws: Workspace) -> DataFrame:
    return reference.upper_case_names(reference.keep_columns(ws.registered_aircraft()))


@query
def src_airports_seed(ws: Workspace) -> DataFrame:
    path = scratch_dir(ws.spark, "airports")
    ws.table("airports").write.option("header", "true").csv(path)
    departing = ws.table("raw_flights").groupBy("est_departure_airport").agg(
        flights().alias("raw_departures")
    )
    seed = reference.read_airports(ws.spark, path)
    return lookup.lookup(
        seed,
        departing,
        ("icao_code", "est_departure_airport"),
        {"raw_departures": "raw_departures"},
    )


@query
def src_table_scan(ws: Workspace) -> DataFrame:
    layers, _ = ws.pipeline_run
    stored = layers.table("raw", "flights")
    return stored.groupBy("flight_type").agg(flights().alias("n_rows"))


@query
def sql_adhoc(ws: Workspace) -> DataFrame:
    return tables.run_sql(
        ws.spark,
        "SELECT country, year(traffic_date) AS traffic_year, sum(arrivals) AS arrivals"
        " FROM {mart_airport_traffic} WHERE country IS NOT NULL GROUP BY ALL",
        {"mart_airport_traffic": ws.table("mart_airport_traffic")},
    ).withColumn("traffic_year", F.col("traffic_year").cast("bigint"))


@query
def src_backfill(ws: Workspace) -> DataFrame:
    """Past days loaded out of order, the older half twice."""
    layers = ws.new_layers("backfill")
    days = sorted(ws.landed_days())
    older, newer = days[: len(days) // 2], days[len(days) // 2 :]
    for part in (newer, older, older):
        pipeline.ingest(layers, ws.landing, part, "1700000000", grain="month")
    return layers.table("raw", "flights").select(*EVENT_COLUMNS, LOAD_ID)


# --- sinks -------------------------------------------------------------------------


@query
def merge_upsert(ws: Workspace) -> DataFrame:
    raw = ws.table("raw_flights")
    reloaded = F.col(LOAD_ID) >= RELOAD_FROM
    return merge.merge_rows(raw.filter(~reloaded), raw.filter(reloaded), FLIGHT_KEY, LOAD_ID)


@query
def merge_out_of_order(ws: Workspace) -> DataFrame:
    """Raw flights stored by load, the newer load first and the older one twice."""
    layers = ws.new_layers("order")
    raw = ws.table("raw_flights").select(*EVENT_COLUMNS, LOAD_ID)
    seen = F.trunc(epoch_to_ntz(F.col("first_seen")).cast("date"), "year")
    rows = raw.withColumn(pipeline.SEEN_ON, seen)
    newer = F.col(LOAD_ID) >= RELOAD_FROM
    for part in (rows.filter(newer), rows.filter(~newer), rows.filter(~newer)):
        pipeline.merge_flights(layers, part)
    return layers.table("raw", "flights").select(*EVENT_COLUMNS, LOAD_ID)


def _snapshots(ws: Workspace) -> tuple[SnapshotTable, int]:
    """Raw flights as snapshots by year seen, the older loads in two batches and the newer in two; and
    the number of the snapshot before the newer ones."""
    raw = ws.table("raw_flights").select(*EVENT_COLUMNS, LOAD_ID)
    rows = raw.withColumn(pipeline.SEEN_ON, F.trunc(epoch_to_ntz(F.col("first_seen")).cast("date"), "year"))
    table = SnapshotTable(ws.spark, scratch_dir(ws.spark, "snapshots"), FLIGHT_KEY, LOAD_ID, pipeline.SEEN_ON)
    newer, departed = F.col(LOAD_ID) >= RELOAD_FROM, F.col("flight_type") == "departure"
    older = [rows.filter(~newer & departed), rows.filter(~newer & ~departed)]
    numbers = [table.write(part, only_changes=False).number for part in older]
    for part in (rows.filter(newer & ~departed), rows.filter(newer & departed)):
        table.write(part)
    return table, numbers[-1]


@query
def merge_on_read(ws: Workspace) -> DataFrame:
    """Batches stored beside the rows they change, merged when they are read."""
    return _snapshots(ws)[0].read().select(*EVENT_COLUMNS, LOAD_ID)


@query
def merge_compacted(ws: Workspace) -> DataFrame:
    """The same after compaction, with older snapshots gone."""
    table, _ = _snapshots(ws)
    table.compact(most=0)
    table.expire(keep=1)
    return table.read().select(*EVENT_COLUMNS, LOAD_ID)


@query
def snapshot_as_of(ws: Workspace) -> DataFrame:
    """The table as it was before the newer loads, read after them."""
    table, number = _snapshots(ws)
    return table.read(number).select(*EVENT_COLUMNS, LOAD_ID)


@query
def sink_full_reload(ws: Workspace) -> DataFrame:
    layers = ws.new_layers("reload")
    layers.save_table("raw", "aircraft", ws.table("raw_aircraft"))
    layers.save_table("raw", "aircraft", ws.table("raw_aircraft_v2"))
    return layers.table("raw", "aircraft")


@query
def sink_row_count(ws: Workspace) -> DataFrame:
    layers = ws.new_layers("counts")
    names = ("raw_aircraft", "raw_flights", "fct_flights")
    counts = [(n, layers.save_table("raw", n, ws.table(n))) for n in names]
    return ws.spark.createDataFrame(counts, "table_name string, rows_written bigint")


@query
def sink_table(ws: Workspace) -> DataFrame:
    layers = ws.new_layers("tables")
    for _ in range(2):
        layers.save_table("marts", "mart_airport_traffic", ws.build("mart_airport_traffic"))
    return layers.table("marts", "mart_airport_traffic")


@query
def sink_view(ws: Workspace) -> DataFrame:
    return ws.new_layers("views").save_view("staging", "stg_aircraft", ws.build("stg_aircraft"))


@query
def sink_layers(ws: Workspace) -> DataFrame:
    """Rows of every stored table, with the schema it was routed to."""
    layers, _ = ws.pipeline_run
    routed = [("raw", "flights"), ("raw", "aircraft"), ("snapshots", "aircraft_snapshot")]
    routed += [(m.schema, m.name) for m in MODEL.values() if not m.view]
    counts = [
        layers.table(schema, model).agg(
            F.lit(schema).alias("schema_name"),
            F.lit(model).alias("model"),
            flights().alias("n_rows"),
        )
        for schema, model in routed
    ]
    return _stack(counts)


def _stack(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


# --- history -----------------------------------------------------------------------


def _aircraft_rounds(ws: Workspace) -> tuple[DataFrame, DataFrame]:
    first = history.first_versions(ws.table("stg_aircraft"), AIRCRAFT_HISTORY, FIRST_ROUND)
    return first, staging.stg_aircraft(ws.table("raw_aircraft_v2"))


@query
def scd2_snapshot(ws: Workspace) -> DataFrame:
    first, second = _aircraft_rounds(ws)
    return history.next_history(first, second, AIRCRAFT_HISTORY, SECOND_ROUND)


@query
def scd2_stored(ws: Workspace) -> DataFrame:
    """Two snapshot rounds, stored and read back."""
    layers = ws.new_layers("history")
    pipeline.advance_history(layers, ws.table("stg_aircraft"), FIRST_ROUND)
    pipeline.advance_history(layers, _aircraft_rounds(ws)[1], SECOND_ROUND)
    return pipeline.read_history(layers)


@query
def scd2_repeated_round(ws: Workspace) -> DataFrame:
    """Both rounds run twice, each first with a file that is corrected then."""
    layers = ws.new_layers("repeated")
    _, second = _aircraft_rounds(ws)
    wrong = F.when(F.crc32("icao24") % 3 == 0, "ZZZ").otherwise(F.col("operator_icao"))
    for rows, at in ((ws.table("stg_aircraft"), FIRST_ROUND), (second, SECOND_ROUND)):
        pipeline.advance_history(layers, rows.withColumn("operator_icao", wrong), at)
        pipeline.advance_history(layers, rows, at)
    return pipeline.read_history(layers)


@query
def scd2_unchanged(ws: Workspace) -> DataFrame:
    """Open versions from the first round whose aircraft reports another model by now."""
    _, second = _aircraft_rounds(ws)
    kept = history.open_versions(scd2_snapshot(ws)).filter(
        F.col(history.VALID_FROM) < F.lit(str(SECOND_ROUND)).cast("timestamp_ntz")
    )
    now = lookup.lookup(kept, second, ("icao24", "icao24"), {"model": "reported_model"})
    return now.filter(F.col("reported_model") != F.col("model"))


@query
def scd2_vanished(ws: Workspace) -> DataFrame:
    """Open versions whose aircraft is gone from the source."""
    _, second = _aircraft_rounds(ws)
    return history.open_versions(scd2_snapshot(ws)).join(second, "icao24", "left_anti")


@query
def scd2_as_of(ws: Workspace) -> DataFrame:
    return history.as_of(scd2_snapshot(ws), BETWEEN_ROUNDS)


@query
def join_point_in_time(ws: Workspace) -> DataFrame:
    events = ws.table("fct_flights").select("flight_id", "icao24", "first_seen_at")
    return history.attribute_at_event(
        events, scd2_snapshot(ws), "icao24", "first_seen_at", ["operator", "operator_icao"]
    )


@query
def join_point_in_time_ordered(ws: Workspace) -> DataFrame:
    """The same in ordered passes, which keys with many versions ask for."""
    events = ws.table("fct_flights").select("flight_id", "icao24", "first_seen_at")
    return history.attribute_in_order(
        events, scd2_snapshot(ws), "icao24", "first_seen_at", ["operator", "operator_icao"]
    )


@query
def scd2_as_of_stored(ws: Workspace) -> DataFrame:
    """Versions valid between two stored rounds."""
    layers = ws.new_layers("as_of")
    pipeline.advance_history(layers, ws.table("stg_aircraft"), FIRST_ROUND)
    pipeline.advance_history(layers, _aircraft_rounds(ws)[1], SECOND_ROUND)
    return pipeline.history_as_of(layers, BETWEEN_ROUNDS)


# --- projections and predicates ----------------------------------------------------


@query
def project_rename(ws: Workspace) -> DataFrame:
    return ws.table("stg_aircraft").select(
        "icao24", F.col("operator").alias("airline_name"), F.col("typecode").alias("aircraft_type")
    )


@query
def manufacturer_normalize(ws: Workspace) -> DataFrame:
    raw = F.col("manufacturername")
    return (
        ws.table("raw_aircraft")
        .groupBy(raw, manufacturer_name(raw).alias("manufacturer"))
        .agg(flights().alias("n_rows"))
    )


@query
def resolve_airport(ws: Workspace) -> DataFrame:
    return (
        ws.table("raw_flights")
        .groupBy("flight_type", staging.indexed_airport().alias("airport_icao"))
        .agg(flights().alias("n_rows"))
    )


@query
def filter_not_null(ws: Workspace) -> DataFrame:
    return (
        ws.table("raw_flights")
        .filter(F.col("first_seen").isNotNull())
        .select(*FLIGHT_KEY, LOAD_ID)
    )


@query
def filter_conjunction(ws: Workspace) -> DataFrame:
    usable = (
        F.col("operator_icao").isNotNull()
        & F.col("est_departure_airport").isNotNull()
        & F.col("est_arrival_airport").isNotNull()
        & (F.col("flight_duration_minutes") > 0)
    )
    columns = ["flight_id", "operator_icao", "est_departure_airport", "est_arrival_airport"]
    return ws.table("fct_flights").filter(usable).select(*columns, "flight_duration_minutes")


@query
def filter_equality(ws: Workspace) -> DataFrame:
    return ws.table("mart_airport_traffic").filter(F.col("airport_iata") == "LHR")


@query
def filter_threshold(ws: Workspace) -> DataFrame:
    per_aircraft = (
        ws.table("fct_flights").groupBy("icao24").agg(flights().alias("total_flights"))
    )
    return per_aircraft.filter(F.col("total_flights") > 30)


@query
def filter_isin(ws: Workspace) -> DataFrame:
    """The same frame under a selection and, as ``all``, under none."""
    hours = dashboard.airport_hours(ws.table("mart_traffic_patterns"))
    chosen = reshape.keep_selected(hours, "airport_iata", ["CDG", "AMS"])
    everything = reshape.keep_selected(hours, "airport_iata", [])
    return chosen.withColumn("selection", F.lit("two")).unionByName(
        everything.withColumn("selection", F.lit("all"))
    )


@query
def topk_then_filter(ws: Workspace) -> DataFrame:
    ranked = reshape.top_k(
        ws.table("mart_route_popularity"), "flight_count", 20, ["departure_icao", "arrival_icao"]
    )
    return ranked.filter(reshape.both_present("departure_iata", "arrival_iata"))


# --- joins -------------------------------------------------------------------------


@query
def join_flight_aircraft(ws: Workspace) -> DataFrame:
    staged = ws.table("stg_flights").select("flight_id", "icao24")
    return lookup.lookup(
        staged,
        ws.table("stg_aircraft"),
        ("icao24", "icao24"),
        {"operator_icao": "operator_icao", "manufacturer": "manufacturer"},
    )


@query
def join_airport_lookup(ws: Workspace) -> DataFrame:
    per_airport = (
        ws.table("fct_flights").groupBy("airport_icao").agg(flights().alias("n_rows"))
    )
    return lookup.lookup(
        per_airport,
        ws.table("dim_airports"),
        ("airport_icao", "icao_code"),
        {"iata_code": "airport_iata", "city": "city"},
    )


@query
def join_role_playing(ws: Workspace) -> DataFrame:
    pairs = (
        ws.table("fct_flights")
        .groupBy("est_departure_airport", "est_arrival_airport")
        .agg(flights().alias("n_rows"))
    )
    airports = ws.table("dim_airports")
    for role in ("departure", "arrival"):
        pairs = lookup.lookup(
            pairs, airports, (f"est_{role}_airport", "icao_code"), {"city": f"{role}_city"}
        )
    return pairs


@query
def join_airline_lookup(ws: Workspace) -> DataFrame:
    per_operator = (
        ws.table("fct_flights")
        .groupBy(F.col("operator_icao").alias("flown_by"))
        .agg(flights().alias("n_rows"))
    )
    return lookup.lookup(
        per_operator,
        ws.table("dim_airlines"),
        ("flown_by", "operator_icao"),
        {"airline_id": "airline_id", "operator_icao": "operator_icao"},
    )


@query
def join_star(ws: Workspace) -> DataFrame:
    return metrics.metric_query(
        ws.tables,
        "fct_flights",
        ["flight_count", "total_flight_duration_minutes"],
        by=["flight_type", "dim_airports.city", "dim_airlines.airline_name"],
    )


# --- aggregations ------------------------------------------------------------------


@query
def agg_count_star(ws: Workspace) -> DataFrame:
    return ws.table("fct_flights").groupBy("manufacturer").agg(flights().alias("n_rows"))


@query
def agg_count_col(ws: Workspace) -> DataFrame:
    return (
        ws.table("fct_flights")
        .groupBy("flight_type")
        .agg(
            F.count("flight_id").alias("with_id"),
            F.count("airport_icao").alias("with_airport"),
            F.count("operator_icao").alias("with_operator"),
        )
    )


@query
def agg_count_if(ws: Workspace) -> DataFrame:
    return (
        ws.table("fct_flights")
        .groupBy("airport_icao")
        .agg(
            marts.events_of("arrival").alias("arrivals"),
            marts.events_of("departure").alias("departures"),
        )
    )


@query
def agg_avg(ws: Workspace) -> DataFrame:
    return (
        ws.table("fct_flights")
        .groupBy("operator_icao")
        .agg(F.avg("flight_duration_minutes").alias("avg_minutes"))
    )


@query
def agg_min_max(ws: Workspace) -> DataFrame:
    return (
        ws.table("fct_flights")
        .groupBy("typecode")
        .agg(
            F.min("flight_duration_minutes").alias("shortest"),
            F.max("flight_duration_minutes").alias("longest"),
        )
    )


@query
def agg_min_max_expr(ws: Workspace) -> DataFrame:
    day = start_of("day", F.col("first_seen_at"))
    return (
        ws.table("fct_flights")
        .groupBy("icao24")
        .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    )


@query
def agg_sum(ws: Workspace) -> DataFrame:
    return (
        ws.table("fct_flights")
        .groupBy("airport_icao", "flight_type")
        .agg(F.sum("flight_duration_minutes").alias("minutes"))
    )


@query
def agg_count_distinct(ws: Workspace) -> DataFrame:
    day = start_of("day", F.col("first_seen_at"))
    return (
        ws.table("fct_flights")
        .groupBy("operator_icao")
        .agg(F.countDistinct(day).alias("active_days"))
    )


@query
def group_by_keys(ws: Workspace) -> DataFrame:
    keys = ["operator_icao", "est_departure_airport", "est_arrival_airport"]
    return ws.table("fct_flights").groupBy(*keys).agg(flights().alias("n_rows"))


@query
def group_by_time_bucket(ws: Workspace) -> DataFrame:
    seen = F.col("first_seen_at")
    return (
        ws.table("fct_flights")
        .groupBy(
            start_of("day", seen).alias("seen_day"),
            start_of("week", seen).alias("seen_week"),
            hour_of(seen).alias("seen_hour"),
        )
        .agg(flights().alias("n_rows"))
    )


@query
def agg_rollup_mart(ws: Workspace) -> DataFrame:
    return (
        ws.table("mart_airport_traffic")
        .groupBy("traffic_week", "country")
        .agg(F.sum("total_flights").alias("total_flights"))
    )


@query
def agg_global(ws: Workspace) -> DataFrame:
    return ws.table("mart_airport_traffic").agg(
        F.avg("total_flights").alias("avg_flights"), flights().alias("n_rows")
    )


@query
def agg_ratio(ws: Workspace) -> DataFrame:
    per_day = (
        ws.table("mart_airport_traffic")
        .groupBy("traffic_date")
        .agg(F.sum("arrivals").alias("arrivals"), F.sum("departures").alias("departures"))
    )
    ratio = F.col("arrivals") / F.nullif(F.col("departures"), F.lit(0))
    return per_day.select("traffic_date", F.round(ratio, 2).alias("ratio"))


@query
def agg_kpi_totals(ws: Workspace) -> DataFrame:
    return dashboard.traffic_totals(dashboard.airport_traffic(ws.table("mart_airport_traffic")))


@query
def agg_hourly_totals(ws: Workspace) -> DataFrame:
    hours = dashboard.airport_hours(ws.table("mart_traffic_patterns"))
    return dashboard.with_headings(dashboard.hourly_totals(hours), dashboard.HOUR_HEADINGS)


@query
def distinct_sorted(ws: Workspace) -> DataFrame:
    return reshape.distinct_values(ws.table("mart_traffic_patterns"), "airport_iata")


# --- reshaping ---------------------------------------------------------------------


@query
def unpivot_melt(ws: Workspace) -> DataFrame:
    traffic = dashboard.airport_traffic(ws.table("mart_airport_traffic"))
    return dashboard.arrivals_and_departures(traffic)


@query
def pivot_hours(ws: Workspace) -> DataFrame:
    return dashboard.hour_heatmap(dashboard.airport_hours(ws.table("mart_traffic_patterns")))


@query
def rename_columns(ws: Workspace) -> DataFrame:
    routes = dashboard.top_routes(ws.table("mart_route_popularity"))
    return dashboard.with_headings(routes, dashboard.ROUTE_HEADINGS)


# --- windows, sorts, limits --------------------------------------------------------


@query
def dedup_latest(ws: Workspace) -> DataFrame:
    loads = ws.table("raw_flights").select(*FLIGHT_KEY, "last_seen", LOAD_ID)
    return dedup.latest_per_key(loads, FLIGHT_KEY, LOAD_ID)


@query
def dedup_key(ws: Workspace) -> DataFrame:
    aircraft = ws.table("raw_aircraft").select("icao24", "model", "typecode")
    return dedup.any_per_key(aircraft, ["icao24"])


@query
def first_per_group(ws: Workspace) -> DataFrame:
    operated = ws.table("stg_aircraft").select("operator_icao", "icao24", "operator")
    return dedup.first_per_key(operated, ["operator_icao"], ascending("icao24"))


@query
def sort_desc(ws: Workspace) -> DataFrame:
    return marts.in_report_order("mart_route_popularity", ws.table("mart_route_popularity"))


@query
def sort_multi_key(ws: Workspace) -> DataFrame:
    return marts.in_report_order("mart_on_time_performance", ws.table("mart_on_time_performance"))


@query
def top_k(ws: Workspace) -> DataFrame:
    return reshape.top_k(
        ws.table("mart_on_time_performance"),
        "flight_count",
        30,
        ["operator_icao", "departure_icao", "arrival_icao"],
    )


@query
def head_k(ws: Workspace) -> DataFrame:
    return dashboard.leading(dashboard.airlines(ws.table("mart_airline_reliability")))


# --- scalar functions --------------------------------------------------------------


@query
def fn_trim(ws: Workspace) -> DataFrame:
    return (
        ws.table("raw_flights")
        .groupBy("callsign", F.trim("callsign").alias("trimmed"))
        .agg(flights().alias("n_rows"))
    )


@query
def fn_blank_to_null(ws: Workspace) -> DataFrame:
    columns = ("operator", "operatorcallsign", "operatoricao", "operatoriata")
    return ws.table("raw_aircraft").select(
        "icao24", *[blank_to_null(F.col(c)).alias(c) for c in columns]
    )


@query
def fn_ilike(ws: Workspace) -> DataFrame:
    return (
        ws.table("raw_aircraft")
        .filter(F.col("manufacturername").ilike("%b%R%"))
        .groupBy("manufacturername")
        .agg(flights().alias("n_rows"))
    )


@query
def fn_cast(ws: Workspace) -> DataFrame:
    return (
        ws.table("raw_flights")
        .groupBy(F.col(LOAD_ID).cast("bigint").alias("load_seconds"))
        .agg(flights().alias("n_rows"))
    )


@query
def fn_epoch_to_ts(ws: Workspace) -> DataFrame:
    return ws.table("raw_flights").select(
        "first_seen",
        "last_seen",
        epoch_to_ntz(F.col("first_seen")).alias("first_seen_at"),
        epoch_to_ntz(F.col("last_seen")).alias("last_seen_at"),
    )


@query
def fn_minutes_between(ws: Workspace) -> DataFrame:
    start, end = F.col("first_seen_at"), F.col("last_seen_at")
    return ws.table("stg_flights").select("flight_id", minutes_between(start, end).alias("minutes"))


@query
def fn_to_date(ws: Workspace) -> DataFrame:
    return _per_value(ws, F.col("first_seen_at").cast("date"), "seen_on")


@query
def fn_trunc_day(ws: Workspace) -> DataFrame:
    return _per_value(ws, start_of("day", F.col("first_seen_at")), "day_start")


@query
def fn_trunc_week(ws: Workspace) -> DataFrame:
    return _per_value(ws, start_of("week", F.col("first_seen_at")), "week_start")


@query
def fn_hour(ws: Workspace) -> DataFrame:
    return _per_value(ws, hour_of(F.col("first_seen_at")), "hour_of_day")


def _per_value(ws: Workspace, value: Column, name: str) -> DataFrame:
    fact = ws.table("fct_flights")
    return fact.groupBy(value.alias(name)).agg(flights().alias("n_rows"))


@query
def fn_round(ws: Workspace) -> DataFrame:
    return (
        ws.table("fct_flights")
        .groupBy("icao24")
        .agg(
            F.round(F.avg("flight_duration_minutes"), 1).alias("rounded_to_1"),
            F.round(F.avg("flight_duration_minutes"), 2).alias("rounded_to_2"),
        )
    )


@query
def surrogate_key_(ws: Workspace) -> DataFrame:
    """Keys over columns that are partly null."""
    columns = ("icao24", "first_seen", "est_departure_airport", "est_arrival_airport")
    return ws.table("raw_flights").select(*columns, surrogate_key(*columns).alias("row_key"))


@query
def fn_concat_route(ws: Workspace) -> DataFrame:
    routes = ws.table("mart_route_popularity")
    label = joined_label(F.col("departure_iata"), F.col("arrival_iata"))
    return routes.select("departure_icao", "arrival_icao", label.alias("route"))


# --- data quality ------------------------------------------------------------------


@query
def dq_unique(ws: Workspace) -> DataFrame:
    return quality.repeated_values(ws.table("raw_aircraft"), "icao24")


@query
def dq_not_null(ws: Workspace) -> DataFrame:
    return quality.null_rows(ws.table("fct_flights"), "airport_icao").select(
        "flight_id", "flight_type"
    )


@query
def dq_accepted_values(ws: Workspace) -> DataFrame:
    return quality.unaccepted_values(
        ws.table("fct_flights"), "est_departure_airport", AIRPORTS_IN_SCOPE
    )


@query
def dq_freshness(ws: Workspace) -> DataFrame:
    return quality.freshness(ws.table("raw_flights"), LOAD_ID, FRESHNESS_AS_OF)


@query
def dq_contract(ws: Workspace) -> DataFrame:
    """Rows of each contracted table that passed, with the number of declared columns."""
    passed = []
    for name, contract in CONTRACTS.items():
        enforced = quality.enforce_contract(ws.table(name), contract, name)
        passed.append(
            enforced.agg(
                F.lit(name).alias("model"),
                F.lit(len(contract)).cast("bigint").alias("n_columns"),
                flights().alias("n_rows"),
            )
        )
    return _stack(passed)


@query
def dq_results(ws: Workspace) -> DataFrame:
    layers, _ = ws.pipeline_run
    return layers.table("quality", "results").drop("run_at")


# --- models ------------------------------------------------------------------------


def _register_models() -> None:
    for name in MODEL:
        _REGISTERED[name] = lambda ws, name=name: ws.build(name)
    # The airport dimension is a fixed list, so it is run with the traffic it describes.
    _REGISTERED["dim_airports"] = dim_airports


def dim_airports(ws: Workspace) -> DataFrame:
    traffic = ws.table("fct_flights").groupBy("airport_icao").agg(flights().alias("n_flights"))
    return lookup.lookup(
        ws.build("dim_airports"),
        traffic,
        ("icao_code", "airport_icao"),
        {"n_flights": "n_flights"},
    )


_register_models()


# --- served queries ----------------------------------------------------------------


@query
def vq_busiest_airports(ws: Workspace) -> DataFrame:
    return curated.answer("busiest_airports", ws.tables)


@query
def vq_top_routes(ws: Workspace) -> DataFrame:
    return curated.answer("top_routes", ws.tables)


@query
def vq_most_active_airlines(ws: Workspace) -> DataFrame:
    return curated.answer("most_active_airlines", ws.tables)


@query
def vq_daily_traffic_heathrow(ws: Workspace) -> DataFrame:
    return curated.answer("daily_traffic_heathrow", ws.tables)


@query
def vq_arrivals_vs_departures(ws: Workspace) -> DataFrame:
    return curated.answer("arrivals_vs_departures_by_airport", ws.tables)


@query
def vq_weekly_traffic_trend(ws: Workspace) -> DataFrame:
    return curated.answer("weekly_traffic_trend", ws.tables)


@query
def vq_routes_from_paris(ws: Workspace) -> DataFrame:
    return curated.answer("routes_from_paris", ws.tables)


@query
def vq_airline_avg_duration(ws: Workspace) -> DataFrame:
    return curated.answer("airline_avg_duration", ws.tables)


@query
def dash_airport_traffic(ws: Workspace) -> DataFrame:
    return dashboard.airport_traffic(ws.table("mart_airport_traffic"))


@query
def dash_top_routes(ws: Workspace) -> DataFrame:
    return dashboard.top_routes(ws.table("mart_route_popularity"))


@query
def dash_airlines(ws: Workspace) -> DataFrame:
    return dashboard.airlines(ws.table("mart_airline_reliability"))


@query
def dash_airport_hour(ws: Workspace) -> DataFrame:
    return dashboard.airport_hours(ws.table("mart_traffic_patterns"))


# --- metric layer ------------------------------------------------------------------


@query
def sem_registry(ws: Workspace) -> DataFrame:
    """Rows and distinct primary keys of every logical table."""
    profiles = []
    for name, logical in metrics.REGISTRY.items():
        keys = ws.table(name).groupBy(*logical.primary_key).agg(flights().alias("copies"))
        profiles.append(
            keys.agg(
                F.lit(name).alias("logical_table"),
                F.sum("copies").alias("n_rows"),
                flights().alias("n_keys"),
            )
        )
    return _stack(profiles)


@query
def sem_by_dimension(ws: Workspace) -> DataFrame:
    return metrics.metric_query(
        ws.tables,
        "fct_flights",
        ["flight_count", "avg_flight_duration_minutes"],
        by=["dim_airports.country", "manufacturer"],
        where="flight_type = 'departure'",
    )


@query
def sem_filter_by_dimension(ws: Workspace) -> DataFrame:
    """Flights and durations by airline at airports of two countries, over all of them."""
    return metrics.metric_query(
        ws.tables,
        "fct_flights",
        ["flight_count", "avg_flight_duration_minutes"],
        by=["operator_icao"],
        where_dimension={"dim_airports": "country IN ('France', 'Spain')"},
    )


@query
def sem_routed(ws: Workspace) -> DataFrame:
    """Monthly departures by country, asked of the fact and answered by a smaller table."""
    return metrics.routed_query(
        ws.tables,
        "fct_flights",
        ["flight_count"],
        by=["dim_airports.country", "first_seen_at"],
        where="flight_type = 'departure'",
        grain="month",
    )


@query
def sem_by_time_grain(ws: Workspace) -> DataFrame:
    """Monthly volume per airport."""
    return metrics.metric_query(
        ws.tables,
        "mart_airport_traffic",
        ["total_flights", "total_arrivals"],
        by=["airport_name", "traffic_date"],
        grain="month",
        order=[("traffic_date", "asc")],
    )


@query
def sem_flight_measures(ws: Workspace) -> DataFrame:
    return metrics.metric_query(
        ws.tables,
        "fct_flights",
        ["flight_count", "avg_flight_duration_minutes", "total_flight_duration_minutes"],
        by=["operator_icao"],
    )


@query
def sem_airport_measures(ws: Workspace) -> DataFrame:
    return metrics.metric_query(
        ws.tables,
        "mart_airport_traffic",
        ["total_flights", "total_arrivals", "total_departures"],
        by=["country", "city"],
    )


@query
def sem_airline_measures(ws: Workspace) -> DataFrame:
    names = [
        "total_flights",
        "total_arrivals",
        "total_departures",
        "avg_flight_duration_minutes",
        "active_days",
    ]
    result = metrics.metric_query(ws.tables, "mart_airline_reliability", names, by=["operator_iata"])
    average = "avg_flight_duration_minutes"
    return result.withColumn(average, F.round(average, 6))


@query
def sem_route_measures(ws: Workspace) -> DataFrame:
    return metrics.metric_query(
        ws.tables,
        "mart_route_popularity",
        ["flight_count"],
        by=["departure_country", "arrival_country"],
        order=[("flight_count", "desc")],
        limit=25,
    )


@query
def sem_default_agg(ws: Workspace) -> DataFrame:
    """A bare-column measure, by its default, beside one that declares its aggregate."""
    bare = metrics.metric_query(ws.tables, "mart_route_popularity", ["flight_count"])
    declared = metrics.metric_query(
        ws.tables,
        "fct_flights",
        ["flight_count"],
        where="est_departure_airport IS NOT NULL AND est_arrival_airport IS NOT NULL",
    )
    return bare.withColumn("kind", F.lit("default")).unionByName(
        declared.withColumn("kind", F.lit("declared"))
    )


# --- the daily job -----------------------------------------------------------------


@query
def pipeline_build(ws: Workspace) -> DataFrame:
    """Rows of each table after loading and building everything."""
    layers, report = ws.pipeline_run
    counts = [
        layers.table(MODEL[name].schema, name).agg(
            F.lit(name).alias("model"), flights().alias("n_rows")
        )
        for name in report.rows
    ]
    return _stack(counts)


@query
def stream_landing(ws: Workspace) -> DataFrame:
    """Raw flights after following the landing folder, in several micro-batches."""
    layers = ws.new_layers("stream")
    follow_landing(
        layers,
        ws.landing,
        scratch_dir(ws.spark, "stream-checkpoint"),
        "1700000000",
        grain="month",
        files_per_batch=60,
    )
    return layers.table("raw", "flights").select(*EVENT_COLUMNS, LOAD_ID)


@query
def stream_any_batch_size(ws: Workspace) -> DataFrame:
    """Raw flights after following a folder in batches of a sixth, with copies of a key far apart.

    A small folder has six files, which are followed one by one.
    """
    path = scratch_dir(ws.spark, "scattered")
    delivered = ws.table("raw_flights").drop(LOAD_ID).withColumn("day", F.lit(FIRST_ROUND.date()))
    delivered = delivered.withColumnsRenamed({v: k for k, v in LANDED_FIELDS.items()})
    # Rows are dealt by their content, so those of one key lie in different files.
    tasks = max(3, -(-files.size(ws.spark, f"{ws.sf_dir}/lineitem.parquet") // SCATTERED_BYTES))
    scattered = delivered.repartition(tasks, F.xxhash64(*delivered.columns))
    scattered.write.partitionBy("day", "flight_type").json(path, compression="gzip")
    layers = ws.new_layers("by_file")
    follow_landing(
        layers,
        path,
        scratch_dir(ws.spark, "by-file-checkpoint"),
        "1700000000",
        grain="year",
        files_per_batch=-(-tasks // 3),
    )
    return layers.table("raw", "flights").select(*EVENT_COLUMNS, LOAD_ID)


@query
def pipeline_idempotent(ws: Workspace) -> DataFrame:
    """Rows of the raw flights after one load of all days and after a second one."""
    layers = ws.new_layers("rerun")
    days = ws.landed_days()
    copy = scratch_dir(ws.spark, "first-load")
    pipeline.ingest(layers, ws.landing, days, "1700000000", grain="month")
    layers.table("raw", "flights").write.parquet(copy)
    pipeline.ingest(layers, ws.landing, days, "1700000000", grain="month")
    before, after = ws.spark.read.parquet(copy), layers.table("raw", "flights")
    after = after.select(*before.columns)
    sides = before.withColumn("before", F.lit(1)).unionByName(after.withColumn("before", F.lit(0)))
    per_row = sides.groupBy(*before.columns).agg(
        F.sum("before").alias("n_before"), (flights() - F.sum("before")).alias("n_after")
    )
    return per_row.agg(
        F.sum("n_before").alias("rows_first"),
        F.sum("n_after").alias("rows_second"),
        F.sum(F.abs(F.col("n_before") - F.col("n_after"))).alias("rows_differing"),
    )


@query
def pipeline_incremental(ws: Workspace) -> DataFrame:
    """Rows that the models have after day-wise updates, against one build of everything.

    The first months are built, then later ones and a part of the first again are loaded and
    only what they touch is updated.
    """
    days = sorted(ws.landed_days())
    layers, whole = ws.new_layers("incremental"), ws.new_layers("at_once")
    aircraft_file, airports, run_at = ws.aircraft_file, ws.table("airports"), datetime(1999, 1, 1)
    settings = {"on_failure": "record", "partitioned": False}

    def build_whole() -> pipeline.Report:
        pipeline.reload_aircraft(whole, aircraft_file)
        pipeline.ingest(whole, ws.landing, days, "1700000000", grain="month")
        return pipeline.build(whole, airports, run_at, **settings)

    pipeline.reload_aircraft(layers, aircraft_file)
    pipeline.ingest(layers, ws.landing, days[:-2], "1700000000", grain="month")
    pipeline.build(layers, airports, run_at, **settings)
    # An update is many short steps, which leave cores to the other build; the two share only their input.
    with ThreadPoolExecutor(1) as pool:
        built = pool.submit(build_whole)
        touched = pipeline.ingest(layers, ws.landing, [*days[:3], *days[-2:]], "1700000000", grain="month")
        report = pipeline.update(layers, airports, run_at, touched, grain="month", **settings)
        rows = built.result().rows
    compared = []
    for model in MODELS:
        sides = [space.table(model.schema, model.name) for space in (layers, whole)]
        compared.append(
            _balance(*sides, tasks=1 + 2 * rows[model.name] // ROWS_MET).agg(
                F.lit(model.name).alias("model"),
                F.sum("n_after").alias("n_rows"),
                F.sum(F.abs("balance")).alias("rows_differing"),
                F.lit(model.name in report.skipped).alias("skipped"),
            )
        )
    return _stack(compared)


def _balance(after: DataFrame, want: DataFrame, tasks: int) -> DataFrame:
    """Each different row of two tables: ``n_after``, how often the first has it, and ``balance``,
    how much more often than the second.

    A row is there about once a table, so counting before the shuffle would combine nothing. Rows
    are dealt to as many tasks as are asked for, whatever the session has, and counted there.
    """
    sides = after.withColumn("side", F.lit(1)).unionByName(want.withColumn("side", F.lit(-1)))
    rows = sides.select("side", F.struct(*want.columns).alias("row")).repartition(tasks, "row")
    return rows.groupBy("row").agg(
        F.sum("side").alias("balance"), F.count_if(F.col("side") == 1).alias("n_after")
    )


@query
def pipeline_resumed(ws: Workspace) -> DataFrame:
    """A table over all days after a run that ended between load and update.

    Later months are loaded and nothing is built on them; the next run loads the last ones
    and a part of the first again, and its update finds all that is open in the ledger.
    """
    layers, days = ws.new_layers("resumed"), sorted(ws.landed_days())
    pipeline.reload_aircraft(layers, ws.aircraft_file)
    airports, run_at = ws.table("airports"), datetime(1999, 1, 1)
    settings = {"on_failure": "record", "partitioned": False}
    pipeline.ingest(layers, ws.landing, days[:-4], "1700000000", grain="month")
    pipeline.build(layers, airports, run_at, **settings)
    pipeline.ingest(layers, ws.landing, days[-4:-2], "1700000000", grain="month")
    pipeline.ingest(layers, ws.landing, [*days[:3], *days[-2:]], "1700000000", grain="month")
    pipeline.update(layers, airports, run_at, grain="month", **settings)
    return layers.table("marts", "mart_airline_reliability")


@query
def fact_changed_aircraft(ws: Workspace) -> DataFrame:
    """The fact after another aircraft file: only days on which changed aircraft flew are written."""
    layers = ws.new_layers("changed")
    airports, run_at = ws.table("airports"), datetime(1999, 1, 1)
    settings = {"on_failure": "record", "partitioned": False}
    pipeline.ingest(layers, ws.landing, ws.landed_days(), "1700000000", grain="month")
    layers.save_table("raw", "aircraft", ws.table("raw_aircraft"))
    pipeline.build(layers, airports, run_at, **settings)
    layers.save_table("raw", "aircraft", ws.table("raw_aircraft_v2"))
    pipeline.update(layers, airports, datetime(1999, 1, 2), grain="month", **settings)
    return layers.table("marts", "fct_flights")


@query
def agg_distinct_merged(ws: Workspace) -> DataFrame:
    """Active days of each airline, from bitmaps kept apart for arrivals and departures."""
    fact = ws.table("fct_flights")
    halves = [
        marts.AIRLINES.by_month(marts.AIRLINES.by_day(fact.filter(F.col("flight_type") == kind)))
        for kind in FLIGHT_TYPES
    ]
    merged = marts.AIRLINES.total(marts.AIRLINES.united(halves[0].unionByName(halves[1])))
    return merged.select("operator_icao", "active_days")
