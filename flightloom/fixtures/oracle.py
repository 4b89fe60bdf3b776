"""DuckDB statements that state, independently, what each fixture query must return.

The models are stated join-first and with DuckDB's own forms (``DISTINCT ON``,
``arg_min``, ``FILTER``), so that they do not repeat the way the Spark side works.
"""

from __future__ import annotations

from flightloom.fixtures import views
from flightloom.schemas import AIRPORTS_IN_SCOPE, CONTRACTS

EPOCH = "cast(epoch(l_shipdate) as bigint)"

# Part of a manufacturer's name, and the name it gets, by precedence.
_MANUFACTURERS = ", ".join(
    f"({i}, '{pattern}', '{name}')"
    for i, (pattern, name) in enumerate(
        (
            ("airbus", "Airbus"),
            ("boeing", "Boeing"),
            ("embraer", "Embraer"),
            ("bombardier", "Bombardier"),
            ("dassault", "Dassault"),
            ("gulfstream", "Gulfstream"),
            ("boing", "Boeing"),
            ("empresa brasileira", "Embraer"),
        )
    )
)


def _key(*columns: str) -> str:
    parts = [f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


def _rounded(value: str, places: int) -> str:
    """Half away from zero on the decimal value, which DuckDB does for decimals only.

    On doubles it scales first: 1.025 becomes 102.49999999999999 and rounds to 1.02.
    """
    return f"CAST(round(CAST({value} AS decimal(30, 12)), {places}) AS double)"


def _staged_aircraft(raw: str) -> str:
    return f"""
SELECT DISTINCT ON (icao24) * FROM (
  SELECT icao24,
    coalesce((SELECT p.name FROM (VALUES {_MANUFACTURERS}) p(rank, part, name)
              WHERE contains(lower(manufacturername), p.part) ORDER BY p.rank LIMIT 1),
             manufacturername) AS manufacturer,
    model, typecode,
    CASE WHEN trim(operator) <> '' THEN trim(operator) END AS operator,
    CASE WHEN trim(operatorcallsign) <> '' THEN trim(operatorcallsign) END AS operator_callsign,
    CASE WHEN trim(operatoricao) <> '' THEN trim(operatoricao) END AS operator_icao,
    CASE WHEN trim(operatoriata) <> '' THEN trim(operatoriata) END AS operator_iata
  FROM {raw} WHERE icao24 IS NOT NULL)
ORDER BY icao24, manufacturer NULLS LAST, model NULLS LAST, typecode NULLS LAST,
  operator NULLS LAST, operator_callsign NULLS LAST, operator_icao NULLS LAST,
  operator_iata NULLS LAST"""


def _inputs() -> dict[str, str]:
    return {
        "airports": views.AIRPORTS,
        "raw_flights": views.RAW_FLIGHTS.replace("{EPOCH}", EPOCH),
        "aircraft_all": views.AIRCRAFT_ALL,
        "raw_aircraft": views.RAW_AIRCRAFT,
        "raw_aircraft_v2": views.RAW_AIRCRAFT_V2,
        # What the landed files hold once loaded: one row per key, one load id.
        "landed_once": """
SELECT DISTINCT ON (icao24, first_seen, flight_type) * REPLACE ('1700000000' AS _dlt_load_id)
FROM raw_flights
ORDER BY icao24, first_seen, flight_type, est_departure_airport DESC NULLS FIRST,
  last_seen DESC NULLS FIRST, est_arrival_airport DESC NULLS FIRST, callsign DESC NULLS FIRST""",
        "aircraft_file": """
SELECT icao24, 'R-' || p_partkey AS registration, nullif(manufacturername, '') AS manufacturername,
  nullif(model, '') AS model, nullif(typecode, '') AS typecode, nullif(operator, '') AS operator,
  nullif(operatorcallsign, '') AS operatorcallsign, nullif(operatoricao, '') AS operatoricao,
  nullif(operatoriata, '') AS operatoriata
FROM aircraft_all""",
    }


def _models(flights: str, aircraft: str) -> dict[str, str]:
    airline_facts = "JOIN dim_airlines l ON l.operator_icao = f.operator_icao"
    return {
        "stg_flights": f"""
SELECT DISTINCT ON (icao24, first_seen, flight_type)
  {_key("icao24", "first_seen", "flight_type")} AS flight_id,
  icao24, trim(callsign) AS callsign, flight_type,
  CASE flight_type WHEN 'arrival' THEN est_arrival_airport
                   WHEN 'departure' THEN est_departure_airport END AS airport_icao,
  est_departure_airport, est_arrival_airport,
  make_timestamp(first_seen * 1000000) AS first_seen_at,
  make_timestamp(last_seen * 1000000) AS last_seen_at, _dlt_load_id
FROM {flights} WHERE first_seen IS NOT NULL
ORDER BY icao24, first_seen, flight_type, _dlt_load_id DESC NULLS FIRST,
  last_seen DESC NULLS FIRST, est_departure_airport DESC NULLS FIRST,
  est_arrival_airport DESC NULLS FIRST, callsign DESC NULLS FIRST""",
        "stg_aircraft": _staged_aircraft(aircraft),
        "dim_airports": f"SELECT {_key('icao_code')} AS airport_id, * FROM airports",
        "dim_airlines": f"""
SELECT {_key("operator_icao")} AS airline_id, operator_icao, first.iata AS operator_iata,
  first.name AS airline_name, first.callsign AS operator_callsign
FROM (SELECT operator_icao,
        arg_min({{'iata': operator_iata, 'name': operator, 'callsign': operator_callsign}},
                icao24) AS first
      FROM stg_aircraft WHERE operator_icao IS NOT NULL GROUP BY operator_icao)""",
        "fct_flights": """
SELECT flight_id, icao24, airport_icao, flight_type, callsign, est_departure_airport,
  est_arrival_airport, operator, operator_callsign, operator_icao, operator_iata,
  manufacturer, typecode, first_seen_at, last_seen_at,
  datediff('minute', first_seen_at, last_seen_at) AS flight_duration_minutes,
  CAST(first_seen_at AS date) AS flight_date
FROM stg_flights LEFT JOIN stg_aircraft USING (icao24)""",
        "mart_airport_traffic": """
SELECT CAST(date_trunc('day', f.first_seen_at) AS timestamp) AS traffic_date,
  CAST(date_trunc('week', f.first_seen_at) AS timestamp) AS traffic_week, f.airport_icao,
  a.iata_code AS airport_iata, a.name AS airport_name, a.city, a.country,
  count(*) FILTER (f.flight_type = 'arrival') AS arrivals,
  count(*) FILTER (f.flight_type = 'departure') AS departures, count(*) AS total_flights
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao GROUP BY ALL""",
        "mart_route_popularity": """
SELECT f.est_departure_airport AS departure_icao, d.iata_code AS departure_iata,
  d.name AS departure_airport_name, d.city AS departure_city, d.country AS departure_country,
  f.est_arrival_airport AS arrival_icao, a.iata_code AS arrival_iata,
  a.name AS arrival_airport_name, a.city AS arrival_city, a.country AS arrival_country,
  count(*) AS flight_count, CAST(min(f.flight_date) AS timestamp) AS first_seen_date,
  CAST(max(f.flight_date) AS timestamp) AS last_seen_date
FROM fct_flights f LEFT JOIN airports d ON d.icao_code = f.est_departure_airport
  LEFT JOIN airports a ON a.icao_code = f.est_arrival_airport
WHERE f.est_departure_airport IS NOT NULL AND f.est_arrival_airport IS NOT NULL GROUP BY ALL""",
        "mart_airline_reliability": f"""
SELECT l.*, count(*) AS total_flights,
  count(*) FILTER (f.flight_type = 'departure') AS total_departures,
  count(*) FILTER (f.flight_type = 'arrival') AS total_arrivals,
  {_rounded("avg(f.flight_duration_minutes)", 1)} AS avg_flight_duration_minutes,
  count(DISTINCT f.flight_date) AS active_days
FROM fct_flights f {airline_facts} GROUP BY ALL""",
        "mart_on_time_performance": f"""
SELECT l.airline_id, l.operator_icao, l.operator_iata, l.airline_name,
  f.est_departure_airport AS departure_icao, f.est_arrival_airport AS arrival_icao,
  count(*) AS flight_count,
  {_rounded("avg(f.flight_duration_minutes)", 1)} AS avg_flight_duration_minutes,
  min(f.flight_duration_minutes) AS min_flight_duration_minutes,
  max(f.flight_duration_minutes) AS max_flight_duration_minutes
FROM fct_flights f {airline_facts}
WHERE f.est_departure_airport IS NOT NULL AND f.est_arrival_airport IS NOT NULL
  AND f.flight_duration_minutes > 0 GROUP BY ALL""",
        "mart_traffic_patterns": """
SELECT CAST(f.flight_date AS timestamp) AS traffic_date,
  CAST(hour(f.first_seen_at) AS bigint) AS hour_of_day, f.airport_icao,
  a.iata_code AS airport_iata, a.name AS airport_name, a.city, f.flight_type,
  count(*) AS flight_count
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao GROUP BY ALL""",
    }


_CHECKED = "operator, operator_icao, operator_iata, operator_callsign"
_CARRIED = f"icao24, manufacturer, model, typecode, {_CHECKED}"


def _version(moment: str) -> str:
    return f"""md5(icao24 || '|{moment}') AS dbt_scd_id, timestamp '{moment}' AS dbt_updated_at,
  timestamp '{moment}' AS dbt_valid_from"""


def _history() -> dict[str, str]:
    first, second = "1997-01-01 00:00:00", "1999-01-01 00:00:00"
    return {
        "aircraft_now": _staged_aircraft("raw_aircraft_v2"),
        "changed": f"""
SELECT icao24 FROM (SELECT icao24, {_CHECKED} FROM aircraft_now
                    EXCEPT SELECT icao24, {_CHECKED} FROM stg_aircraft)
WHERE icao24 IN (SELECT icao24 FROM stg_aircraft)""",
        "history": f"""
SELECT {_CARRIED}, {_version(first)},
  CASE WHEN icao24 IN (FROM changed) THEN timestamp '{second}' END AS dbt_valid_to
FROM stg_aircraft
UNION ALL
SELECT {_CARRIED}, {_version(second)}, CAST(NULL AS timestamp) FROM aircraft_now
WHERE icao24 IN (FROM changed) OR icao24 NOT IN (SELECT icao24 FROM stg_aircraft)""",
    }


def _with(*groups: dict[str, str]) -> str:
    ctes = {name: text for group in groups for name, text in group.items()}
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes.items()) + "\n"


_FLIGHT_COLUMNS = (
    "icao24, first_seen, est_departure_airport, last_seen, est_arrival_airport,"
    " callsign, flight_type"
)
_STORED = (
    "dim_airports",
    "dim_airlines",
    "fct_flights",
    "mart_airport_traffic",
    "mart_route_popularity",
    "mart_airline_reliability",
    "mart_on_time_performance",
    "mart_traffic_patterns",
)


def _counts(tables: dict[str, str]) -> str:
    """One row per table: the given select list plus its row count."""
    return " UNION ALL ".join(
        f"SELECT {columns}, count(*) AS n_rows FROM {table}" for table, columns in tables.items()
    )


_AIRPORT_TOTALS = """SELECT airport_iata, airport_name, city,
  CAST(sum(total_flights) AS bigint) AS total_flights,
  CAST(sum(arrivals) AS bigint) AS total_arrivals,
  CAST(sum(departures) AS bigint) AS total_departures
FROM mart_airport_traffic GROUP BY ALL"""

_HOURS = """SELECT a.iata_code AS airport_iata, CAST(hour(f.first_seen_at) AS bigint) AS hour_of_day,
  count(*) AS flight_count
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao GROUP BY ALL"""

_TOP_ROUTES = """SELECT * FROM (FROM mart_route_popularity
  ORDER BY flight_count DESC NULLS FIRST, departure_icao NULLS LAST, arrival_icao NULLS LAST
  LIMIT 20) WHERE departure_iata IS NOT NULL AND arrival_iata IS NOT NULL"""

_AIRLINES = """SELECT airline_name, operator_icao, operator_iata, total_flights, total_arrivals,
  total_departures, avg_flight_duration_minutes, active_days
FROM mart_airline_reliability WHERE airline_name IS NOT NULL
ORDER BY total_flights DESC NULLS FIRST, operator_icao NULLS LAST LIMIT """

_MINUTES = "CAST(sum(flight_duration_minutes) AS bigint)"


def _by_value(expression: str, name: str, table: str = "fct_flights") -> str:
    return f"SELECT {expression} AS {name}, count(*) AS n_rows FROM {table} GROUP BY ALL"


# Years, types and airports with events, but for departures of one airport in odd years.
_DELIVERED = f"""(SELECT * FROM (
  SELECT CAST(date_trunc('year', make_timestamp(first_seen * 1000000)) AS date) AS day, flight_type,
    if(flight_type = 'arrival', est_arrival_airport, est_departure_airport) AS airport
  FROM raw_flights WHERE first_seen IS NOT NULL)
WHERE airport IN (SELECT icao_code FROM airports)
  AND NOT (flight_type = 'departure' AND airport = '{AIRPORTS_IN_SCOPE[0]}' AND year(day) % 2 = 1))"""

_MOST_RECENT = f"""SELECT DISTINCT ON (icao24, first_seen, flight_type) {_FLIGHT_COLUMNS}, _dlt_load_id
FROM raw_flights ORDER BY icao24, first_seen, flight_type, _dlt_load_id DESC NULLS FIRST,
  est_departure_airport DESC NULLS FIRST, last_seen DESC NULLS FIRST,
  est_arrival_airport DESC NULLS FIRST, callsign DESC NULLS FIRST"""

_STATEMENTS: dict[str, str] = {
    # sources
    "src_flights_json": f"SELECT {_FLIGHT_COLUMNS} FROM raw_flights",
    "src_missing_slice": f"""SELECT day, flight_type, airport
FROM (SELECT DISTINCT day FROM {_DELIVERED}), (SELECT unnest(['arrival', 'departure']) AS flight_type),
  (SELECT icao_code AS airport FROM airports)
EXCEPT SELECT day, flight_type, airport FROM {_DELIVERED}""",
    "src_day_window": f"""SELECT {_FLIGHT_COLUMNS}, _dlt_load_id FROM raw_flights
WHERE CAST(make_timestamp(first_seen * 1000000) AS date) = date '1998-06-15'""",
    "src_airport_scope": """SELECT icao24, first_seen, flight_type, icao_code AS airport_icao
FROM raw_flights JOIN airports ON icao_code =
  if(flight_type = 'arrival', est_arrival_airport, est_departure_airport)""",
    "src_union_tagged": f"""SELECT * REPLACE (if(flight_type = 'arrival', NULL, callsign) AS callsign)
FROM (SELECT {_FLIGHT_COLUMNS} FROM raw_flights)""",
    "src_snake_case": f"SELECT {_FLIGHT_COLUMNS} FROM raw_flights",
    "src_load_id": """SELECT icao24, first_seen, flight_type, '1700172800' AS _dlt_load_id
FROM raw_flights""",
    "src_aircraft_csv": "FROM aircraft_file",
    "src_column_subset": """SELECT icao24 AS "ICAO24", 'R-' || p_partkey AS "REGISTRATION",
  manufacturername AS "MANUFACTURERNAME", model AS "MODEL", typecode AS "TYPECODE",
  operator AS "OPERATOR", operatorcallsign AS "OPERATORCALLSIGN",
  operatoricao AS "OPERATORICAO", operatoriata AS "OPERATORIATA" FROM aircraft_all""",
    "src_airports_seed": """SELECT a.*, (SELECT nullif(count(*), 0) FROM raw_flights f
  WHERE f.est_departure_airport = a.icao_code) AS raw_departures FROM airports a""",
    "sql_adhoc": """SELECT a.country, year(f.flight_date) AS traffic_year,
  count(*) FILTER (f.flight_type = 'arrival') AS arrivals
FROM fct_flights f JOIN airports a ON a.icao_code = f.airport_icao GROUP BY ALL""",
    "src_backfill": f"SELECT {_FLIGHT_COLUMNS}, _dlt_load_id FROM landed_once",
    "stream_landing": f"SELECT {_FLIGHT_COLUMNS}, _dlt_load_id FROM landed_once",
    # sinks
    "merge_upsert": """SELECT DISTINCT ON (icao24, first_seen, flight_type) * FROM raw_flights
ORDER BY icao24, first_seen, flight_type, _dlt_load_id DESC NULLS FIRST,
  est_departure_airport DESC NULLS FIRST, last_seen DESC NULLS FIRST,
  est_arrival_airport DESC NULLS FIRST, callsign DESC NULLS FIRST""",
    "merge_out_of_order": _MOST_RECENT,
    "merge_on_read": _MOST_RECENT,
    "merge_compacted": _MOST_RECENT,
    "snapshot_as_of": _MOST_RECENT.replace("FROM raw_flights", "FROM raw_flights WHERE _dlt_load_id < '1700086400'"),
    "stream_any_batch_size": f"SELECT {_FLIGHT_COLUMNS}, _dlt_load_id FROM landed_once",
    "sink_full_reload": "FROM raw_aircraft_v2",
    "sink_row_count": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows_written FROM {t}"
        for t in ("raw_aircraft", "raw_flights", "fct_flights")
    ),
    "sink_table": "FROM mart_airport_traffic",
    "sink_view": "FROM stg_aircraft",
    # history
    "scd2_snapshot": "FROM history",
    "scd2_stored": "FROM history",
    "scd2_repeated_round": "FROM history",
    "scd2_unchanged": """SELECT h.*, n.model AS reported_model FROM history h
JOIN aircraft_now n USING (icao24)
WHERE h.dbt_valid_to IS NULL AND h.dbt_valid_from < timestamp '1999-01-01' AND n.model <> h.model""",
    "scd2_vanished": """SELECT h.* FROM history h LEFT JOIN raw_aircraft_v2 r USING (icao24)
WHERE h.dbt_valid_to IS NULL AND r.icao24 IS NULL""",
    "scd2_as_of": """FROM history WHERE dbt_valid_from <= timestamp '1998-01-01'
AND coalesce(dbt_valid_to, timestamp '9999-12-31') > timestamp '1998-01-01'""",
    "scd2_as_of_stored": """FROM history WHERE dbt_valid_from <= timestamp '1998-01-01'
AND coalesce(dbt_valid_to, timestamp '9999-12-31') > timestamp '1998-01-01'""",
    "join_point_in_time": """SELECT f.flight_id, f.icao24, f.first_seen_at,
  if(f.first_seen_at < coalesce(h.dbt_valid_to, timestamp '9999-12-31'), h.operator, NULL)
    AS operator,
  if(f.first_seen_at < coalesce(h.dbt_valid_to, timestamp '9999-12-31'), h.operator_icao, NULL)
    AS operator_icao
FROM fct_flights f ASOF LEFT JOIN history h
  ON f.icao24 = h.icao24 AND f.first_seen_at >= h.dbt_valid_from""",
    "join_point_in_time_ordered": """SELECT f.flight_id, f.icao24, f.first_seen_at,
  if(f.first_seen_at < coalesce(h.dbt_valid_to, timestamp '9999-12-31'), h.operator, NULL)
    AS operator,
  if(f.first_seen_at < coalesce(h.dbt_valid_to, timestamp '9999-12-31'), h.operator_icao, NULL)
    AS operator_icao
FROM fct_flights f ASOF LEFT JOIN history h
  ON f.icao24 = h.icao24 AND f.first_seen_at >= h.dbt_valid_from""",
    # projections and predicates
    "project_rename": """SELECT icao24, operator AS airline_name, typecode AS aircraft_type
FROM stg_aircraft""",
    "manufacturer_normalize": """SELECT r.manufacturername, s.manufacturer, count(*) AS n_rows
FROM raw_aircraft r JOIN stg_aircraft s USING (icao24) GROUP BY ALL""",
    "resolve_airport": _by_value(
        "flight_type, if(flight_type = 'arrival', est_arrival_airport, est_departure_airport)",
        "airport_icao",
        "raw_flights",
    ),
    "filter_not_null": """SELECT icao24, first_seen, flight_type, _dlt_load_id FROM raw_flights
WHERE NOT (first_seen IS NULL)""",
    "filter_conjunction": """SELECT flight_id, operator_icao, est_departure_airport,
  est_arrival_airport, flight_duration_minutes FROM fct_flights
WHERE operator_icao || est_departure_airport || est_arrival_airport IS NOT NULL
  AND flight_duration_minutes > 0""",
    "filter_equality": "FROM mart_airport_traffic WHERE airport_icao = 'EGLL'",
    "filter_threshold": """SELECT icao24, count(*) AS total_flights FROM fct_flights
GROUP BY icao24 HAVING count(*) > 30""",
    "filter_isin": f"""SELECT *, 'all' AS selection FROM ({_HOURS})
UNION ALL SELECT *, 'two' FROM ({_HOURS}) WHERE airport_iata IN ('AMS', 'CDG')""",
    "topk_then_filter": _TOP_ROUTES,
    # joins
    "join_flight_aircraft": """SELECT flight_id, icao24, operator_icao, manufacturer
FROM fct_flights""",
    "join_airport_lookup": """SELECT f.airport_icao, a.iata_code AS airport_iata, a.city,
  count(*) AS n_rows
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao GROUP BY ALL""",
    "join_role_playing": """SELECT f.est_departure_airport, f.est_arrival_airport,
  count(*) AS n_rows, d.city AS departure_city, a.city AS arrival_city
FROM fct_flights f LEFT JOIN airports d ON d.icao_code = f.est_departure_airport
  LEFT JOIN airports a ON a.icao_code = f.est_arrival_airport GROUP BY ALL""",
    "join_airline_lookup": """SELECT f.operator_icao AS flown_by, count(*) AS n_rows, l.airline_id,
  l.operator_icao
FROM fct_flights f LEFT JOIN dim_airlines l ON l.operator_icao = f.operator_icao GROUP BY ALL""",
    "join_star": f"""SELECT f.flight_type, a.city, l.airline_name,
  count(f.flight_id) AS flight_count, {_MINUTES} AS total_flight_duration_minutes
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao
  LEFT JOIN dim_airlines l ON l.operator_icao = f.operator_icao GROUP BY ALL""",
    # aggregations
    "agg_count_star": _by_value("manufacturer", "manufacturer"),
    "agg_count_col": """SELECT flight_type, count(flight_id) AS with_id,
  count(airport_icao) AS with_airport, count(operator_icao) AS with_operator
FROM fct_flights GROUP BY ALL""",
    "agg_count_if": """SELECT airport_icao,
  CAST(sum(CASE flight_type WHEN 'arrival' THEN 1 ELSE 0 END) AS bigint) AS arrivals,
  CAST(sum(CASE flight_type WHEN 'departure' THEN 1 ELSE 0 END) AS bigint) AS departures
FROM fct_flights GROUP BY ALL""",
    "agg_avg": """SELECT operator_icao, avg(flight_duration_minutes) AS avg_minutes
FROM fct_flights GROUP BY ALL""",
    "agg_min_max": """SELECT typecode, min(flight_duration_minutes) AS shortest,
  max(flight_duration_minutes) AS longest FROM fct_flights GROUP BY ALL""",
    "agg_min_max_expr": """SELECT icao24, CAST(min(flight_date) AS timestamp) AS first_day,
  CAST(max(flight_date) AS timestamp) AS last_day FROM fct_flights GROUP BY ALL""",
    "agg_sum": f"""SELECT airport_icao, flight_type, {_MINUTES} AS minutes
FROM fct_flights GROUP BY ALL""",
    "agg_count_distinct": """SELECT operator_icao, count(*) AS active_days FROM (
  SELECT DISTINCT operator_icao, flight_date FROM fct_flights) GROUP BY ALL""",
    "group_by_keys": """SELECT operator_icao, est_departure_airport, est_arrival_airport,
  count(*) AS n_rows FROM fct_flights GROUP BY 1, 2, 3""",
    "group_by_time_bucket": """SELECT CAST(date_trunc('day', first_seen_at) AS timestamp) AS seen_day,
  CAST(date_trunc('week', first_seen_at) AS timestamp) AS seen_week,
  CAST(hour(first_seen_at) AS bigint) AS seen_hour, count(*) AS n_rows
FROM fct_flights GROUP BY 1, 2, 3""",
    "agg_rollup_mart": """SELECT CAST(date_trunc('week', f.first_seen_at) AS timestamp) AS traffic_week,
  a.country, count(*) AS total_flights
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao GROUP BY ALL""",
    "agg_global": """SELECT count(*) / count(DISTINCT {'a': airport_icao, 'd': flight_date})
  AS avg_flights, count(DISTINCT {'a': airport_icao, 'd': flight_date}) AS n_rows
FROM fct_flights""",
    "agg_ratio": f"""SELECT traffic_date, {_rounded("arrivals / nullif(departures, 0)", 2)} AS ratio
FROM (SELECT CAST(flight_date AS timestamp) AS traffic_date,
        count(*) FILTER (flight_type = 'arrival') AS arrivals,
        count(*) FILTER (flight_type = 'departure') AS departures
      FROM fct_flights GROUP BY flight_date)""",
    "agg_kpi_totals": """SELECT count(*) AS total_flights,
  count(*) FILTER (flight_type = 'arrival') AS total_arrivals,
  count(*) FILTER (flight_type = 'departure') AS total_departures FROM fct_flights""",
    "agg_hourly_totals": """SELECT CAST(hour(first_seen_at) AS bigint) AS "Hour",
  count(*) AS "Flights" FROM fct_flights GROUP BY ALL""",
    "distinct_sorted": """SELECT DISTINCT a.iata_code AS airport_iata
FROM fct_flights f JOIN airports a ON a.icao_code = f.airport_icao""",
    # reshaping
    "unpivot_melt": f"""SELECT airport_iata, 'total_arrivals' AS "Type", total_arrivals AS "Flights"
FROM ({_AIRPORT_TOTALS})
UNION ALL SELECT airport_iata, 'total_departures', total_departures FROM ({_AIRPORT_TOTALS})""",
    "pivot_hours": "SELECT a.iata_code AS airport_iata, "
    + ", ".join(f'count(*) FILTER (hour(f.first_seen_at) = {h}) AS "{h}"' for h in range(24))
    + " FROM fct_flights f JOIN airports a ON a.icao_code = f.airport_icao GROUP BY 1",
    "rename_columns": f"""SELECT departure_iata || ' → ' || arrival_iata AS "Route",
  departure_city || ' → ' || arrival_city AS "Cities", flight_count AS "Flights",
  first_seen_date AS "First Seen", last_seen_date AS "Last Seen" FROM ({_TOP_ROUTES})""",
    # windows, sorts, limits
    "dedup_latest": """SELECT icao24, first_seen, flight_type,
  max({'id': _dlt_load_id, 'seen': coalesce(last_seen, -1)}).id AS _dlt_load_id,
  nullif(max({'id': _dlt_load_id, 'seen': coalesce(last_seen, -1)}).seen, -1) AS last_seen
FROM raw_flights GROUP BY ALL""",
    "dedup_key": """SELECT icao24, min(model) AS model, min(typecode) AS typecode
FROM raw_aircraft GROUP BY icao24""",
    "first_per_group": """SELECT operator_icao, min(icao24) AS icao24,
  min({'i': icao24, 'o': operator}).o AS operator FROM stg_aircraft GROUP BY operator_icao""",
    "sort_desc": "FROM mart_route_popularity",
    "sort_multi_key": "FROM mart_on_time_performance",
    "top_k": """FROM mart_on_time_performance ORDER BY flight_count DESC NULLS FIRST,
  operator_icao NULLS LAST, departure_icao NULLS LAST, arrival_icao NULLS LAST LIMIT 30""",
    "head_k": f"{_AIRLINES} 15",
    # scalar functions
    "fn_trim": """SELECT callsign, regexp_replace(callsign, '^ +| +$', '', 'g') AS trimmed,
  count(*) AS n_rows FROM raw_flights GROUP BY ALL""",
    "fn_blank_to_null": "SELECT icao24, "
    + ", ".join(
        f"CASE WHEN trim({c}) <> '' THEN trim({c}) END AS {c}"
        for c in ("operator", "operatorcallsign", "operatoricao", "operatoriata")
    )
    + " FROM raw_aircraft",
    "fn_ilike": """SELECT manufacturername, count(*) AS n_rows FROM raw_aircraft
WHERE lower(manufacturername) LIKE '%b%r%' GROUP BY ALL""",
    "fn_cast": _by_value("CAST(_dlt_load_id AS bigint)", "load_seconds", "raw_flights"),
    "fn_epoch_to_ts": """SELECT first_seen, last_seen,
  timestamp '1970-01-01' + to_seconds(first_seen) AS first_seen_at,
  timestamp '1970-01-01' + to_seconds(last_seen) AS last_seen_at FROM raw_flights""",
    "fn_minutes_between": """SELECT flight_id,
  datediff('minute', first_seen_at, last_seen_at) AS minutes FROM stg_flights""",
    "fn_to_date": _by_value("CAST(first_seen_at AS date)", "seen_on"),
    "fn_trunc_day": _by_value("CAST(date_trunc('day', first_seen_at) AS timestamp)", "day_start"),
    "fn_trunc_week": _by_value("CAST(date_trunc('week', first_seen_at) AS timestamp)", "week_start"),
    "fn_hour": _by_value("CAST(date_part('hour', first_seen_at) AS bigint)", "hour_of_day"),
    "fn_round": f"""SELECT icao24, {_rounded("m", 1)} AS rounded_to_1,
  {_rounded("m", 2)} AS rounded_to_2
FROM (SELECT icao24, avg(flight_duration_minutes) AS m FROM fct_flights GROUP BY icao24)""",
    "surrogate_key": f"""SELECT icao24, first_seen, est_departure_airport, est_arrival_airport,
  {_key("icao24", "first_seen", "est_departure_airport", "est_arrival_airport")} AS row_key
FROM raw_flights""",
    "fn_concat_route": """SELECT departure_icao, arrival_icao,
  departure_iata || ' → ' || arrival_iata AS route FROM mart_route_popularity""",
    # data quality
    "dq_unique": """SELECT icao24, count(*) AS n_rows FROM raw_aircraft
GROUP BY icao24 HAVING count(*) > 1""",
    "dq_not_null": "SELECT flight_id, flight_type FROM fct_flights WHERE airport_icao IS NULL",
    "dq_accepted_values": """SELECT est_departure_airport, count(*) AS n_rows FROM fct_flights
WHERE est_departure_airport IS NOT NULL
  AND est_departure_airport NOT IN (SELECT icao_code FROM airports) GROUP BY ALL""",
    "dq_freshness": """SELECT newest_load, age_hours,
  CASE WHEN age_hours <= 25 THEN 'pass' WHEN age_hours <= 49 THEN 'warn' ELSE 'error' END AS status
FROM (SELECT newest_load, round((epoch(timestamp '2023-11-17') - newest_load) / 3600, 4) AS age_hours
      FROM (SELECT max(CAST(_dlt_load_id AS double)) AS newest_load FROM raw_flights))""",
    "dq_contract": _counts(
        {
            "mart_airport_traffic": "'mart_airport_traffic' AS model, CAST(10 AS bigint) AS n_columns",
            "mart_route_popularity": "'mart_route_popularity', 13",
            "mart_airline_reliability": "'mart_airline_reliability', 10",
            "mart_on_time_performance": "'mart_on_time_performance', 10",
            "mart_traffic_patterns": "'mart_traffic_patterns', 8",
        }
    ),
    # models
    **{
        name: f"FROM {name}"
        for name in ("stg_flights", "stg_aircraft", *_STORED)
        if name != "dim_airports"
    },
    "dim_airports": """SELECT d.*, (SELECT nullif(count(*), 0) FROM fct_flights f
  WHERE f.airport_icao = d.icao_code) AS n_flights FROM dim_airports d""",
    # served queries
    "vq_busiest_airports": """SELECT a.name AS airport_name, a.city, count(*) AS total_flights
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao GROUP BY ALL""",
    "vq_top_routes": """SELECT departure_iata, arrival_iata, departure_city, arrival_city, flight_count
FROM mart_route_popularity ORDER BY flight_count DESC NULLS FIRST, departure_icao NULLS LAST,
  arrival_icao NULLS LAST LIMIT 10""",
    "vq_most_active_airlines": f"""SELECT airline_name, operator_iata, total_flights,
  avg_flight_duration_minutes FROM ({_AIRLINES} 20)""",
    "vq_daily_traffic_heathrow": """SELECT count(*) / count(DISTINCT flight_date) AS avg_daily_flights
FROM fct_flights WHERE airport_icao = 'EGLL'""",
    "vq_arrivals_vs_departures": f"""SELECT airport_iata, airport_name, total_arrivals,
  total_departures,
  {_rounded("total_arrivals / nullif(total_departures, 0)", 2)} AS arrival_departure_ratio
FROM ({_AIRPORT_TOTALS})""",
    "vq_weekly_traffic_trend": """SELECT CAST(date_trunc('week', first_seen_at) AS timestamp)
  AS traffic_week, count(*) AS total_flights FROM fct_flights GROUP BY ALL""",
    "vq_routes_from_paris": """SELECT arrival_iata, arrival_city, arrival_country, flight_count
FROM mart_route_popularity WHERE departure_icao = 'LFPG'""",
    "vq_airline_avg_duration": """SELECT airline_name, operator_iata, avg_flight_duration_minutes,
  total_flights FROM mart_airline_reliability
WHERE airline_name IS NOT NULL AND total_flights > 10
ORDER BY avg_flight_duration_minutes DESC NULLS FIRST, operator_icao NULLS LAST LIMIT 15""",
    "dash_airport_traffic": _AIRPORT_TOTALS,
    "dash_top_routes": f"""SELECT departure_iata, departure_city, arrival_iata, arrival_city,
  flight_count, first_seen_date, last_seen_date,
  departure_iata || ' → ' || arrival_iata AS route,
  departure_city || ' → ' || arrival_city AS label FROM ({_TOP_ROUTES})""",
    "dash_airlines": f"{_AIRLINES} 30",
    "dash_airport_hour": _HOURS,
    # metric layer
    "sem_registry": " UNION ALL ".join(
        f"SELECT '{t}' AS logical_table, CAST(sum(n) AS bigint) AS n_rows, count(*) AS n_keys"
        f" FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY ALL)"
        for t, k in (
            ("fct_flights", "flight_id"),
            ("dim_airports", "airport_id"),
            ("dim_airlines", "airline_id"),
            ("mart_airport_traffic", "airport_icao, traffic_date"),
            ("mart_airline_reliability", "operator_icao"),
            ("mart_route_popularity", "departure_icao, arrival_icao"),
        )
    ),
    "sem_by_dimension": """SELECT a.country, f.manufacturer, count(f.flight_id) AS flight_count,
  avg(f.flight_duration_minutes) AS avg_flight_duration_minutes
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao
WHERE f.flight_type = 'departure' GROUP BY ALL""",
    "sem_filter_by_dimension": """SELECT f.operator_icao, count(f.flight_id) AS flight_count,
  avg(f.flight_duration_minutes) AS avg_flight_duration_minutes
FROM fct_flights f JOIN airports a ON a.icao_code = f.airport_icao
WHERE a.country IN ('France', 'Spain') GROUP BY ALL""",
    "sem_by_time_grain": """SELECT a.name AS airport_name,
  CAST(date_trunc('month', f.first_seen_at) AS timestamp) AS traffic_date,
  count(*) AS total_flights, count(*) FILTER (f.flight_type = 'arrival') AS total_arrivals
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao GROUP BY ALL""",
    "sem_flight_measures": f"""SELECT operator_icao, count(flight_id) AS flight_count,
  avg(flight_duration_minutes) AS avg_flight_duration_minutes,
  {_MINUTES} AS total_flight_duration_minutes FROM fct_flights GROUP BY ALL""",
    "sem_airport_measures": """SELECT a.country, a.city, count(*) AS total_flights,
  count(*) FILTER (f.flight_type = 'arrival') AS total_arrivals,
  count(*) FILTER (f.flight_type = 'departure') AS total_departures
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao GROUP BY ALL""",
    "sem_airline_measures": """SELECT operator_iata,
  CAST(sum(total_flights) AS bigint) AS total_flights,
  CAST(sum(total_arrivals) AS bigint) AS total_arrivals,
  CAST(sum(total_departures) AS bigint) AS total_departures,
  round(avg(avg_flight_duration_minutes), 6) AS avg_flight_duration_minutes,
  CAST(sum(active_days) AS bigint) AS active_days
FROM mart_airline_reliability GROUP BY ALL""",
    "sem_route_measures": """SELECT d.country AS departure_country, a.country AS arrival_country,
  count(*) AS flight_count
FROM fct_flights f LEFT JOIN airports d ON d.icao_code = f.est_departure_airport
  LEFT JOIN airports a ON a.icao_code = f.est_arrival_airport
WHERE f.est_departure_airport IS NOT NULL AND f.est_arrival_airport IS NOT NULL GROUP BY ALL
ORDER BY flight_count DESC, departure_country NULLS LAST, arrival_country NULLS LAST LIMIT 25""",
    "sem_default_agg": """SELECT kind, n AS flight_count FROM (
  SELECT count(*) AS n FROM fct_flights
  WHERE est_departure_airport || est_arrival_airport IS NOT NULL), (VALUES ('default'), ('declared')) k(kind)""",
    # daily job
    "pipeline_idempotent": """SELECT count(*) AS rows_first, count(*) AS rows_second,
  CAST(0 AS bigint) AS rows_differing FROM landed_once""",
    "sem_routed": """SELECT a.country, date_trunc('month', f.first_seen_at)::timestamp AS first_seen_at,
  count(*) AS flight_count
FROM fct_flights f LEFT JOIN airports a ON a.icao_code = f.airport_icao
WHERE f.flight_type = 'departure' GROUP BY ALL""",
    "agg_distinct_merged": """SELECT operator_icao, count(DISTINCT CAST(first_seen_at AS date)) AS active_days
FROM fct_flights WHERE operator_icao IS NOT NULL GROUP BY operator_icao""",
}

# The column checks, as (model, column, kind).
_CHECKED_COLUMNS = (
    ("stg_flights", "flight_id", "unique"),
    ("stg_flights", "flight_id", "not_null"),
    ("stg_flights", "icao24", "not_null"),
    ("stg_flights", "flight_type", "not_null"),
    ("stg_flights", "flight_type", "accepted_values"),
    ("stg_flights", "airport_icao", "not_null"),
    ("stg_aircraft", "icao24", "unique"),
    ("stg_aircraft", "icao24", "not_null"),
    ("dim_airports", "airport_id", "unique"),
    ("dim_airports", "airport_id", "not_null"),
    ("dim_airports", "icao_code", "unique"),
    ("dim_airports", "icao_code", "not_null"),
    ("dim_airlines", "airline_id", "unique"),
    ("dim_airlines", "airline_id", "not_null"),
    ("dim_airlines", "operator_icao", "unique"),
    ("dim_airlines", "operator_icao", "not_null"),
    ("fct_flights", "flight_id", "unique"),
    ("fct_flights", "flight_id", "not_null"),
    ("fct_flights", "icao24", "not_null"),
)


def _failures(model: str, column: str, check: str) -> str:
    if check == "unique":
        return f"SELECT count({column}) - count(DISTINCT {column}) FROM {model}"
    if check == "accepted_values":
        return f"SELECT count(*) FROM {model} WHERE {column} NOT IN ('arrival', 'departure')"
    return f"SELECT count(*) FROM {model} WHERE {column} IS NULL"


def _daily_job() -> dict[str, str]:
    """Statements over the tables that the daily job leaves behind."""
    outcomes = " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{c}' AS \"column\", '{k}' AS \"check\","
        f" ({_failures(m, c, k)}) AS failures"
        for m, c, k in _CHECKED_COLUMNS
    )
    contracts = " UNION ALL ".join(f"SELECT '{m}', '', 'contract', 0" for m in CONTRACTS)
    routed = {"landed_once": "'raw' AS schema_name, 'flights' AS model"}
    routed["aircraft_file"] = "'raw', 'aircraft'"
    routed["stg_aircraft"] = "'snapshots', 'aircraft_snapshot'"
    routed |= {t: f"'marts', '{t}'" for t in _STORED}
    stored = {t: f"'{t}' AS model" for t in ("stg_flights", "stg_aircraft", *_STORED)}
    return {
        "src_table_scan": _by_value("flight_type", "flight_type", "landed_once"),
        "sink_layers": _counts(routed),
        "pipeline_build": _counts(stored),
        "pipeline_incremental": f"""SELECT model, CAST(n_rows AS bigint) AS n_rows,
  CAST(0 AS bigint) AS rows_differing, false AS skipped FROM ({_counts(stored)})""",
        "pipeline_resumed": "FROM mart_airline_reliability",
        "dq_results": f"""SELECT *, if(failures > 0, 'fail', 'pass') AS status,
  CAST(NULL AS bigint) AS rows_written FROM ({outcomes} UNION ALL {contracts})
UNION ALL SELECT 'raw_flights', '_dlt_load_id', 'freshness', 0, 'pass', NULL
UNION ALL SELECT model, '', 'build', 0, 'built', n_rows FROM ({_counts(stored)})""",
    }


def statements() -> dict[str, str]:
    inputs = _inputs()
    prefix = _with(inputs, _models("raw_flights", "raw_aircraft"), _history())
    daily = _with(inputs, _models("landed_once", "aircraft_file"))
    renewed = _with(inputs, _models("landed_once", "raw_aircraft_v2"))
    return {
        "fact_changed_aircraft": renewed + "FROM fct_flights",
        **{name: prefix + text for name, text in _STATEMENTS.items()},
        **{name: daily + text for name, text in _daily_job().items()},
    }
