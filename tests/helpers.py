"""Small frames for tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

RAW_FLIGHTS = (
    "icao24 string, first_seen bigint, flight_type string, last_seen bigint,"
    " est_departure_airport string, est_arrival_airport string, callsign string,"
    " _dlt_load_id string"
)
RAW_AIRCRAFT = (
    "icao24 string, manufacturername string, model string, typecode string, operator string,"
    " operatorcallsign string, operatoricao string, operatoriata string"
)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def flight(icao24="a1", first=0, kind="departure", last=3600, dep="EGLL", arr="LFPG",
           callsign="FL1 ", load="100"):
    return (icao24, first, kind, last, dep, arr, callsign, load)


def raw_flights(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), RAW_FLIGHTS)


def aircraft(icao24="a1", maker="AIRBUS", model="M", typecode="T", operator="Op",
             callsign="OPC", icao="OPR", iata="OP"):
    return (icao24, maker, model, typecode, operator, callsign, icao, iata)


def raw_aircraft(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), RAW_AIRCRAFT)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
