"""Landed flight records.

Layout: ``<base>/day=2024-01-31/flight_type=arrival/airport=EGLL/*.json``, one folder per
day, type and airport asked for, each file holding JSON objects or one JSON array of them.
The airport level may be missing. A slice that was never delivered is an absent folder and
reads as zero rows. Only the folders of the days asked for are listed.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightloom import files
from flightloom.functions import SECONDS_PER_DAY
from flightloom.schemas import (
    FLIGHT_TYPES,
    LANDED_FIELDS,
    LANDED_FLIGHTS,
    LANDED_SLICE,
    LOAD_ID,
)

log = logging.getLogger(__name__)

LANDED_SCHEMA = T.StructType([*LANDED_FLIGHTS.fields, *LANDED_SLICE.fields])

# A malformed record raises instead of turning into nulls.
READ_OPTIONS = {"mode": "FAILFAST"}


def _day_folders(spark: SparkSession, base: str, days: Sequence[date] | None) -> list[str]:
    if days is None:
        return [base]
    wanted = [f"{base.rstrip('/')}/day={day.isoformat()}" for day in days]
    return [folder for folder in wanted if files.exists(spark, folder)]


def read_landed(
    spark: SparkSession, base: str, days: Sequence[date] | None = None
) -> DataFrame:
    """Landed records of the given days, or of all; only those days' folders are listed."""
    folders = _day_folders(spark, base, days)
    if not folders:
        return spark.createDataFrame([], LANDED_SCHEMA)
    reader = spark.read.schema(LANDED_SCHEMA).options(**READ_OPTIONS).option("basePath", base)
    return reader.json(folders).select(*LANDED_SCHEMA.names)


def tagged_union(slices: Mapping[str, DataFrame]) -> DataFrame:
    """Bag union of per-type frames, each row carrying its type; absent fields are null."""
    tagged = [df.withColumn("flight_type", F.lit(kind)) for kind, df in slices.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def snake_case(landed: DataFrame) -> DataFrame:
    return landed.withColumnsRenamed(LANDED_FIELDS)


def stamp_load(df: DataFrame, load_id: str) -> DataFrame:
    """Mark rows with the load that brought them: epoch seconds as text."""
    return df.withColumn(LOAD_ID, F.lit(load_id))


def day_window(day: date) -> tuple[int, int]:
    """Unix seconds of UTC midnight and of the next one."""
    begin = (day - date(1970, 1, 1)).days * SECONDS_PER_DAY
    return begin, begin + SECONDS_PER_DAY


def in_day_window(seconds: Column, day: date) -> Column:
    begin, end = day_window(day)
    return (seconds >= begin) & (seconds < end)


def yesterday(now: datetime) -> date:
    """Default day to load: the one before the UTC day of ``now``."""
    midnight, _ = day_window(now.astimezone(timezone.utc).date())
    return date(1970, 1, 1) + timedelta(seconds=midnight - SECONDS_PER_DAY)


def landed_slices(
    spark: SparkSession, base: str, days: Sequence[date] | None = None
) -> DataFrame:
    """(day, flight_type, airport) of every delivered slice, from the file listing alone.

    A delivered file without records counts: it is an empty answer, not a missing one.
    Without an airport level, airport is null.
    """
    folders = _day_folders(spark, base, days)
    if not folders:
        return spark.createDataFrame([], "day date, flight_type string, airport string")
    found = spark.read.format("binaryFile").option("basePath", base).load(folders)
    airport = F.col("airport") if "airport" in found.columns else F.lit(None)
    return found.select(
        F.col("day").cast("date"), "flight_type", airport.cast("string").alias("airport")
    ).distinct()


def missing_slices(
    delivered: DataFrame, days: DataFrame, airports: Sequence[str] | None = None
) -> DataFrame:
    """Slices of the given days, and of the given airports, that were not delivered."""
    expected = days.select(
        "day", F.explode(F.array(*map(F.lit, FLIGHT_TYPES))).alias("flight_type")
    )
    key = ["day", "flight_type"]
    if airports is not None:
        listed = F.explode(F.array(*map(F.lit, airports)))
        expected, key = expected.withColumn("airport", listed), [*key, "airport"]
    return expected.join(delivered, key, "left_anti")


def warn_missing(
    spark: SparkSession, base: str, days: Sequence[date], airports: Sequence[str] | None = None
) -> None:
    """Log the missing slices of the given days, a line per type of flight and airport.

    Airports only count where slices are delivered by airport.
    """
    asked = spark.createDataFrame([(d,) for d in days], "day date")
    delivered = landed_slices(spark, base, days)
    if airports is not None and delivered.filter(F.col("airport").isNotNull()).isEmpty():
        airports = None if not delivered.isEmpty() else airports
    missing = missing_slices(delivered, asked, airports)
    if airports is None:
        missing = missing.withColumn("airport", F.lit(None).cast("string"))
    by_slice = missing.groupBy("flight_type", "airport").agg(
        F.sort_array(F.collect_set("day")).alias("days")
    )
    # At most one line for each type and asked airport.
    for row in by_slice.orderBy("airport", "flight_type").collect():
        listed = ", ".join(map(str, row.days[:10])) + (", ..." if len(row.days) > 10 else "")
        log.warning(
            "no %s records%s landed for %d day(s), skipped: %s",
            row.flight_type,
            f" of {row.airport}" if row.airport else "",
            len(row.days),
            listed,
        )
