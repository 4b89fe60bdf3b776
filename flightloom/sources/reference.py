"""Reference data: the aircraft file and the airport seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.schemas import AIRCRAFT_COLUMNS, AIRPORT_COLUMNS, AIRPORTS, AIRPORTS_FILE

# Quotes inside a quoted field are doubled; a row that does not parse raises.
CSV_OPTIONS = {"header": "true", "escape": '"', "mode": "FAILFAST"}

# Texts that mean "no value" in the aircraft file.
NO_VALUE = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def read_aircraft(spark: SparkSession, path: str) -> DataFrame:
    """The nine columns in use, found by header name whatever else the file holds."""
    return with_no_value_as_null(keep_columns(spark.read.options(**CSV_OPTIONS).csv(path)))


def keep_columns(aircraft: DataFrame) -> DataFrame:
    return aircraft.select(*AIRCRAFT_COLUMNS)


def with_no_value_as_null(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.when(~F.col(c).isin(*NO_VALUE), F.col(c)).alias(c) for c in df.columns]
    )


def upper_case_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """Airport seed file; its header must match the declared columns."""
    options = {**CSV_OPTIONS, "enforceSchema": "false"}
    return spark.read.schema(AIRPORTS_FILE).options(**options).csv(path)


def default_airports(spark: SparkSession) -> DataFrame:
    """The airports in scope as a literal relation, whose exact size Catalyst knows."""
    values = ", ".join(
        "(" + ", ".join(f"'{value}'" for value in row) + ")" for row in AIRPORTS
    )
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(AIRPORT_COLUMNS)})")
