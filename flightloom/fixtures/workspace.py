"""The fixture inputs and every model over them, for one session and data folder.

As in the daily job, raw inputs and tables are written once to the shared folder and
read back by whatever needs them. The flights of the staging view are not: whoever asks for
them computes them from the raw ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom import files
from flightloom.fixtures import views
from flightloom.functions import epoch_to_ntz, start_of
from flightloom.plans.models import MODEL
from flightloom.plans.pipeline import Report, build, ingest, reload_aircraft
from flightloom.schemas import LANDED_FIELDS, LOAD_ID
from flightloom.session import STORED, scratch_dir, size_session
from flightloom.sinks.tables import Layers
from flightloom.sources.landing import landed_slices
from flightloom.sources.reference import default_airports

# Unix seconds of 1992-01-01.
FIRST_DELIVERY = 694224000

# Models that are views over a large table; the small view of the aircraft is stored for its joins.
INLINED = ("stg_flights",)

# Bytes of landed flights, uncompressed, for a byte of line items.
LANDED_SIZE = 11

# Midnight of l_shipdate in Unix seconds, without the session time zone.
SPARK_EPOCH = "cast(datediff(l_shipdate, date'1970-01-01') as bigint) * 86400"


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    @cached_property
    def root(self) -> str:
        return scratch_dir(self.spark, "workspace")

    def source(self, table: str) -> DataFrame:
        """A given table."""
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def derive(self, view: str) -> DataFrame:
        """A raw input, derived lazily from the given tables."""
        if view == "airports":
            return default_airports(self.spark)
        if view == "raw_flights":
            text = views.RAW_FLIGHTS.replace("{EPOCH}", SPARK_EPOCH)
            return self._sql(text, lineitem=self.source("lineitem"))
        aircraft = self._sql(views.AIRCRAFT_ALL, part=self.source("part"))
        if view == "aircraft_all":
            return aircraft
        text = {"raw_aircraft": views.RAW_AIRCRAFT, "raw_aircraft_v2": views.RAW_AIRCRAFT_V2}[view]
        return self._sql(text, aircraft_all=aircraft)

    def table(self, name: str) -> DataFrame:
        """A raw input or model, written on first use if it is no view."""
        if name in INLINED:
            return self.build(name)
        if name not in self._tables:
            self._tables[name] = self._make(name)
        return self._tables[name]

    def build(self, name: str) -> DataFrame:
        """A model computed anew from its inputs."""
        model = MODEL[name]
        return model.build(*[self.table(i) for i in model.inputs])

    @cached_property
    def tables(self) -> Mapping[str, DataFrame]:
        """All tables by name, each made when first asked for."""
        return _TablesOf(self)

    def registered_aircraft(self) -> DataFrame:
        """Aircraft with a registration and columns that nobody keeps."""
        return self.derive("aircraft_all").withColumn(
            "registration", F.concat(F.lit("R-"), F.col("p_partkey").cast("string"))
        )

    @cached_property
    def aircraft_file(self) -> str:
        """The aircraft as delivered: CSV with a header and surplus columns."""
        path = f"{self.root}/aircraft.csv"
        options = {
            "header": "true",
            "escape": '"',
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }
        self.registered_aircraft().write.options(**options).csv(path)
        return path

    @cached_property
    def landing(self) -> str:
        """The raw flights as delivered: JSON by day and type, without a load id.

        A delivery holds a month of flights under the month's first day, as the given
        tables have too few flights a day to fill a folder each. A record that lacks the
        time it was first seen was delivered all the same: with those last seen then, or
        with the first delivery.
        """
        path = f"{self.root}/landing"
        seen = F.coalesce("first_seen", "last_seen", F.lit(FIRST_DELIVERY))
        month = start_of("month", epoch_to_ntz(seen)).cast("date")
        delivered = self.derive("raw_flights").drop(LOAD_ID).withColumn("day", month)
        delivered = delivered.withColumnsRenamed({v: k for k, v in LANDED_FIELDS.items()})
        gathered = delivered.hint("rebalance", F.col("day"), F.col("flight_type"))
        gathered.write.partitionBy("day", "flight_type").json(path, compression="gzip")
        return path

    def deliver(self) -> None:
        """Make the files that the daily job loads."""
        self.landing, self.aircraft_file  # noqa: B018

    def landed_days(self) -> list[date]:
        days = landed_slices(self.spark, self.landing).select("day").distinct()
        return sorted(row.day for row in days.collect())

    def new_layers(self, label: str) -> Layers:
        """Empty layers of their own."""
        place = scratch_dir(self.spark, label)
        return Layers(self.spark, place, environment=f"{label}_{place[-8:]}")

    @cached_property
    def pipeline_run(self) -> tuple[Layers, Report]:
        """The daily job over all landed days; outcomes of checks are only recorded."""
        layers = self.new_layers("daily")
        ingest(layers, self.landing, self.landed_days(), "1700000000", grain="month")
        reload_aircraft(layers, self.aircraft_file)
        run_at = datetime(1999, 1, 1)
        report = build(
            layers, self.table("airports"), run_at, on_failure="record", partitioned=False
        )
        return layers, report

    def _make(self, name: str) -> DataFrame:
        if name not in MODEL:
            df = self.derive(name)
            return df if name == "airports" else self._written(name, df)
        return self._written(name, self.build(name))

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").options(**STORED).parquet(path)
        return self.spark.read.parquet(path)

    def _sql(self, text: str, **frames: DataFrame) -> DataFrame:
        for frame in frames:
            text = text.replace(f"from {frame}", f"from {{{frame}}}")
        return self.spark.sql(text, **frames)


class _TablesOf(Mapping[str, DataFrame]):
    def __init__(self, space: Workspace) -> None:
        self._space = space

    def __getitem__(self, name: str) -> DataFrame:
        return self._space.table(name)

    def __iter__(self) -> Iterator[str]:
        return iter(MODEL)

    def __len__(self) -> int:
        return len(MODEL)


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        size_session(spark, LANDED_SIZE * files.size(spark, f"{sf_dir}/lineitem.parquet"))
        _open[key] = Workspace(spark, sf_dir)
    return _open[key]
