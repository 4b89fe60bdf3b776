"""Time the models over raw flights with hot keys.

    python tools/skew.py [sf_dir] [copies]

The raw flights of the fixture, ``copies`` times over: a third of the rows is put on one
aircraft, another third are copies of one key. Broadcast joins are switched off, so the fact
joins by shuffle as it would with a large aircraft table. Prints the seconds of each step, and
for each the rows of its result.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from flightloom.fixtures.workspace import workspace  # noqa: E402
from flightloom.plans import marts, staging, star  # noqa: E402
from flightloom.session import build_session, scratch_dir  # noqa: E402
from flightloom.sources.reference import default_airports  # noqa: E402

CONF = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.driver.memory": "16g",
    "spark.ui.showConsoleProgress": "false",
}


def skewed(flights: DataFrame, copies: int) -> DataFrame:
    each = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    many = flights.withColumn("id", each).withColumn(
        "part", F.pmod(F.xxhash64("icao24", "first_seen", "id"), F.lit(3))
    )
    hot = many.withColumn("icao24", F.when(F.col("part") > 0, "ac000001").otherwise(F.col("icao24")))
    moved = F.col("first_seen") + F.when(F.col("part") == 0, F.col("id") * 7).otherwise(F.col("id") * 11)
    one_key = F.when(F.col("part") == 2, F.lit(800_000_000)).otherwise(moved)
    return hot.withColumn("first_seen", one_key).drop("id", "part")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 48
    spark = build_session("skew", master="local[8]", conf=CONF)
    spark.sparkContext.setLogLevel("ERROR")
    space, root = workspace(spark, sf_dir), scratch_dir(spark, "skew")

    def timed(name: str, df: DataFrame) -> DataFrame:
        start = time.perf_counter()
        df.write.parquet(f"{root}/{name}")
        seconds, stored = time.perf_counter() - start, spark.read.parquet(f"{root}/{name}")
        print(f"| {name} | {seconds:.1f} | {stored.count()} |", flush=True)
        return stored

    raw = timed("raw_flights", skewed(space.table("raw_flights"), copies))
    flights = timed("stg_flights", staging.stg_flights(raw))
    aircraft = timed("stg_aircraft", staging.stg_aircraft(space.table("raw_aircraft")))
    fact = timed("fct_flights", star.fct_flights(flights, aircraft))
    airports = star.dim_airports(default_airports(spark))
    airlines = star.dim_airlines(aircraft)
    timed("mart_airport_traffic", marts.mart_airport_traffic(fact, airports))
    timed("mart_airline_reliability", marts.mart_airline_reliability(fact, airlines))
    timed("mart_traffic_patterns", marts.mart_traffic_patterns(fact, airports))


if __name__ == "__main__":
    main()
