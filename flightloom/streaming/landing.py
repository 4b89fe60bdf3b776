"""The keyed load, run as a stream over the landing folder.

The stream's checkpoint remembers which files have been loaded, so a run picks up
exactly what arrived since the last one and stops. A batch that is replayed after a
failure merges to the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from flightloom.plans.pipeline import merge_flights, prepare_flights
from flightloom.sinks.tables import Layers
from flightloom.sources.landing import LANDED_SCHEMA, READ_OPTIONS


def follow_landing(
    layers: Layers,
    base: str,
    checkpoint: str,
    load_id: str,
    grain: str = "day",
    files_per_batch: int | None = None,
) -> None:
    """Load all files that have arrived and not been loaded yet, then return."""

    def load(batch: DataFrame, _: int) -> None:
        # A micro-batch has a session of its own, whose settings its writes obey.
        here = layers.in_session(batch.sparkSession)
        merge_flights(here, prepare_flights(batch, load_id, grain))

    reader = layers.spark.readStream.schema(LANDED_SCHEMA).options(**READ_OPTIONS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.json(base).writeStream.foreachBatch(load)
    stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
