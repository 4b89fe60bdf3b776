"""Column helpers built from JVM-side Spark functions only."""

from flightloom.functions.clock import (
    SECONDS_PER_DAY,
    epoch_to_ntz,
    hour_of,
    minutes_between,
    start_of,
)
from flightloom.functions.keys import history_row_id, surrogate_key
from flightloom.functions.ordering import ascending, descending
from flightloom.functions.text import blank_to_null, joined_label, manufacturer_name

__all__ = [
    "SECONDS_PER_DAY",
    "ascending",
    "blank_to_null",
    "descending",
    "epoch_to_ntz",
    "history_row_id",
    "hour_of",
    "joined_label",
    "manufacturer_name",
    "minutes_between",
    "start_of",
    "surrogate_key",
]
