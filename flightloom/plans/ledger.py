"""What has been loaded and is not yet in every model.

A ledger entry either opens a day, for one model or for all, or closes it for one model (or all
days at once, after a whole build). Entries are numbered; a day is open for a model as long as
its newest opening has a higher number than its newest closing. Days are opened before the
raw table changes and closed after a model has stored them and passed its checks, so whatever
happens in between, a failed check or a crash, leaves them open for the next run.

The ledger also knows the newest load, so freshness needs no scan of the raw table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.sinks.tables import Layers

EVERY = "*"
OPENED, CLOSED, COUNTED = "opened", "closed", "counted"
SCHEMA = "entry string, model string, day string, mark bigint, load_id string"

# Entries from which on settled ones are dropped.
MANY = 2000

_TABLE = ("quality", "ledger")
# A raw partition of rows without a day; no model has them.
_NO_DAY = ""


class Ledger:
    def __init__(self, layers: Layers) -> None:
        self.layers = layers

    def exists(self) -> bool:
        return self.layers.exists(*_TABLE)

    def mark(self) -> int:
        """Number of the newest entry."""
        if not self.exists():
            return 0
        return self._entries().agg(F.max("mark")).first()[0] or 0

    def open(
        self, days: Iterable[str | None], load_id: str | None = None, models: Iterable[str] = (EVERY,)
    ) -> None:
        mark = self.mark() + 1
        rows = [(OPENED, m, _NO_DAY if d is None else d, mark, load_id) for d in days for m in models]
        # A load that changes no day is still the newest load.
        self._append(rows or [(COUNTED, EVERY, _NO_DAY, mark, load_id)])

    def close(self, days: Mapping[str, Mapping[str | None, int]]) -> None:
        """Days of each model, with the number of the opening that is done."""
        self._append(
            [
                (CLOSED, model, _NO_DAY if day is None else day, mark, None)
                for model, done in days.items()
                for day, mark in done.items()
            ]
        )

    def close_all(self, models: Iterable[str], mark: int) -> None:
        """All days, as far as they were opened up to the given number."""
        self._append([(CLOSED, m, EVERY, mark, None) for m in models])

    def open_days(self, models: Iterable[str]) -> dict[str, dict[str | None, int]]:
        """Open days of each model, with the number of their opening."""
        found: dict[str, dict[str | None, int]] = {m: {} for m in models}
        if not self.exists():
            return found
        opened: dict[str, dict[str, int]] = {}
        closed: dict[str, dict[str, int]] = {}
        latest = self._entries().where(F.col("entry") != COUNTED).groupBy("entry", "model", "day").agg(F.max("mark"))
        for entry, model, day, mark in latest.collect():
            (opened if entry == OPENED else closed).setdefault(model, {})[day] = mark
        for model, days in found.items():
            done = closed.get(model, {})
            asked = dict(opened.get(EVERY, {}))
            for day, mark in opened.get(model, {}).items():
                asked[day] = max(mark, asked.get(day, 0))
            for day, mark in asked.items():
                if mark > max(done.get(day, 0), done.get(EVERY, 0)):
                    days[None if day == _NO_DAY else day] = mark
        return found

    def loads(self, load_id: str) -> DataFrame | None:
        """The load ids that the ledger knows, the newest among them; None if it knows none."""
        if not self.exists():
            return None
        known = self._entries().where(F.col("load_id").isNotNull()).select(F.col("load_id").alias(load_id))
        return None if known.isEmpty() else known

    def settle(self, models: Iterable[str]) -> None:
        """Drop entries of days that no model waits for, if there are many entries."""
        if not self.exists() or self._entries().limit(MANY).count() < MANY:
            return
        waiting = {day for days in self.open_days(models).values() for day in days}
        listed = [_NO_DAY if d is None else d for d in waiting]
        entries = self._entries()
        last = entries.agg(
            F.lit(COUNTED).alias("entry"),
            F.lit(EVERY).alias("model"),
            F.lit(_NO_DAY).alias("day"),
            F.max("mark").alias("mark"),
            F.max_by("load_id", F.col("load_id").cast("double")).alias("load_id"),
        )
        kept = entries.where((F.col("entry") != COUNTED) & (F.col("day").isin(*listed, EVERY)))
        self.layers.save_table(*_TABLE, kept.withColumn("load_id", F.lit(None).cast("string")).unionByName(last))

    def _entries(self) -> DataFrame:
        return self.layers.table(*_TABLE)

    def _append(self, rows: list[tuple]) -> None:
        if rows:
            self.layers.append(*_TABLE, self.layers.spark.createDataFrame(rows, SCHEMA).coalesce(1))
