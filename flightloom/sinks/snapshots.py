"""Tables as numbered snapshots, with batches stored beside the rows they change.

A snapshot is one small listing of the folders that make up the table. Folders are never moved
or changed; a new state of the table is new folders and the next listing, which appears by the
rename of one file. A reader that has opened a snapshot keeps it, one that opens the table at
any step of a write sees the state before or after it, and nothing is left to finish when a
writer is lost: its folders are in no listing, and ``expire`` removes them. So stores on which
renaming a folder means copying it serve as well.

A batch is written as it is, one folder with the partitions it touches (a *delta*). Reading
ranks the rows of partitions that have deltas, by key and recency; the others are read as
stored, without a shuffle. ``compact`` rewrites partitions with many deltas.

Writers take turns: of two that start from the same snapshot the second is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightloom import files
from flightloom.operators.dedup import latest_per_key
from flightloom.operators.merge import news
from flightloom.session import STORED
from flightloom.sinks.tables import refuse_unknown

#: Deltas of a partition up to which ``compact`` leaves it alone.
MOST_DELTAS = 8


@dataclass(frozen=True)
class Snapshot:
    """A state of the table: per partition (as its folder is named) the batches that hold its rows."""

    number: int
    columns: T.StructType
    parts: dict[str, tuple[str, ...]]

    def to_json(self) -> str:
        return json.dumps({"columns": self.columns.jsonValue(), "parts": self.parts})

    @staticmethod
    def from_json(number: int, text: str) -> Snapshot:
        held = json.loads(text)
        parts = {part: tuple(batches) for part, batches in held["parts"].items()}
        return Snapshot(number, T.StructType.fromJson(held["columns"]), parts)


class SnapshotTable:
    """A keyed table under ``root``. The partition column must follow from the key."""

    def __init__(
        self, spark: SparkSession, root: str, keys: Sequence[str], recency: str, partition_by: str
    ) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.recency, self.partition_by = list(keys), recency, partition_by

    # --- reading -------------------------------------------------------------------

    def numbers(self) -> list[int]:
        """The snapshots that can be read, oldest first."""
        listed = files.names(self.spark, f"{self.root}/snapshots")
        return sorted(int(n.removesuffix(".json")) for n in listed if n.endswith(".json"))

    def snapshot(self, number: int | None = None) -> Snapshot | None:
        """A snapshot, by default the newest one; None if nothing was ever written."""
        if number is None:
            there = self.numbers()
            if not there:
                return None
            number = there[-1]
        return Snapshot.from_json(number, files.content(self.spark, self._listing(number)))

    def read(self, number: int | None = None, values: Iterable[str | None] | None = None) -> DataFrame:
        """One row per key: the most recent of all batches; ``values`` names the partitions wanted.

        Other partitions' folders are not listed. Ties are settled as in ``merge_rows``, so
        neither the order of batches nor compaction changes the rows.
        """
        state = self.snapshot(number)
        if state is None:
            raise LookupError(f"{self.root} holds no table")
        parts = state.parts
        if values is not None:
            wanted = set(values)
            parts = {p: b for p, b in parts.items() if files.partition_value(p) in wanted}
        return self._rows(state, parts)

    def _rows(self, state: Snapshot, parts: dict[str, tuple[str, ...]]) -> DataFrame:
        alone = [(p, b) for p, held in parts.items() if len(held) == 1 for b in held]
        merged = [(p, b) for p, held in parts.items() if len(held) > 1 for b in held]
        frames = []
        if alone:
            frames.append(self._folders(state, alone))
        if merged:
            frames.append(latest_per_key(self._folders(state, merged), self.keys, self.recency))
        if not frames:
            return self.spark.createDataFrame([], state.columns)
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def _folders(self, state: Snapshot, held: list[tuple[str, str]]) -> DataFrame:
        data = f"{self.root}/data"
        paths = [f"{data}/batch={batch}/{part}" for part, batch in held]
        declared = T.StructType([*state.columns.fields, T.StructField("batch", T.StringType())])
        read = self.spark.read.schema(declared).option("basePath", data).parquet(*paths)
        return read.select(*state.columns.names)

    # --- writing -------------------------------------------------------------------

    def replace(self, df: DataFrame) -> Snapshot:
        """The whole table anew; its columns are those of the frame. The frame may read the table."""
        before = self.snapshot()
        batch = self._write(latest_per_key(df, self.keys, self.recency))
        parts = {part: (batch,) for part in self._written(batch)}
        return self._commit(before, df.schema, parts)

    def write(self, df: DataFrame, only_changes: bool = True) -> Snapshot:
        """Upsert a batch as a delta: no stored row is written again.

        With ``only_changes`` the rows of the partitions that the batch touches are read, rows
        that change nothing are left out, and a batch of such rows alone makes no snapshot.
        Without, nothing stored is read, and what is repeated waits for compaction. Columns that
        the batch lacks are null; columns that the table lacks are refused.
        """
        before = self.snapshot()
        if before is None:
            return self.replace(df)
        refuse_unknown(df, before.columns, self.root)
        given = {c.lower() for c in df.columns}
        typed = df.select(
            *[
                (F.col(f.name) if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in before.columns.fields
            ]
        )
        batch = self._write(latest_per_key(typed, self.keys, self.recency))
        touched = self._written(batch)
        if only_changes and touched:
            staged = self._folders(before, [(part, batch) for part in touched])
            held = [(p, b) for p in touched for b in before.parts.get(p, ())]
            if held:
                staged = news(staged, self._folders(before, held), self.keys, self.recency)
            aside = batch
            batch = self._write(staged)
            touched = self._written(batch)
            files.remove(self.spark, self._data(aside))
        if not touched:
            files.remove(self.spark, self._data(batch))
            return before
        parts = dict(before.parts)
        for part in touched:
            parts[part] = (*parts.get(part, ()), batch)
        return self._commit(before, before.columns, parts)

    def compact(self, most: int = MOST_DELTAS) -> Snapshot | None:
        """Write partitions with more than ``most`` deltas as one batch; the rows stay the same."""
        before = self.snapshot()
        if before is None:
            return None
        crowded = {p: b for p, b in before.parts.items() if len(b) > most + 1}
        if not crowded:
            return before
        batch = self._write(self._rows(before, crowded))
        return self._commit(before, before.columns, {**before.parts, **{p: (batch,) for p in crowded}})

    def expire(self, keep: int = 2) -> list[int]:
        """Forget all but the newest snapshots and remove folders that none of the kept ones lists.

        Not while a writer is at work, whose folders no snapshot lists yet. Returns the
        numbers that went.
        """
        there = self.numbers()
        gone, kept = there[: -max(1, keep)], there[-max(1, keep) :]
        for number in gone:
            files.remove(self.spark, self._listing(number))
        used = {b for n in kept for held in self.snapshot(n).parts.values() for b in held}
        for folder in files.folders(self.spark, f"{self.root}/data"):
            if folder.removeprefix("batch=") not in used:
                files.remove(self.spark, f"{self.root}/data/{folder}")
        return gone

    def _write(self, df: DataFrame) -> str:
        batch = uuid.uuid4().hex
        gathered = df.hint("rebalance", F.col(self.partition_by))
        gathered.write.options(**STORED).partitionBy(self.partition_by).parquet(self._data(batch))
        return batch

    def _written(self, batch: str) -> list[str]:
        listed = files.folders(self.spark, self._data(batch))
        return [f for f in listed if f.startswith(f"{self.partition_by}=")]

    def _commit(self, before: Snapshot | None, columns: T.StructType, parts: dict[str, tuple[str, ...]]) -> Snapshot:
        made = Snapshot(before.number + 1 if before else 1, columns, parts)
        files.publish(self.spark, self._listing(made.number), made.to_json())
        return made

    def _data(self, batch: str) -> str:
        return f"{self.root}/data/batch={batch}"

    def _listing(self, number: int) -> str:
        return f"{self.root}/snapshots/{number:09d}.json"
