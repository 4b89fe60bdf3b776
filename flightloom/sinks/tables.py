"""Tables by layer: full refresh, full reload, keyed merge and partition replacement.

Parquet tables have no row-level update, so every change is a new set of files that
replaces whole tables or whole partitions. Both are built aside first, and what is
complete carries a name that says so: whoever writes the table next finishes a swap that
was cut short. A task or executor that is lost is simply rerun.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from copy import copy
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightloom import files
from flightloom.operators.dedup import latest_per_key
from flightloom.operators.merge import FLAGS, merged_news
from flightloom.session import SORTED_SPLIT, STORED, scratch_dir, session_conf

SCHEMAS = ("raw", "staging", "marts", "snapshots", "quality")

# Partitions are found from the folders, so a table can be renamed with all of them.
PARTITIONS_FROM_FOLDERS = {"spark.sql.hive.manageFilesourcePartitions": "false"}

# A batch that touches more partitions than this has too fine a partition column.
MOST_PARTITIONS = 100_000


class UnknownColumns(ValueError):
    """A batch has columns that its table does not have."""


class Layers:
    """The schemas of one environment. A model's schema name is used as it is given.

    ``environment`` keeps environments apart inside one catalog by a prefix on every
    schema; ``location`` is the folder that holds the tables (default: the warehouse).
    """

    # Environments of one session share its settings.
    _settings = Lock()

    def __init__(
        self, spark: SparkSession, location: str | None = None, environment: str = ""
    ) -> None:
        self.spark = spark
        self.prefix = f"{environment}_" if environment else ""
        for schema in SCHEMAS:
            place = f" LOCATION '{location}/{schema}'" if location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{schema}{place}")

    def in_session(self, spark: SparkSession) -> Layers:
        """The same tables, used through another session of the application."""
        other = copy(self)
        other.spark = spark
        return other

    def name(self, schema: str, model: str) -> str:
        return f"{self.prefix}{schema}.{model}"

    def exists(self, schema: str, model: str) -> bool:
        return self.spark.catalog.tableExists(self.name(schema, model))

    def table(self, schema: str, model: str) -> DataFrame:
        """The table as it is stored now, whichever session last wrote it."""
        name = self.name(schema, model)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def view_name(self, schema: str, model: str) -> str:
        return f"{self.prefix}{schema}__{model}"

    def save_view(self, schema: str, model: str, df: DataFrame) -> DataFrame:
        """Register a lazy view of this environment and schema; readers inline it."""
        df.createOrReplaceTempView(self.view_name(schema, model))
        return self.spark.table(self.view_name(schema, model))

    def save_table(
        self, schema: str, model: str, df: DataFrame, partition_by: str | None = None
    ) -> int:
        """Replace the table by the frame and return the number of rows written.

        The new table is written under a build name and swapped in when complete, so
        readers keep the old one until then and the frame may read it. A swap that stops
        half way is finished by ``recover``.
        """
        self.recover(schema, model)
        build = self._build_name(schema, model)
        rows = self._write(build, df, partition_by)
        self._rename(build, self._ready(schema, model))
        self.recover(schema, model)
        return rows

    def recover(self, schema: str, model: str) -> None:
        """Finish a swap or a replacement of partitions that was cut short."""
        target, ready = self.name(schema, model), self._ready(schema, model)
        old = self.name(schema, f"{model}__old")
        there = self.spark.catalog.tableExists
        if there(ready):
            if there(target):
                self.spark.sql(f"DROP TABLE IF EXISTS {old}")
                self._rename(target, old)
            self._rename(ready, target)
        if there(old):
            if there(target):
                self.spark.sql(f"DROP TABLE {old}")
            else:
                self._rename(old, target)
        self.finish_replacement(schema, model)

    def append(self, schema: str, model: str, df: DataFrame) -> None:
        df.write.mode("append").format("parquet").saveAsTable(self.name(schema, model))

    def merge(
        self,
        schema: str,
        model: str,
        batch: DataFrame,
        keys: Sequence[str],
        recency: str,
        partition_by: str,
        announce: Callable[[list[str | None], str | None], None] | None = None,
    ) -> list[str | None]:
        """Upsert a batch and return the partitions whose content it changes, as text.

        The partition column must follow from the key, so a key never moves; only
        partitions that the batch touches are listed and read, and only those in which a row
        is new, changed or more recent are replaced. A row that differs from the stored one
        by its recency alone is written, but changes nothing that models see. The batch is
        computed once, into the shared folder, and meets the stored rows in one shuffle,
        into another; partitions that the table lacks are only written. A batch may lack columns of the table
        (they are null); columns that the table lacks are refused.

        ``announce`` is told the changed partitions and the highest recency before the table
        changes (for a new table, which nothing is built on yet, after it is there).
        """
        self.recover(schema, model)
        if not self.exists(schema, model):
            self.save_table(schema, model, latest_per_key(batch, keys, recency), partition_by)
            named = files.folders(self.spark, self.location(schema, model))
            values = [files.partition_value(f) for f in named if f.startswith(f"{partition_by}=")]
            if announce:
                newest = self.table(schema, model).agg(F.max(recency)).first()[0]
                announce(values, newest)
            return values
        declared = self._schema(schema, model)
        refuse_unknown(batch, declared, self.name(schema, model))
        place = scratch_dir(self.spark, f"batch-{model}")
        latest_per_key(batch, keys, recency).write.options(**STORED).parquet(place)
        staged = self.spark.read.schema(batch.schema).parquet(place)
        part = F.col(partition_by).cast("string")
        of_part = staged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.max(recency).alias("newest"))
        given = {row["part"]: row for row in of_part.limit(MOST_PARTITIONS + 1).collect()}
        if len(given) > MOST_PARTITIONS:
            raise ValueError(f"{partition_by}: a batch of more than {MOST_PARTITIONS} partitions")

        def only(values: Sequence[str | None]) -> DataFrame:
            if len(values) == len(given):
                return staged
            known = F.coalesce(part, F.lit(files.NULL_PARTITION))
            return staged.filter(known.isin(*[files.NULL_PARTITION if v is None else v for v in values]))

        # Nothing is stored of a partition that the table lacks: its rows go in as they are.
        there = self._partition_sizes(schema, model, partition_by, set(given))
        met, fresh = [v for v in given if v in there], [v for v in given if v not in there]
        written, changed = list(fresh), list(fresh)
        merged = only(fresh).hint("rebalance", F.col(partition_by)) if fresh else None
        aside = scratch_dir(self.spark, f"merged-{model}")
        if met:
            a_row = files.size(self.spark, place) / max(1, sum(row["rows"] for row in given.values()))
            largest = max(there[v] + a_row * given[v]["rows"] for v in met)
            rows = merged_news(
                self.partitions(schema, model, partition_by, met),
                only(met),
                keys,
                recency,
                partition_by,
                buckets=1 + int(largest // SORTED_SPLIT),
            )
            typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in declared.fields], *FLAGS)
            typed.write.options(**STORED).partitionBy(partition_by).parquet(aside)
            flagged = T.StructType([*declared.fields, *[T.StructField(f, T.BooleanType()) for f in FLAGS]])
            both = self.spark.read.schema(flagged).parquet(aside)
            news = both.groupBy(part.alias("part")).agg(*[F.bool_or(f).alias(f) for f in FLAGS]).where(FLAGS[0]).collect()
            written += [row["part"] for row in news]
            changed += [row["part"] for row in news if row[FLAGS[1]]]
            if news:
                paths = files.partition_paths(self.spark, aside, partition_by, {row["part"] for row in news})
                replaced = self.spark.read.schema(flagged).option("basePath", aside).parquet(*paths).select(*declared.names)
                merged = replaced if merged is None else replaced.unionByName(merged, allowMissingColumns=True)
        if written:
            if announce:
                newest = [given[w]["newest"] for w in written if given[w]["newest"] is not None]
                announce(changed, max(newest, default=None))
            self.replace_partitions(schema, model, merged, partition_by, gathered=True)
        files.remove(self.spark, aside)
        files.remove(self.spark, place)
        return changed

    def _partition_sizes(
        self, schema: str, model: str, partition_by: str, values: set[str | None]
    ) -> dict[str | None, int]:
        """Bytes of those of the given partitions that a table has."""
        paths = files.partition_paths(self.spark, self.location(schema, model), partition_by, values)
        return {files.partition_value(p.rpartition("/")[2]): files.size(self.spark, p) for p in paths}

    def partitions(
        self, schema: str, model: str, partition_by: str, values: Iterable[str | None]
    ) -> DataFrame:
        """Rows of the given partitions. No other partition's files are listed."""
        declared, root, wanted = self._schema(schema, model), self.location(schema, model), set(values)
        paths = files.partition_paths(self.spark, root, partition_by, wanted)
        if not paths:
            return self.spark.createDataFrame([], declared)
        return self.spark.read.schema(declared).option("basePath", root).parquet(*paths).select(*declared.names)

    def replace_partitions(
        self,
        schema: str,
        model: str,
        df: DataFrame,
        partition_by: str,
        cleared: Sequence[str] = (),
        gathered: bool = False,
    ) -> int:
        """Replace the partitions found in the frame, which may read the table itself.

        Returns the number of rows written.

        ``cleared`` names partitions that go even if the frame has no row of them. The new
        partitions are first written to a folder aside. Once that is complete it gets the
        name that settles the outcome: its files are then moved in, partition by
        partition, now or by the next call. ``gathered`` rows lie by partition already.
        """
        self.recover(schema, model)
        if not self.exists(schema, model):
            return self.save_table(schema, model, df, partition_by)
        declared = self._schema(schema, model)
        refuse_unknown(df, declared, self.name(schema, model))
        root = self.location(schema, model)
        build = f"{root}__build_{uuid.uuid4().hex[:8]}"
        typed = df.select(*[F.col(f.name).cast(f.dataType) for f in declared.fields])
        written = Observation()
        rows = typed if gathered else typed.hint("rebalance", F.col(partition_by))
        counted = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.options(**STORED).partitionBy(partition_by).parquet(build)
        for value in cleared:
            files.make(self.spark, f"{build}/{partition_by}={value}")
        files.move(self.spark, build, f"{root}__pending")
        self.finish_replacement(schema, model)
        return written.get["rows"]

    def finish_replacement(self, schema: str, model: str) -> None:
        """Move in pending partitions, if there are any."""
        if not self.exists(schema, model):
            return
        root = self.location(schema, model)
        pending = f"{root}__pending"
        if not files.exists(self.spark, pending):
            return
        for folder in files.folders(self.spark, pending):
            files.remove(self.spark, f"{root}/{folder}")
            files.move(self.spark, f"{pending}/{folder}", f"{root}/{folder}")
        files.remove(self.spark, pending)
        self.spark.catalog.refreshTable(self.name(schema, model))

    def location(self, schema: str, model: str) -> str:
        """The folder of a table, from the catalog alone."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(schema, model)}")
        return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")

    def _schema(self, schema: str, model: str) -> T.StructType:
        """The columns of a table, from the catalog alone: its files are not listed."""
        columns = self.spark.catalog.listColumns(self.name(schema, model))
        return T.StructType.fromDDL(", ".join(f"`{c.name}` {c.dataType}" for c in columns))

    def _ready(self, schema: str, model: str) -> str:
        return self.name(schema, f"{model}__ready")

    def _rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {old} RENAME TO {new}")

    def drop_environment(self) -> None:
        for schema in SCHEMAS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.prefix}{schema} CASCADE")

    def _build_name(self, schema: str, model: str) -> str:
        """A new name each time, so what a broken run left in its folder is in no one's way."""
        return self.name(schema, f"{model}__build_{uuid.uuid4().hex[:8]}")

    def _write(self, table: str, df: DataFrame, partition_by: str | None) -> int:
        written = Observation()
        count = F.count(F.lit(1)).alias("rows")
        if partition_by is None:
            df.observe(written, count).write.options(**STORED).format("parquet").saveAsTable(table)
        else:
            # Gathers each partition's rows into few files, while AQE splits a partition
            # that outgrows the advisory size over several tasks. Rows are counted above the
            # shuffle, where each is written: map tasks that rerun are not counted again.
            gathered = df.hint("rebalance", F.col(partition_by)).observe(written, count)
            writer = gathered.write.options(**STORED).format("parquet").partitionBy(partition_by)
            with self._settings, session_conf(self.spark, PARTITIONS_FROM_FOLDERS):
                writer.saveAsTable(table)
        return written.get["rows"]


def refuse_unknown(df: DataFrame, declared: T.StructType, table: str) -> None:
    known = {name.lower() for name in declared.names}
    unknown = [c for c in df.columns if c.lower() not in known]
    if unknown:
        raise UnknownColumns(f"{table} has no column {', '.join(unknown)}")
