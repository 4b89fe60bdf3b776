"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# Joins carry no broadcast hints. A side is broadcast only when its size, as known
# to Catalyst from file statistics or to AQE from a finished shuffle, is below this.
BROADCAST_LIMIT = 64 * MIB

DEFAULTS: Mapping[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
    "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT),
    # Parquet on disk is smaller than in memory; estimate sizes on the careful side.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.files.maxPartitionBytes": str(128 * MIB),
    # Lost executors cost reruns of their tasks and stages, not the job.
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "10",
    "spark.ui.enabled": "false",
}

# Tasks per stage beyond which the pairs of map and reduce tasks weigh more than the
# data; larger inputs get larger tasks, which sort with spilling.
MAX_TASKS = 32768
TASK_BYTES = 256 * MIB


# How tables are written: small row groups, so that a file of any size is read by many tasks. Keys and
# times give up their dictionary early, since most of the time of a job goes into writing columns.
STORED: Mapping[str, str] = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
    "parquet.dictionary.page.size": str(MIB // 16),
    "parquet.block.size": str(32 * MIB),
}


def sized_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Split size and number of shuffle partitions for an input of the given size.

    AQE merges partitions that turn out small, but splits only those of joins and of
    rebalanced writes, so the number must be right for the largest shuffle: about
    256 MiB a task, two tasks a core at least, and from 8 TiB on ever larger tasks.
    """
    tasks = max(2 * cores, min(MAX_TASKS, -(-input_bytes // TASK_BYTES)))
    split = max(128 * MIB, -(-input_bytes // MAX_TASKS))
    return {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


# Rows of stored tables take several times their size on disk when a task sorts them.
SORTED_SPLIT = 32 * MIB


def size_session(spark: SparkSession, input_bytes: int) -> None:
    """Give a session of default size the tasks that an input asks for.

    Split and number of shuffle partitions only ever go towards smaller tasks: what the session
    has already is kept if its tasks are smaller, and an input of a few tasks changes nothing.
    """
    if input_bytes <= TASK_BYTES * spark.sparkContext.defaultParallelism:
        return
    partitions, split = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    wanted = int(sized_for(input_bytes, spark.sparkContext.defaultParallelism)[partitions])
    if int(spark.conf.get(partitions)) < wanted:
        spark.conf.set(partitions, str(wanted))
    # The setting may carry a unit, which Spark reads.
    set_split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(split))
    if set_split > SORTED_SPLIT:
        spark.conf.set(split, str(SORTED_SPLIT))


def build_session(
    app_name: str = "flightloom",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path under the shared folder named by ``spark.checkpoint.dir``.

    Without that setting a temporary folder serves local sessions; on a cluster,
    where executors would not see it, this raises instead.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = context.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="flightloom-")
        base = _local_scratch[app]
    return f"{base.rstrip('/')}/flightloom-{context.applicationId}/{label}-{uuid.uuid4().hex[:8]}"


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Apply settings around an action and put the former values back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
