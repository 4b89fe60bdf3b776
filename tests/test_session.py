from __future__ import annotations

import pytest

from flightloom import session
from flightloom.session import MIB, scratch_dir, session_conf, sized_for

TIB = 1024 * 1024 * MIB


@pytest.mark.parametrize(
    ("size", "cores", "tasks", "split"),
    [
        (10 * MIB, 8, 16, 128 * MIB),
        (1 * TIB, 800, 4096, 128 * MIB),
        (8 * TIB, 800, 32768, 256 * MIB),
        (100 * TIB, 8000, 32768, 3200 * MIB),
    ],
)
def test_tasks_grow_in_number_then_in_size(size, cores, tasks, split):
    assert sized_for(size, cores) == {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def test_scratch_is_in_the_shared_folder_and_new_each_time(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two
    assert one.startswith(f"{shared}/flightloom-")


def test_cluster_without_a_shared_folder_is_refused():
    class Context:
        master, applicationId = "yarn", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session(), "x")


def test_settings_are_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), session_conf(spark, {key: "3"}):
        assert spark.conf.get(key) == "3"
        1 / 0  # noqa: B018
    assert spark.conf.get(key) == before


def test_a_session_is_sized_for_a_large_input_only(spark):
    partitions, split = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    with session_conf(spark, {partitions: "8", split: "128MB"}):
        session.size_session(spark, 100 * MIB)
        assert (spark.conf.get(partitions), spark.conf.get(split)) == ("8", "128MB")
        session.size_session(spark, 10_000 * MIB)
        assert (int(spark.conf.get(partitions)), int(spark.conf.get(split))) == (40, 32 * MIB)
        spark.conf.set(partitions, "211")
        session.size_session(spark, 10_000 * MIB)
        assert spark.conf.get(partitions) == "211"
