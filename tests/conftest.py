from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from flightloom.session import build_session  # noqa: E402
from flightloom.sinks.tables import Layers  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    session = build_session(
        "flightloom-tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def layers(spark: SparkSession, tmp_path: Path) -> Layers:
    made = Layers(spark, str(tmp_path / "tables"), environment=f"t{abs(hash(str(tmp_path)))}")
    yield made
    made.drop_environment()
