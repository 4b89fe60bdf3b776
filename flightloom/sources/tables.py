"""Named tables and ad-hoc SQL over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, statement: str, views: Mapping[str, DataFrame]) -> DataFrame:
    """Result of a SQL statement that names the given frames in braces: ``FROM {flights}``.

    The names live in the statement alone: no view is left behind or replaced. Nothing is
    collected here: the caller gets a lazy frame, not a local copy.
    """
    return spark.sql(statement, **views)
