from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


@pytest.fixture(scope="session")
def documents(spark: SparkSession) -> list:
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()


LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark: SparkSession) -> DataFrame:
    """Nulls, empty and long texts, repeated rows and ids, columns with clashing names."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, LONG, "en", "a", len(LONG)),
        (3, LONG, "en", "a", len(LONG)),
        (4, "The Words of é ñ 漢字 and 1 more", "en", None, 9),
        (4, "another text under the same id", "fr", "b", 9),
        (None, "a text without an id, mail me@example.org", None, "b", 9),
        (None, None, None, None, None),
        (5, " \t\n ", "de", "b", 4),
        (6, "a text without an id, mail me@example.org", "en", "c", 9),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("size", "target", "copies", "taken", "spans", "text_hash", "score", "fp", "k", "held_out", "number", "mix_key"):
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


@pytest.fixture(scope="session")
def no_docs(odd_docs: DataFrame) -> DataFrame:
    return odd_docs.where("false")
