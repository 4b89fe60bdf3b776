"""The corpus pipeline: documents in, a mix of clean, distinct documents out.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents. Rows with null
text are kept as empty documents, null doc_ids are no duplicates of named ones unless their
texts are, further columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.llm import decontamination, mixing, pii, simhash, toxicity
from flightloom.llm.common import document_key, free_name, join_counted, read, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score as not toxic."""
    return toxicity.reject(docs, read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest doc_id."""
    return simhash.one_of_each_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that benchmark windows do not contaminate."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced in their texts; n_chars follows the text."""
    cleaned = pii.sanitise(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))
    return cleaned.withColumn("n_chars", chars)


MIXED = ["size", "source_size", "target", "copies", "taken"]


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the copies and words it takes of each.

    Rows that repeat a doc_id and its text (or, without an id, a text) are one document. Columns
    named like those that this stage adds give way to them.
    """
    key = free_name(docs, "mix_key")
    keyed = document_key(docs.drop(*MIXED), key)
    mixed = mixing.mix(keyed.select(F.col(key).alias("doc_id"), "source", "text"))
    taken = stored(
        mixed.where(F.col("copies") > 0).select(
            F.col("doc_id").alias(key), *MIXED[:-1], (F.col("copies") * F.col("size")).alias("taken")
        ),
        "mix-taken",
    )
    return join_counted(keyed, taken, [key]).drop(key)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
]

#: Learned scores, hashed fingerprints and random rounding have no SQL form; tests hold the
#: stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
