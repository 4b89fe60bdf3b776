"""Data-quality checks. Each returns the offending values; an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAILURES = "n_rows"

# Age of the newest load, in hours, that is late and too late.
WARN_AFTER_HOURS = 25
ERROR_AFTER_HOURS = 49


class ContractViolation(ValueError):
    """A frame does not have the columns or types declared for its table."""


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored.

    Counts combine before the shuffle, so a value with a third of all rows is one
    partial count per task.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias(FAILURES)).filter(F.col(FAILURES) > 1)


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted ones, with their row counts; nulls are ignored."""
    outside = df.filter(~F.col(column).isin(*accepted))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias(FAILURES))


def check_counts(
    df: DataFrame,
    unique: str | None,
    not_null: Sequence[str],
    accepted: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Failures of several checks of one table in one pass: one row, a count per check.

    With a ``unique`` column the row-level counts ride on its grouping, so the frame,
    which may be an expensive view, is computed once. Columns are named ``kind:column``.
    """
    counts = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    for column, values in accepted.items():
        counts[f"accepted_values:{column}"] = F.count_if(~F.col(column).isin(*values))
    row_level = [count.alias(name) for name, count in counts.items()]
    if unique is None:
        return df.agg(*row_level)
    key = "__key"
    per_value = df.groupBy(F.col(unique).alias(key)).agg(
        F.count(F.lit(1)).alias("__rows"), *row_level
    )
    repeated = F.count_if(F.col(key).isNotNull() & (F.col("__rows") > 1))
    return per_value.agg(
        repeated.alias(f"unique:{unique}"), *[F.sum(f"`{n}`").alias(n) for n in counts]
    )


def failure_counts(
    df: DataFrame,
    unique: str | None,
    not_null: Sequence[str],
    accepted: Mapping[str, Sequence[str]],
) -> dict[str, int | None]:
    """The row of :func:`check_counts`, from a grouping by hashes if these tell values apart.

    Equal values have equal hashes, so if no hash is repeated no value is. Only if one is, the
    values themselves are grouped. A hash is a fourth of a surrogate key on its way to its task,
    and goes there alone: the other checks need no shuffle and have a pass of their own.
    """
    if unique is None:
        return check_counts(df, None, not_null, accepted).first().asDict()
    short = "__hash"
    hashed = df.filter(F.col(unique).isNotNull()).select(F.xxhash64(unique).alias(short))
    if check_counts(hashed, short, [], {}).first()[0]:
        return check_counts(df, unique, not_null, accepted).first().asDict()
    others = check_counts(df, None, not_null, accepted).first().asDict() if not_null or accepted else {}
    return {f"unique:{unique}": 0, **others}


def freshness(df: DataFrame, load_id: str, as_of: datetime) -> DataFrame:
    """Age of the newest load at ``as_of`` (UTC) with a pass, warn or error status.

    Load ids are epoch seconds as text, compared as numbers. No load at all is an error.
    """
    now = as_of.replace(tzinfo=as_of.tzinfo or timezone.utc).timestamp()
    newest = df.agg(F.max(F.col(load_id).cast("double")).alias("newest_load"))
    age = F.round((F.lit(now) - F.col("newest_load")) / 3600, 4)
    return newest.select("newest_load", age.alias("age_hours")).withColumn(
        "status", _freshness_status(F.col("age_hours"))
    )


def _freshness_status(age_hours: Column) -> Column:
    return (
        F.when(age_hours.isNull() | (age_hours > ERROR_AFTER_HOURS), "error")
        .when(age_hours > WARN_AFTER_HOURS, "warn")
        .otherwise("pass")
    )


def contract_differences(df: DataFrame, contract: T.StructType) -> list[tuple[str, str, str]]:
    """(column, declared type, found type) wherever they differ; '' stands for absent."""
    declared = {f.name: f.dataType.simpleString() for f in contract.fields}
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [*declared, *(n for n in found if n not in declared)]
    return [
        (n, declared.get(n, ""), found.get(n, ""))
        for n in names
        if declared.get(n) != found.get(n)
    ]


def enforce_contract(df: DataFrame, contract: T.StructType, table: str) -> DataFrame:
    """The frame with its columns in contract order, or an error before anything is written."""
    differences = contract_differences(df, contract)
    if differences:
        listed = "; ".join(
            f"{name}: declared {declared or 'none'}, found {found or 'none'}"
            for name, declared, found in differences
        )
        raise ContractViolation(f"{table}: {listed}")
    return df.select(*contract.names)
