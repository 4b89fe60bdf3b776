"""Keyed merge of a batch into existing rows."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.functions import descending
from flightloom.operators.dedup import latest_per_key

# Columns by which ``merged_news`` says what a batch does to a row.
FLAGS = ("__written", "__changed")


def merge_rows(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], recency: str
) -> DataFrame:
    """One row per key of both: the most recent, whichever side it is on.

    Stored and incoming rows are ranked together, by recency and then by all other columns,
    so neither the order of batches nor how rows are cut into batches changes the result:
    an older load never replaces a newer one. Null is a key value like any other. Columns
    that the batch lacks are null.
    """
    return latest_per_key(existing.unionByName(batch, allowMissingColumns=True), keys, recency)


def changes(batch: DataFrame, existing: DataFrame, keys: Sequence[str], recency: str) -> DataFrame:
    """The batch, one row per key, with ``written`` and ``changed``: what each row does to the table.

    A row changes the table if its key is new, or if it differs from the stored row outside
    ``recency`` and is not less recent. It is also written if only its recency is higher. One
    left join by key with the stored rows. Columns that the batch lacks count as null.
    """
    others = [c for c in existing.columns if c not in (*keys, recency)]
    stored = existing.select(
        F.struct(*keys).alias("__key"), F.struct(recency, *others).alias("__old")
    )
    mine, theirs = F.col(recency), F.col(f"__old.{recency}")
    there = F.col("__old").isNotNull()
    given = {c.lower() for c in batch.columns}
    equal = [
        F.col(f"__old.{c}").eqNullSafe(F.col(c) if c.lower() in given else F.lit(None)) for c in others
    ]
    same = reduce(and_, equal, F.lit(True))
    matches = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__key.{k}")) for k in keys])
    changed = ~there | (~same & ~_later(theirs, mine))
    return batch.join(stored, matches, "left").select(
        *batch.columns,
        (changed | _later(mine, theirs)).alias("written"),
        changed.alias("changed"),
    )


def merged_news(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], recency: str, partition_by: str, buckets: int = 1
) -> DataFrame:
    """``merge_rows`` of sides that hold a key once each, with what ``changes`` says of each row in ``FLAGS``.

    Rows are dealt once, by partition and by ``buckets`` shares of its keys, and stay there: a task
    has whole keys and writes few partitions. The partition column must follow from the key.
    """
    given, bucket, rank, old, new = "__given", "__bucket", "__rank", "__old", "__new"
    rest = [c for c in existing.columns if c not in (*keys, recency)]
    sides = existing.withColumn(given, F.lit(False)).unionByName(
        batch.withColumn(given, F.lit(True)), allowMissingColumns=True
    )
    share = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    dealt = sides.withColumn(bucket, share).repartition(partition_by, bucket)
    of_key = Window.partitionBy(*dict.fromkeys([partition_by, bucket, *keys]))
    ranked = of_key.orderBy(*descending(recency, *rest))
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kept = F.struct(recency, *rest)
    found = dealt.select(
        "*",
        F.row_number().over(ranked).alias(rank),
        F.first(F.when(~F.col(given), kept), ignorenulls=True).over(whole).alias(old),
        F.first(F.when(F.col(given), kept), ignorenulls=True).over(whole).alias(new),
    ).filter(F.col(rank) == 1)
    mine, theirs = F.col(f"{new}.{recency}"), F.col(f"{old}.{recency}")
    same = reduce(and_, [F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in rest], F.lit(True))
    changed = F.col(old).isNull() | (~same & ~_later(theirs, mine))
    there = F.col(new).isNotNull()
    return found.select(
        *existing.columns,
        (there & (changed | _later(mine, theirs))).alias(FLAGS[0]),
        (there & changed).alias(FLAGS[1]),
    )


def news(batch: DataFrame, stored: DataFrame, keys: Sequence[str], recency: str) -> DataFrame:
    """Rows of the batch, one per key, that ``changes`` calls written; both have the same columns.

    The stored side may hold a key several times, once per earlier batch: the most recent of
    these counts. One shuffle of both by key, and no row of a batch is met by more than the
    stored ones of its key.
    """
    others = [c for c in batch.columns if c not in (*keys, recency)]
    given, old = "__given", "__old"
    sides = stored.select(*batch.columns, F.lit(False).alias(given)).union(batch.withColumn(given, F.lit(True)))
    # Stored rows of a key come first, the most recent of them at the head.
    order = [F.col(given).asc(), *descending(recency, *others)]
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    kept = F.when(~F.col(given), F.struct(recency, *others))
    found = sides.withColumn(old, F.first(kept, ignorenulls=True).over(so_far)).filter(given)
    mine, theirs = F.col(recency), F.col(f"{old}.{recency}")
    same = reduce(and_, [F.col(f"{old}.{c}").eqNullSafe(F.col(c)) for c in others], F.lit(True))
    changed = F.col(old).isNull() | (~same & ~_later(theirs, mine))
    return found.filter(changed | _later(mine, theirs)).select(*batch.columns)


def _later(one: Column, other: Column) -> Column:
    """Whether one recency is higher than another, null being the highest."""
    return F.when(other.isNull(), F.lit(False)).otherwise(one.isNull() | (one > other))
