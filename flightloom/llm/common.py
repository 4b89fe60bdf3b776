"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightloom.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Rows up to which a counted table may be broadcast (short rows, some 100 bytes each).
BROADCAST_ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lowered(text: Column) -> Column:
    """A-Z in lower case; letters beyond ASCII stay as they are."""
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written as a table in the shared folder and read again.

    Cuts the lineage: a lost executor costs no work done before this point.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def nullable_key(column: Column) -> Column:
    """A non-null text key that keeps null apart from every text."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def join_counted(
    large: DataFrame, small: DataFrame, on: list[str], how: str = "inner", rows: int | None = None
) -> DataFrame:
    """Join a table whose rows are counted first.

    Up to BROADCAST_ROWS rows it is broadcast; beyond, both sides are shuffled and AQE
    splits hot keys.
    """
    n = small.count() if rows is None else rows
    return large.join(F.broadcast(small) if n <= BROADCAST_ROWS else small, on, how)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_row_each(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each value of the keys, which are not null. Rows are only shuffled if a value is
    repeated; of its rows the one with the smallest hash over all columns stays."""
    repeated = stored(
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1).select(*keys), "repeated"
    )
    n = repeated.count()
    if n == 0:
        return df
    alone = join_counted(df, repeated, list(keys), "left_anti", n)
    place = free_name(df, "place")
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(*df.columns))
    first = join_counted(df, repeated, list(keys), "left_semi", n).withColumn(place, F.row_number().over(order))
    return alone.select(*df.columns).unionByName(first.where(F.col(place) == 1).select(*df.columns))


def document_key(df: DataFrame, key: str) -> DataFrame:
    """One row for each different (doc_id, text), with a key of its own: doc_id where no other text has
    it, else a hash of both."""
    own, hashed = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")), free_name(df, "text_hash")
    keyed = df.withColumn(key, own).withColumn(hashed, F.xxhash64("text"))
    single = one_row_each(keyed, key, hashed)
    shared = stored(
        single.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1).select(key), "shared-ids"
    )
    n = shared.count()
    if n == 0:
        return single.drop(hashed)
    alone = join_counted(single, shared, [key], "left_anti", n)
    others = join_counted(single, shared, [key], "left_semi", n).withColumn(key, F.xxhash64(key, hashed))
    return alone.unionByName(others).drop(hashed)
