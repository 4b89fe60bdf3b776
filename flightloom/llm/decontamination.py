"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of ``WINDOW`` consecutive words (a shorter item is one window). A
window is contained in a document if the document has all its words in a row. Each window is
the set of its shingles of ``SHINGLE`` words; containment asks for all of them, so a prefix of
one shingle is enough to join on, and the rarest is the cheapest: shingles are ordered by how
often documents have them, and each window waits at its rarest one only.

    1. one pass over the documents: the positions that begin some item shingle, with the words
       around them (as many as a window may reach), and the number of words of every document
    2. frequency of item shingles among them: the order by rarity
    3. join on each window's rarest shingle
    4. bounds: the window must begin at or after the document's first word and end before its
       last (position and length)
    5. verify the window word for word over its length

Steps 2 to 5 read what the first has stored. Item shingles are broadcast up to BROADCAST_ROWS
of them and shuffled beyond. The union of hits gives the positions of a document that are hit.

Defined results: null or wordless texts have no words and no hits; an item without words
contains no window. Repeated document rows give a row each. Items with the same text are items
of their own; item ids are sorted as strings. A null item_id is no item. Only text and id
columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import BROADCAST_ROWS, free_name, join_counted, lowered, nullable_key, stored

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 3
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; an empty array for null."""
    pieces = F.split(F.coalesce(lowered(text), F.lit("")), NOT_A_WORD)
    return F.array_remove(pieces, "")


def _document(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, words: equal rows have equal results, so their key is this pair."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        words(F.col("text")).alias("words"),
    )


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, window (its words) for every window of every item."""
    cut = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")
    ).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return cut.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, window))).alias("window"))


def _shingles_of_size(of: Column, size: int) -> Column:
    """(at, shingle) for each position where ``size`` words begin; sizes have hashes of their own."""
    hashes = F.transform(
        of,
        lambda w, i: F.struct(
            i.alias("at"), F.xxhash64(F.lit(size), w, *[F.get(of, i + j) for j in range(1, size)]).alias("shingle")
        ),
    )
    return F.slice(hashes, F.lit(1), F.greatest(F.size(of) - size + 1, F.lit(0)))


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """window_id, window, n, offset, shingle: every shingle of every window."""
    sized = windows.withColumn("n", F.size("window"))
    cut = F.when(F.col("n") >= shingle, _shingles_of_size(F.col("window"), shingle))
    for size in range(shingle - 1, 0, -1):
        cut = cut.when(F.col("n") == size, _shingles_of_size(F.col("window"), size))
    return sized.select("window_id", "window", "n", F.explode(cut).alias("s")).select(
        "window_id", "window", "n", F.col("s.at").alias("offset"), "s.shingle"
    )


def positions(docs: DataFrame, shingles: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """Of every document one row with at = -1, and one for each position at which a wanted shingle
    begins: doc_id, text_hash, n_words, at, shingle, and the words ``around`` it, ``lead`` of them before.

    The only pass over the texts. Windows that hold the shingle lie within the words around.
    """
    words_ = F.col("words")
    first = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).cast("long").alias("shingle")))
    all_of = F.concat(first, *[_shingles_of_size(words_, size) for size in sizes])
    exploded = _document(docs).select("doc_id", "text_hash", "words", F.explode(all_of).alias("s"))
    lead = F.least(F.greatest(F.col("s.at"), F.lit(0)), F.lit(window - 1))
    around = F.when(F.col("s.at") >= 0, F.slice("words", F.col("s.at") - lead + 1, lead + window))
    met = ["doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), "s.at", "s.shingle"]
    met += [lead.alias("lead"), around.alias("around")]
    wanted = shingles.select("shingle").distinct().unionAll(shingles.sparkSession.range(1).select(F.col("id").alias("shingle")))
    wanted = stored(wanted.distinct(), "decontamination-wanted")
    n = wanted.count()
    if n <= BROADCAST_ROWS:
        held = exploded.withColumn("shingle", F.col("s.shingle"))
        return held.join(F.broadcast(wanted), "shingle", "left_semi").select(*met)
    # Beyond the bound rows are shuffled, and must not carry whole texts.
    return exploded.select(*met).join(wanted, "shingle", "left_semi")


def window_hits(found: DataFrame, shingles: DataFrame) -> DataFrame:
    """doc_id, text_hash, start, window_id, n per occurrence of a window, from ``positions``."""
    at = found.where(F.col("at") >= 0)
    # Rarity: how often the documents have each shingle of a window.
    frequency = stored(at.groupBy("shingle").agg(F.count(F.lit(1)).alias("f")), "decontamination-rarity")
    # A window with a shingle that no document has occurs nowhere.
    ranked = (
        join_counted(shingles, frequency, ["shingle"], "left")
        .groupBy("window_id", "window", "n")
        .agg(F.min(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "offset", "shingle")).alias("rarest"))
    )
    prefix = stored(
        ranked.where(F.col("rarest.f") > 0).select("window_id", "window", "n", "rarest.offset", "rarest.shingle"),
        "decontamination-prefix",
    )
    start = F.col("at") - F.col("offset")
    met = join_counted(at, prefix, ["shingle"]).where(
        (start >= 0)
        & (start + F.col("n") <= F.col("n_words"))
        & (F.slice("around", F.greatest(F.col("lead") - F.col("offset"), F.lit(0)) + 1, F.col("n")) == F.col("window"))
    )
    return met.select("doc_id", "text_hash", start.alias("start"), "window_id", "n")


def _covered(intervals: Column) -> Column:
    """Positions covered by sorted (start, end) intervals."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))

    def add(state: Column, x: Column) -> Column:
        more = F.greatest(x["end"] - F.greatest(x["start"], state["end"]), F.lit(0))
        return F.struct(F.greatest(state["end"], x["end"]).alias("end"), (state["total"] + more).alias("total"))

    return F.aggregate(intervals, zero, add)["total"]


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, one_in: int = ONE_IN
) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, item_ids, contaminated per row of (doc_id, text)."""
    labelled = stored(
        item_windows(items, window).withColumn(
            "window_id", F.sha2(F.concat_ws(" ", "window"), 256)
        ),
        "decontamination-windows",
    )
    windows = labelled.select("window_id", "window").distinct()
    shingles = stored(window_shingles(windows, shingle), "decontamination-shingles")
    sizes = shingles.select(F.least("n", F.lit(shingle)).alias("size")).distinct()
    found_at = stored(
        positions(docs, shingles, sorted(r["size"] for r in sizes.collect()), window), "decontamination-positions"
    )
    hits = stored(window_hits(found_at, shingles), "decontamination-hits")
    key = ["doc_id", "text_hash"]
    # Null ids must meet in joins, so they get a key of their own.
    hits = hits.withColumn("k", nullable_key(F.col("doc_id")))
    spans = hits.groupBy("k", "text_hash").agg(
        _covered(
            F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end"))))
        ).alias("n_hit")
    )
    ids = (
        join_counted(
            hits.select("k", "text_hash", "window_id").distinct(),
            labelled.select("window_id", "item_id").distinct(),
            ["window_id"],
        )
        .groupBy("k", "text_hash")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    found = spans.join(ids, ["k", "text_hash"])
    counted = found_at.where(F.col("at") == -1).select(*key, nullable_key(F.col("doc_id")).alias("k"), "n_words")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return counted.join(found, ["k", "text_hash"], "left").select(
        *key,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    bad = decontaminate(docs, items).where("contaminated").select("doc_id", "text_hash").distinct()
    bad = stored(bad.withColumn("k", nullable_key(F.col("doc_id"))).select("k", "text_hash"), "decontamination-bad")
    hashed, key = free_name(docs, "text_hash"), free_name(docs, "doc_key")
    keyed = docs.withColumn(hashed, F.xxhash64("text")).withColumn(key, nullable_key(F.col("doc_id").cast("long")))
    left = bad.select(F.col("k").alias(key), F.col("text_hash").alias(hashed))
    return join_counted(keyed, left, [key, hashed], "left_anti").drop(key, hashed)
