"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be taken target / source_size times. The whole part is
certain; the fraction is rounded by the pivotal method, in words: two documents meet, and mass
moves at random from one to the other, in the direction and amount that keeps both their
expected copies and the sum of their words, until one of the two is taken or left for good.
The other meets the next document.

The meetings form a reduction tree. Documents of a source are dealt by hash into blocks of
about ``block`` documents; each block leaves one open document, and the open ones of many
blocks are dealt into blocks again, until one is left, for which its fraction decides. So a
source's words meet its target to within a document of mean size, and a source with a third of
all rows is as many tasks as its blocks.

Defined results: null text has size 0; a document of size 0 is taken 0 times. A null source is
a source, ordered last. Random numbers are hashes of doc_id, text and the number of the copy, so
reruns agree. Repeated rows are documents of their own; a null doc_id is a document like any
other. However many rows share an id, or the lack of one, they are dealt over all blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.llm.common import join_counted, nullable_key, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that meet in one task.
BLOCK = 256
#: Copies of one row that one task numbers.
COPIES = 1 << 16

_OPEN = "struct<doc_id:bigint,row:bigint,size:bigint,source_size:bigint,target:double,whole:bigint,p:double>"
_DONE = "struct<doc_id:bigint,row:bigint,size:bigint,source_size:bigint,target:double,copies:bigint>"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, text_hash, n: rows that are equal are one, n times."""
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("text_hash"),
    )
    return measured.groupBy(*measured.columns).agg(F.count(F.lit(1)).alias("n"))


def numbered(counted: DataFrame, copies: int = COPIES) -> DataFrame:
    """doc_id, source, size, row: a row for each document of ``sizes``.

    ``row`` tells rows of one doc_id apart: a hash of the text and the number of the copy, below
    zero if doc_id is null. Rows with many copies are numbered by many tasks.
    """
    few = counted.where(F.col("n") <= copies).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / copies)))
    chunks = counted.where(F.col("n") > copies).withColumn("chunk", chunk)
    spread = chunks.repartition("doc_id", "source", "text_hash", "chunk")
    first = F.col("chunk") * copies
    last = F.least(first + copies, F.col("n")) - 1
    many = spread.withColumn("copy", F.explode(F.sequence(first, last))).drop("chunk")
    row = F.pmod(F.xxhash64("text_hash", "copy"), F.lit(2**62))
    signed = F.when(F.col("doc_id").isNull(), -1 - row).otherwise(row)
    return few.unionByName(many).select("doc_id", "source", "size", signed.alias("row"))


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0
) -> DataFrame:
    """source, source_size, n, target per source.

    Sources by code point, null last, weigh ``weights`` in turn. The target is the share of all
    words, at most ``most`` times the source's own; what is cut off is reshared by weight,
    again and again. Its fixed point is min(weight * level, most * size), whose level
    follows from sums over the sources in the order in which they reach their limit.
    """
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    everywhere = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = per_source.withColumn(
        "weight",
        F.element_at(F.array(*map(F.lit, weights)), (place - 1) % len(weights) + 1).cast("double"),
    )
    limited = ranked.withColumn("limit", F.lit(most) * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_limit.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everywhere) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    levels = limited.withColumn("level", level).withColumn("order", F.row_number().over(by_limit))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("order", "level"))
    # Without a fitting level (rounding at the very end) every source stops at its limit.
    common = F.min(fits).over(everywhere)["level"]
    return levels.withColumn("common", common).select(
        "source",
        "source_size",
        "n",
        F.least(F.col("weight") * F.coalesce("common", F.lit(float("inf"))), "limit").alias("target"),
    )


def _uniform(*of: Column) -> Column:
    return F.pmod(F.xxhash64(*of), F.lit(2**40)) / F.lit(float(2**40))


def _done(x: Column, taken: Column) -> Column:
    return F.struct(
        x.doc_id.alias("doc_id"),
        x["row"].alias("row"),
        x["size"].alias("size"),
        x.source_size.alias("source_size"),
        x.target.alias("target"),
        (x.whole + taken).alias("copies"),
    )


def _with_p(x: Column, p: Column) -> Column:
    return F.struct(
        *[x[c].alias(c) for c in ("doc_id", "row", "size", "source_size", "target", "whole")],
        p.alias("p"),
    )


def _meet(state: Column, x: Column) -> Column:
    """The open document ``state.open`` meets ``x``; one of them is decided."""
    a = state.open
    room_a, room_b = (1 - a.p) * a["size"], (1 - x.p) * x["size"]
    mass_a, mass_b = a.p * a["size"], x.p * x["size"]
    up, down = F.least(room_a, mass_b), F.least(mass_a, room_b)
    rises = _uniform(a.doc_id, a["row"], x.doc_id, x["row"], F.lit(17)) * (up + down) < down
    new_a = (
        F.when(rises & (room_a <= mass_b), 1.0)
        .when(rises, a.p + up / a["size"])
        .when(mass_a <= room_b, 0.0)
        .otherwise(a.p - down / a["size"])
    )
    new_b = (
        F.when(rises & (mass_b <= room_a), 0.0)
        .when(rises, x.p - up / x["size"])
        .when(room_b <= mass_a, 1.0)
        .otherwise(x.p + down / x["size"])
    )
    met = F.struct(new_a.alias("a"), new_b.alias("b"))
    # transform over one element evaluates the meeting once.
    after = F.transform(
        F.array(met),
        lambda m: F.when(
            (m.a <= 0) | (m.a >= 1),
            F.struct(
                _with_p(x, m.b).alias("open"),
                F.array_append(state.done, _done(a, F.when(m.a >= 1, 1).otherwise(0))).alias("done"),
            ),
        ).otherwise(
            F.struct(
                _with_p(a, m.a).alias("open"),
                F.array_append(state.done, _done(x, F.when(m.b >= 1, 1).otherwise(0))).alias("done"),
            )
        ),
    )[0]
    return F.when(
        a.isNull(), F.struct(x.alias("open"), state.done.alias("done"))
    ).otherwise(after)


def _round_blocks(opened: DataFrame, n_blocks: Column, level: int) -> DataFrame:
    """One row per block: the decided documents, and the one left open."""
    dealt = opened.withColumn(
        "block", F.pmod(F.xxhash64("open.doc_id", "open.row", F.lit(level)), n_blocks)
    )
    gathered = dealt.groupBy("source_key", "n", "block").agg(F.collect_list("open").alias("met"))
    largest_first = F.array_sort(
        "met",
        lambda x, y: F.when(x["size"] != y["size"], F.when(x["size"] > y["size"], -1).otherwise(1))
        .when(x.doc_id != y.doc_id, F.when(x.doc_id < y.doc_id, -1).otherwise(1))
        .when(x["row"] != y["row"], F.when(x["row"] < y["row"], -1).otherwise(1))
        .otherwise(0),
    )
    nothing = F.expr(
        f"struct(cast(null as {_OPEN}) as open, cast(array() as array<{_DONE}>) as done)"
    )
    return gathered.select(
        "source_key", "n", F.aggregate(largest_first, nothing, _meet).alias("state")
    ).select("source_key", "n", "state.open", "state.done")


def _reduce(opened: DataFrame, most_rows: int, block: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The reduction tree: decided documents by level, and the last open one per source."""
    parts, n_blocks, level = [], F.col("n"), 0
    while True:
        n_blocks = F.ceil(n_blocks / block).cast("long")
        most_rows = -(-most_rows // block)
        met = stored(_round_blocks(opened, n_blocks, level), f"mix-{label}{level}")
        parts.append(_flat(met.select(F.explode("done").alias("d"))))
        opened, level = met.select("source_key", "n", "open"), level + 1
        if most_rows <= 1:
            return parts, opened.where(F.col("open").isNotNull())


def _decide(last: DataFrame) -> DataFrame:
    """The last open document of a source is taken with its own probability."""
    drawn = _uniform(F.col("open.doc_id"), F.col("open.row"), F.lit(29))
    taken = F.when(drawn < F.col("open.p"), 1).otherwise(0)
    return last.withColumn("taken", taken)


KNOWN = ["doc_id", "size", "source_size", "target"]


def _flat(done: DataFrame) -> DataFrame:
    """The columns of decided documents ``d``; ids that were null are null again."""
    doc_id = F.when(F.col("d.row") >= 0, F.col("d.doc_id")).alias("doc_id")
    return done.select(doc_id, *[f"d.{c}" for c in [*KNOWN[1:], "copies"]])


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most: float = 3.0,
    block: int = BLOCK,
) -> DataFrame:
    """doc_id, size, source_size, target, copies per document of (doc_id, source, text).

    Documents above the mean size of their source meet first. What deciding the last of them
    adds or takes is spread over the fractions of the smaller ones, which then meet.
    """
    sized = stored(numbered(stored(sizes(docs), "mix-texts")), "mix-sizes")
    targets = stored(source_targets(sized, weights, most), "mix-targets")
    n_sources, most_rows = targets.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(1))).first()
    key = nullable_key(F.col("source")).alias("source_key")
    rate = F.when(F.col("size") * F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    rated = join_counted(
        sized.select(key, "doc_id", "row", "size"),
        targets.select(key, "source_size", "n", "target"),
        ["source_key"],
        rows=n_sources,
    ).withColumn("rate", F.coalesce(rate, F.lit(0.0)))
    rated = rated.withColumn("whole", F.floor("rate").cast("long")).withColumn(
        "p", F.col("rate") - F.floor("rate")
    )
    parts = [rated.where(F.col("p") <= 0).select(*KNOWN, F.col("whole").alias("copies"))]
    document = F.struct(
        F.coalesce("doc_id", F.lit(-1)).alias("doc_id"),
        "row",
        "size",
        "source_size",
        "target",
        "whole",
        "p",
    ).alias("open")
    small = F.col("size") * F.col("n") <= F.col("source_size")
    fractional = rated.where(F.col("p") > 0)
    done, last = _reduce(
        fractional.where(~small).select("source_key", "n", document), most_rows, block, "large"
    )
    parts += done
    decided = _decide(last)
    parts.append(_flat(decided.select(_done(F.col("open"), F.col("taken")).alias("d"))))
    # Per source: the words that deciding its last large document took from (or gave to) the rest.
    room = fractional.where(small).groupBy("source_key").agg(F.sum("size").alias("words"))
    moved = room.join(
        decided.select(
            "source_key",
            ((F.col("open.p") - F.col("taken")) * F.col("open.size")).alias("mass"),
        ),
        "source_key",
        "left",
    ).select("source_key", (F.coalesce("mass", F.lit(0.0)) / F.col("words")).alias("shift"))
    shifted = join_counted(
        fractional.where(small), stored(moved, "mix-moved"), ["source_key"], rows=n_sources
    ).withColumn("p", F.least(F.greatest(F.col("p") + F.col("shift"), F.lit(0.0)), F.lit(1.0)))
    settled = (F.col("p") <= 0) | (F.col("p") >= 1)
    parts.append(
        shifted.where(settled).select(*KNOWN, (F.col("whole") + F.col("p").cast("long")).alias("copies"))
    )
    done, last = _reduce(
        shifted.where(~settled).select("source_key", "n", document), most_rows, block, "small"
    )
    parts += done
    parts.append(_flat(_decide(last).select(_done(F.col("open"), F.col("taken")).alias("d"))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
