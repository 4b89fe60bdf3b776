"""SimHash near-duplicates, found by pivot distance tables.

A text's fingerprint has a bit for each bit that is set in over half the hashes of its word
shingles. Fingerprints that differ in at most ``BITS`` bits are linked; what links reach is one
group.

Links come from tables of Hamming distances to fixed reference fingerprints: the zero
fingerprint, one reference for each pair of neighbouring bits, and some dense ones. By the
triangle inequality no coordinate of two linked fingerprints differs by more than BITS.
The distances to zero and to the 32 paired references also add up: half their differences, the
counts of set bits in each pair, differ by BITS in total. So of four bands of eight references,
two agree entirely, and fingerprints meet where two bands agree (six ways to choose them).
Pairs that meet are discarded by the largest difference over all coordinates, and survivors
verified bit by bit.

A cell in which over ``DENSE`` different fingerprints meet would give too many pairs. Its
members are linked through the fingerprints one bit away from them instead: two differ in at
most two bits exactly if some fingerprint is within one bit of both. That is 65 rows for
each, however many meet, and no link is lost.

Defined results: null and empty texts have fingerprint zero and are linked like any other.
Repeated rows give a row each. component_id is the smallest doc_id in the group, null ids
aside; null if it has none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import free_name, join_counted, one_row_each, stored
from flightloom.llm.graph import components

SHINGLE = 3
BITS = 2
SEED = 42
#: Different fingerprints in a cell up to which all its pairs are compared.
DENSE = 48

PAIRED = [3 << (2 * j) for j in range(32)]
BANDS = [range(8 * b, 8 * b + 8) for b in range(4)]
_CHUNK = 1 << 16


def _mixed(n: int) -> int:
    """A dense 64-bit pattern from a small number (fixed rule: a multiply-xor-shift mixer)."""
    x = (n * 0x9E3779B97F4A7C15) % 2**64
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % 2**64
    return x ^ (x >> 27)


SPREAD = [_mixed(n) for n in range(1, 17)]


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    n = max(1, len(words) - shingle + 1)
    first, last = (ends - size)[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.array(
            [digest(joined[i:j], seed) for i, j in zip(first[at : at + _CHUNK], last[at : at + _CHUNK], strict=True)],
            np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int((np.uint64(1) << np.flatnonzero(2 * counts > n).astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fp (signed 64-bit) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle, seed) for t in batch["text"]]
            fps = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fps)], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _distance(fp: Column, reference: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(reference)).cast("long")))


def pivot_table(fps: DataFrame) -> DataFrame:
    """fp with its distances: ``zero``, ``paired`` (32) and ``spread``."""
    fp = F.col("fp")
    return fps.select(
        "fp",
        _distance(fp, 0).alias("zero"),
        F.array(*[_distance(fp, r) for r in PAIRED]).alias("paired"),
        F.array(*[_distance(fp, r) for r in SPREAD]).alias("spread"),
    )


def meeting_cells(table: DataFrame) -> DataFrame:
    """A row for each choice of two bands: the cell in which equal coordinates meet."""

    def band(members: range) -> Column:
        total = F.lit(0).cast("long")
        for j in members:
            # Set bits of pair j, from the distances to zero and to its reference.
            held = F.floor((F.col("zero") + 2 - F.col("paired")[j]) / 2)
            total = total * 3 + held
        return total

    bands = table.select("fp", "spread", *[band(m).alias(f"b{i}") for i, m in enumerate(BANDS)])
    cells = [
        F.struct(F.lit(n).alias("choice"), (F.col(f"b{i}") * 3**8 + F.col(f"b{j}")).alias("cell"))
        for n, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return bands.select("fp", "spread", F.explode(F.array(*cells)).alias("at")).select(
        "fp", "spread", "at.choice", "at.cell"
    )


def links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """a, b: enough pairs of distinct fingerprints within BITS to connect all such pairs."""
    keyed = meeting_cells(pivot_table(fps))
    counts = keyed.groupBy("choice", "cell").agg(F.count(F.lit(1)).alias("n"))
    crowded = stored(counts.where(F.col("n") > dense).select("choice", "cell"), "simhash-dense")
    n_crowded = crowded.count()
    cell = ["choice", "cell"]
    sparse = join_counted(keyed, crowded, cell, "left_anti", n_crowded)
    member = F.struct("fp", "spread")
    met = sparse.groupBy(*cell).agg(F.sort_array(F.collect_list(member)).alias("m")).where(F.size("m") > 1)

    def far(x: Column, y: Column) -> Column:
        """The largest coordinate difference over the dense references."""
        return F.array_max(F.zip_with(x.spread, y.spread, lambda p, q: F.abs(p - q)))

    pairs = met.select(
        F.explode(
            F.flatten(
                F.transform(
                    "m",
                    lambda x, i: F.transform(
                        F.filter(
                            F.slice("m", i + 2, F.size("m")),
                            lambda y: (far(x, y) <= BITS) & (F.bit_count(x.fp.bitwiseXOR(y.fp)) <= BITS),
                        ),
                        lambda y: F.struct(x.fp.alias("a"), y.fp.alias("b")),
                    ),
                )
            )
        ).alias("p")
    ).select("p.a", "p.b")
    if n_crowded == 0:
        return pairs
    members = join_counted(keyed, crowded, cell, "left_semi", n_crowded).select("fp").distinct()
    one_off = [F.col("fp").bitwiseXOR(F.lit(_signed(1 << i)).cast("long")) for i in range(64)]
    around = members.select("fp", F.explode(F.array("fp", *one_off)).alias("point"))
    # At most 65 fingerprints are within one bit of a point.
    ball = around.groupBy("point").agg(F.sort_array(F.collect_list("fp")).alias("m"))
    through = ball.where(F.size("m") > 1).select(
        F.col("m")[0].alias("a"), F.explode(F.slice("m", 2, 65)).alias("b")
    )
    return pairs.unionByName(through)


def groups(prints: DataFrame) -> DataFrame:
    """doc_id, fp, component_id for frames of ``fingerprints``."""
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    found = components(stored(links(classes.select("fp")), "simhash-links"), "simhash")
    linked = stored(
        classes.join(found, classes["fp"] == found["v"]).select("fp", "root", "least"), "simhash-linked"
    )
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(smallest, "root").select("fp", "component_id")
    ids = classes.join(named, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")
    )
    return prints.join(stored(ids, "simhash-ids"), "fp").select("doc_id", "fp", "component_id")


def simhash(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id per row of (doc_id, text)."""
    prints = stored(fingerprints(docs, shingle, seed), "simhash-prints")
    return groups(prints).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of each group: its smallest doc_id, null ids last.

    A document is a pair of doc_id and text. Of different texts of that id in one group the one
    with the smallest hash stays; texts of one id in different groups do not touch each other.
    Repeated rows count as one document.
    """
    hashed, missing = free_name(docs, "text_hash"), free_name(docs, "id_missing")
    number = free_name(docs, "id_number")
    keyed = (
        docs.withColumn(hashed, F.xxhash64("text"))
        .withColumn(missing, F.col("doc_id").isNull())
        .withColumn(number, F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")))
    )
    prints = stored(_keyed_prints(keyed.select(missing, number, hashed, "text")), "simhash-prints")
    classes = stored(prints.select("fp").distinct(), "simhash-classes")
    found = components(stored(links(classes), "simhash-links"), "simhash")
    rooted = stored(
        classes.join(found, classes["fp"] == found["v"], "left").select("fp", F.coalesce("root", "fp").alias("root")),
        "simhash-roots",
    )
    # Documents that go are the few: texts are not shuffled to find them.
    document = F.struct("missing", "number", "text_hash")
    placed = stored(prints.join(rooted, "fp").select("root", document.alias("d")).distinct(), "simhash-placed")
    first = placed.groupBy("root").agg(F.min("d").alias("first"))
    copies = stored(
        placed.join(first, "root").where(F.col("d") != F.col("first")).select(
            F.col("d.missing").alias(missing), F.col("d.number").alias(number), F.col("d.text_hash").alias(hashed)
        ),
        "simhash-copies",
    )
    key = [missing, number, hashed]
    return one_row_each(join_counted(keyed, copies, key, "left_anti"), *key).select(*docs.columns)


def _keyed_prints(rows: DataFrame) -> DataFrame:
    """missing, number, text_hash, fp for rows of the first three and a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(3)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps)], ["missing", "number", "text_hash", "fp"])

    return rows.mapInArrow(run, "missing boolean, number long, text_hash long, fp long")
