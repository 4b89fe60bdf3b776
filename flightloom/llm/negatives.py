"""Hard negatives for anchors, read from Hilbert-ordered blocks through zone maps.

Candidates are stored along a Hilbert curve over their most varied dimensions and cut into
blocks of ``BLOCK`` neighbours. A block is one Parquet row: its vectors, and a zone map with the
least and greatest component in every dimension and the labels it holds. Zone maps are columns
of their own and are read without the vectors.

What is asked of the blocks is a window: for an anchor, scores from ``low`` to ``high``, of the
anchor's label or of others, the k highest. Interval arithmetic on a zone map bounds the scores
of an anchor with anything in the block; a block is read for an anchor only if its interval
meets one of the anchor's windows and it has labels of the kind asked for.

    1. floor: an anchor's own block gives the score that its k-th best positive at least has
    2. positives: window from that floor up, same label
    3. negatives: for each positive's score p, the window [30 % p, 90 % p], other labels

Blocks and anchors are dealt in groups, and each pair of groups that has something to read is a task;
its best are merged per window. Anchors are a stated set of queries against all rows.

Defined results: rows without id, label or vector, or with a null or non-finite component, take no
part. Vectors may differ in length; missing components count as zero. Rows with the id of an
anchor are no candidates of it. Repeated rows of an anchor count once, different rows under one
id are anchors of their own; repeated candidates count each. A positive score of zero asks for
zero, a negative one has an empty window. Components are 64-bit after scaling; scores are exact.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.llm.common import stored

#: Candidates of a block, blocks of a group, anchors of a group.
BLOCK = 128
BLOCKS = 32
ANCHORS = 1024
#: The curve's dimensions and bits for each.
DIMENSIONS = 8
BITS = 7
#: Percent of the positive's score from and to which negatives are hard.
FROM, TO = 30, 90
POSITIVES, NEGATIVES = 5, 10

_LEAST, _MOST = -(2**62), 2**62
_EXACT = 2**53


def vectors(rows: DataFrame, id_col: str, vec_col: str, label: Column, scale: float) -> DataFrame:
    """id, label, terms (floor(scale * component)) of rows that are whole and finite."""
    values = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.where(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vec_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.transform(values, lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("terms"),
    )


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of points with ``bits`` bits a dimension (64 at most in all)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    at = 1 << (bits - 1)
    while at > 1:
        low = at - 1
        for i in range(n):
            high = (x[i] & at) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        at >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    at = 1 << (bits - 1)
    while at > 1:
        turn = np.where((x[n - 1] & at) != 0, turn ^ (at - 1), turn)
        at >>= 1
    x ^= turn
    index = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << np.uint64(1)) | ((x[i] >> bit) & 1).astype(np.uint64)
    return index


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), max(width, int(size.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def along_the_curve(rows: DataFrame) -> DataFrame:
    """The rows with ``curve``, their index over the dimensions that vary most."""
    spread = rows.select(F.posexplode("terms").alias("at", "x")).groupBy("at").agg(
        F.var_pop("x").alias("v"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    widest = spread.orderBy(F.desc("v"), "at").limit(DIMENSIONS).collect()
    dims = np.array([r["at"] for r in widest], np.int64)
    low = np.array([r["low"] for r in widest], np.float64)
    step = np.array([max(r["high"] - r["low"], 1) for r in widest], np.float64) / (2**BITS - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            curve = np.zeros(len(batch), np.int64)
            if len(dims):
                picked = _matrix(batch["terms"], int(dims.max()) + 1)[:, dims]
                cells = np.clip((picked - low) / step, 0, 2**BITS - 1)
                curve = hilbert(cells, BITS).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve)], [*batch.schema.names, "curve"])

    return rows.mapInArrow(run, "id long, label long, terms array<long>, curve long")


BLOCK_SCHEMA = (
    "block long, low array<long>, high array<long>, labels array<long>,"
    " ids array<long>, held array<long>, width int, terms array<long>"
)


def store_blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """The blocks, one a row, in the order of the curve; see ``BLOCK_SCHEMA``.

    ``terms`` has the vectors of ``ids`` one after the other, each ``width`` long, and ``held``
    their labels.
    """
    keyed = along_the_curve(rows).withColumn("place", F.monotonically_increasing_id())
    # Places differ even where rows are equal, so no stretch of the curve is too long to split.
    keyed = stored(keyed, "negatives-curve")
    order = ["curve", "id", "place"]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "label", "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 32, 0
        for part in _of_size(batches, size):
            matrix = _matrix(part["terms"].combine_chunks(), 0)
            labels = part["label"].to_numpy()
            columns = [
                [first + n], [matrix.min(0)], [matrix.max(0)], [np.unique(labels)],
                [part["id"].to_numpy()], [labels], [matrix.shape[1]], [matrix.reshape(-1)],
            ]
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.int32(), pa.list_(pa.int64())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in BLOCK_SCHEMA.split(", ")])
            n += 1

    return stored(dealt.mapInArrow(run, BLOCK_SCHEMA), "negatives-blocks")


def _of_size(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    rest: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        at = 0
        while at < len(batch):
            some = batch.slice(at, size - n)
            rest.append(some)
            n += len(some)
            at += len(some)
            if n == size:
                yield pa.Table.from_batches(rest)
                rest, n = [], 0
    if rest:
        yield pa.Table.from_batches(rest)


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of both; in doubles while these hold them exactly."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1) < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _interval(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each anchor with a vector of each zone."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _inner(up, low) + _inner(down, high), _inner(up, high) + _inner(down, low)


WINDOWS = "anchor long, id long, label long, same boolean, terms array<long>, lows array<long>, highs array<long>"


def _blocks_of(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place, ids, labels, vectors) of each block."""
    for n, width in enumerate(table["width"].to_pylist()):
        ids, labels, terms = (table[c][n].values.to_numpy() for c in ("ids", "held", "terms"))
        yield n, ids, labels, terms.reshape(len(ids), width)


def _floors(blocks: DataFrame, k: int, is_anchor: Callable[[Column], Column]) -> DataFrame:
    """WINDOWS of the positives: from the k-th best score in the anchor's own block up."""
    flagged = blocks.select(
        "ids", "held", "width", "terms", F.transform("ids", lambda x: F.coalesce(is_anchor(x), F.lit(False))).alias("wanted")
    ).where(F.exists("wanted", lambda w: w))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, ids, labels, matrix in _blocks_of(batch):
                at = np.flatnonzero(batch["wanted"][n].values.to_numpy(zero_copy_only=False))
                rows = []
                for i, own in zip(at, _inner(matrix[at], matrix), strict=True):
                    others = own[(labels == labels[i]) & (ids != ids[i])]
                    floor = int(np.partition(others, len(others) - k)[len(others) - k]) if len(others) >= k else _LEAST
                    rows.append((0, int(ids[i]), int(labels[i]), True, matrix[i], [floor], [_MOST]))
                columns = zip(zip(*rows, strict=True), _WINDOW_KINDS, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], _WINDOW_NAMES)

    found = flagged.mapInArrow(run, WINDOWS)
    # Equal rows are one anchor, whichever block they are in.
    same = found.groupBy("id", "label", "terms").agg(F.max(F.element_at("lows", 1)).alias("low"))
    return same.select(
        F.xxhash64("id", "label", "terms").alias("anchor"),
        "id",
        "label",
        F.lit(True).alias("same"),
        "terms",
        F.array("low").alias("lows"),
        F.array(F.lit(_MOST).cast("long")).alias("highs"),
    )


_LONGS = pa.list_(pa.int64())
_WINDOW_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), _LONGS, _LONGS, _LONGS]
_WINDOW_NAMES = ["anchor", "id", "label", "same", "terms", "lows", "highs"]


class _Asked:
    """The windows of a group of anchors, as arrays."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.sort_by([("anchor", "ascending"), ("id", "ascending")])
        self.anchor, self.id, self.label = (rows[c].to_numpy() for c in ("anchor", "id", "label"))
        self.same = rows["same"].to_numpy()
        self.matrix = _matrix(rows["terms"].combine_chunks(), 1)
        lows = rows["lows"].combine_chunks()
        self.n = lows.value_lengths().to_numpy(zero_copy_only=False)
        self.first = np.cumsum(self.n) - self.n
        self.lows = lows.flatten().to_numpy(zero_copy_only=False)
        self.highs = rows["highs"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.of = np.repeat(np.arange(len(self.n)), self.n)

    def met(self, low: np.ndarray, high: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """For anchors and zones: whether a window meets the scores from low to high.

        ``kinds`` says which zones have labels of the kind that each anchor asks for.
        """
        out = np.zeros(low.shape, bool)
        for j in range(len(self.of)):
            i = self.of[j]
            out[i] |= (high[i] >= self.lows[j]) & (low[i] <= self.highs[j])
        return out & kinds


def _kinds(asked: _Asked, labels: list[np.ndarray]) -> np.ndarray:
    found, which = np.unique(asked.label, return_inverse=True)
    has = np.array([np.isin(found, mine) for mine in labels]).reshape(len(labels), len(found)).T
    alone = np.array([len(mine) for mine in labels]) == 1
    own = has[which]
    return np.where(asked.same[:, None], own, ~(own & alone[None, :]))


def _choose(asked: pa.Table, zones: pa.Table) -> pa.Table:
    """block and the anchors' places in their group for blocks that must be read."""
    windows = _Asked(asked)
    low, high = (_matrix(zones[c].combine_chunks(), 1) for c in ("low", "high"))
    # Vectors that are shorter than the block's widest were filled with zeros, so zones cover zero there.
    needed = windows.met(*_interval(windows.matrix, low, high), _kinds(windows, [np.array(x) for x in zones["labels"].to_pylist()]))
    hit = needed.any(axis=0)
    return pa.table(
        {
            "block": zones["block"].to_numpy()[hit],
            "anchors": pa.array([np.flatnonzero(c) for c in needed.T[hit]], pa.list_(pa.int32())),
        }
    )


def _read(k: int):
    """For a group of anchors and a group of blocks: the k best rows of each window."""

    def run(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        windows = _Asked(asked)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for place, ids, labels, matrix in _blocks_of(blocks):
            mine = blocks["anchors"][place].values.to_numpy()
            scores = _inner(windows.matrix[mine], matrix)
            fit = (labels[None, :] == windows.label[mine][:, None]) == windows.same[mine][:, None]
            fit &= ids[None, :] != windows.id[mine][:, None]
            for n, i in enumerate(mine.tolist()):
                for j in range(windows.first[i], windows.first[i] + windows.n[i]):
                    at = np.flatnonzero(fit[n] & (scores[n] >= windows.lows[j]) & (scores[n] <= windows.highs[j]))
                    if len(at):
                        at = at[np.lexsort((ids[at], -scores[n][at]))[:k]]
                        found.append((np.full(len(at), j), ids[at], scores[n][at]))
        none = [np.zeros(0, np.int64)] * 3
        window, ids, scores = (np.concatenate(x) for x in zip(none, *found, strict=True))
        best = np.lexsort((ids, -scores, window))
        rank = np.arange(len(best)) - np.searchsorted(window[best], window[best])
        best = best[rank < k]
        anchor = windows.of[window[best]]
        return pa.table(
            {
                "anchor": windows.anchor[anchor],
                "anchor_id": windows.id[anchor],
                "window": window[best] - windows.first[anchor],
                "id": ids[best],
                "score": scores[best],
            }
        )

    return run


def best_in_windows(windows: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """anchor, anchor_id, window (its number), rank, id, score: the k best rows of each window."""
    anchor_groups = max(1, -(-windows.count() // ANCHORS))
    zone_groups = max(1, -(-blocks.count() // (BLOCKS * BLOCKS)))
    grouped = windows.withColumn("ag", F.pmod(F.xxhash64("anchor", "id"), F.lit(anchor_groups)))
    zones = blocks.select("block", "low", "high", "labels").withColumn("zg", F.pmod(F.xxhash64("block"), F.lit(zone_groups)))
    chosen = stored(
        grouped.withColumn("zg", F.explode(F.expr(f"sequence(0L, {zone_groups - 1}L)")))
        .groupBy("ag", "zg")
        .cogroup(
            zones.withColumn("ag", F.explode(F.expr(f"sequence(0L, {anchor_groups - 1}L)"))).groupBy("ag", "zg")
        )
        .applyInArrow(lambda key, a, z: _tagged(key, _choose(a, z)), "ag long, block long, anchors array<int>"),
        "negatives-chosen",
    )
    # Blocks that are read for a group are dealt to its tasks; no other block is shuffled.
    part = F.pmod(F.xxhash64("block"), F.lit(max(1, -(-blocks.count() // BLOCKS)))).alias("bg")
    wanted = blocks.drop("low", "high", "labels").join(chosen, "block").select("*", part)
    tasks = stored(chosen.select("ag", part).distinct(), "negatives-tasks")
    found = (
        grouped.join(tasks, "ag")
        .groupBy("ag", "bg")
        .cogroup(wanted.groupBy("ag", "bg"))
        .applyInArrow(_read(k), "anchor long, anchor_id long, window long, id long, score long")
    )
    best = Window.partitionBy("anchor", "anchor_id", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _tagged(key: tuple, found: pa.Table) -> pa.Table:
    group = pa.array([key[0].as_py()] * len(found), pa.int64())
    return pa.table({"ag": group, "block": found["block"], "anchors": found["anchors"]})


def mine(
    rows: DataFrame,
    is_anchor: Callable[[Column], Column],
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` is a frame of ``vectors``; ``is_anchor`` says of an id whether it is an anchor.
    """
    blocks = store_blocks(stored(rows, "negatives-rows"), block)
    anchors = stored(_floors(blocks, positives, is_anchor), "negatives-anchors")
    near = stored(best_in_windows(anchors, blocks, positives), "negatives-positives")
    place = F.struct("rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    listed = near.groupBy(F.col("anchor").alias("of"), F.col("anchor_id").alias("of_id")).agg(
        F.sort_array(F.collect_list(place)).alias("found")
    )
    # Scores n with FROM * p <= 100 * n <= TO * p.
    asked = stored(
        anchors.join(listed, (F.col("anchor") == F.col("of")) & (F.col("id") == F.col("of_id"))).select(
            "anchor",
            "id",
            "label",
            F.lit(False).alias("same"),
            "terms",
            F.expr(f"transform(found, f -> if(f.positive_score < 0, {_MOST}L, ({FROM} * f.positive_score + 99) div 100))").alias("lows"),
            F.expr(f"transform(found, f -> if(f.positive_score < 0, {_LEAST}L, ({TO} * f.positive_score) div 100))").alias("highs"),
            "found",
        ),
        "negatives-windows",
    )
    hard = best_in_windows(asked.drop("found"), blocks, negatives)
    named = asked.select(
        F.col("anchor").alias("of"), F.col("id").alias("of_id"), F.posexplode("found").alias("at", "positive")
    )
    same = (F.col("anchor") == F.col("of")) & (F.col("anchor_id") == F.col("of_id")) & (F.col("window") == F.col("at"))
    return hard.join(named, same).select(
        "anchor_id",
        "positive.positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive.positive_score",
        F.col("score").alias("negative_score"),
    )
