"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors become integer rows, one term per component. Queries and candidates are dealt into
blocks, and every pair of blocks is one task: the candidates of the block are kept as
weighted postings by term; each query, a sparse row of its non-zero terms, adds its weight
times the postings of each of its terms into a dense array of scores, of which the k best are
selected. The blocks' best are merged per query.

Defined results: a row whose vector is null or holds a null or non-finite component takes no
part, nor does a null id. Vectors may differ in length; missing components count as zero. Rows
with the id of a query are its own and are no candidates of it; repeated rows of another id
count each. Repeated rows of a query count once. Components are 64-bit after scaling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block. A task holds a block of each side and one dense array of scores.
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 4096
#: Share of non-zero components from which a term's postings are kept as a dense column.
DENSE = 0.25


def integer_rows(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """id, terms: floor(scale * component) of every vector that is whole and finite."""
    values = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    whole = F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return vectors.where(
        F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & whole
    ).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(values, lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("terms"),
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    width = np.diff(rows.offsets.to_numpy()) if len(rows) else np.zeros(0, int)
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    out = np.zeros((len(rows), int(width.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < width[:, None]] = flat
    return out


def _postings(matrix: np.ndarray, kind: type) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """Per term: candidates that have it, or None if it is dense, and their weights."""
    out: list[tuple[np.ndarray | None, np.ndarray]] = []
    for column in np.ascontiguousarray(matrix.T).astype(kind):
        held = np.flatnonzero(column)
        out.append((None, column) if len(held) > DENSE * len(column) else (held, column[held]))
    return out


def _accumulate(query: np.ndarray, postings: list, scores: np.ndarray, part: np.ndarray) -> None:
    scores[:] = 0
    for term in np.flatnonzero(query[: len(postings)]):
        held, weights = postings[term]
        if held is None:
            np.multiply(weights, query[term], out=part)
            scores += part
        else:
            scores[held] += weights * query[term]


def best_of_blocks(k: int):
    """For one pair of blocks: the k best candidates of each query."""

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        ids = candidates["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], _matrix(candidates["terms"])[order]
        wanted = _matrix(queries["terms"])
        width = min(rows.shape[1], wanted.shape[1]) or 1
        largest = float(np.abs(rows).max(initial=0)) * float(np.abs(wanted).max(initial=0))
        kind = np.int32 if largest * width < 2**31 else np.int64
        postings = _postings(rows, kind)
        scores, part = np.zeros(len(ids), kind), np.zeros(len(ids), kind)
        wanted = wanted.astype(kind)
        out: tuple[list, list, list] = ([], [], [])
        for query_id, query in zip(queries["id"].to_pylist(), wanted, strict=True):
            _accumulate(query, postings, scores, part)
            lo, hi = np.searchsorted(ids, query_id), np.searchsorted(ids, query_id, "right")
            others = scores if lo == hi else np.delete(scores, slice(lo, hi))
            if len(others) > k:
                least = np.partition(others, len(others) - k)[len(others) - k]
                above = np.flatnonzero(others > least)
                # Candidates are in the order of their ids: the first ties win.
                found = np.concatenate([above, np.flatnonzero(others == least)[: k - len(above)]])
            else:
                found = np.arange(len(others))
            at = np.where(found >= lo, found + (hi - lo), found)
            out[0].extend([query_id] * len(found))
            out[1].append(ids[at])
            out[2].append(others[found].astype(np.int64))
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out[1:]]
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": flat[0], "score": flat[1]})

    return run


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 20,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query.

    Both sides are frames of ``integer_rows``. Ties go to the smaller id.
    """
    queries = queries.distinct()
    query_blocks = max(1, -(-queries.count() // query_block))
    candidate_blocks = max(1, -(-candidates.count() // candidate_block))
    # Rows are dealt by their place in the input, so equal ids spread as well.
    dealt_queries = queries.withColumn(
        "qb", F.pmod(F.xxhash64("id", "terms"), F.lit(query_blocks))
    ).withColumn("cb", F.explode(F.expr(f"sequence(0L, {candidate_blocks - 1}L)")))
    dealt_candidates = candidates.withColumn(
        "cb", F.pmod(F.monotonically_increasing_id(), F.lit(candidate_blocks))
    ).withColumn("qb", F.explode(F.expr(f"sequence(0L, {query_blocks - 1}L)")))
    found = (
        dealt_queries.groupBy("qb", "cb")
        .cogroup(dealt_candidates.groupBy("qb", "cb"))
        .applyInArrow(best_of_blocks(k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
