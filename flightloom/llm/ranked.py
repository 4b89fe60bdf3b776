"""Ranked lexical search by the best position algorithm.

Each query term has a list of postings (document, impact), highest impact first. The lists of a
query are read in turns; a document that is met is looked up in all other lists at once (direct
access), which gives its whole score and marks its position in each of them. The best position of a
list is the last one up to which all positions have been seen, by reading or by look-up; since
look-ups fill gaps, it lies at or behind the last position read. What the terms weigh at the
best positions bounds every document not yet seen, and reading stops once this bound is
strictly below the k-th best score, so that equal scores are still found.

    1. postings: documents' words are counted against the words of the queries (one pass)
    2. statistics over all documents: how many there are, their words, documents per term
    3. impacts and search: a task holds the lists of a share of the documents, runs all queries
       on them and keeps the k best of each; the best of all shares are merged

Postings are not shuffled; only counts per term and the best of each share are. Queries are
taken in blocks of at most ``QUERY_TERMS`` different (query, term) pairs, which are broadcast.

Defined results: null and wordless texts have no terms and are no results. Queries that are the
same row (id and text) are one; a null id is no query; a query without terms has no results.
Repeated document rows count, and are ranked, one by one. Null doc_ids come last among equal
scores. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightloom.llm.common import stored

#: (query, term) pairs of a block of queries: some 30 MB with words of usual length.
QUERY_TERMS = 500_000
#: Postings whose lists a task holds at once.
SHARE = 2_000_000
#: Positions read from each list in the first turn; turns double.
FIRST_TURN = 4

#: ASCII characters that are no part of a term become blanks, A-Z become a-z.
_FOLDED = bytes(
    ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_FOLDED).split()


def query_terms(items: DataFrame) -> DataFrame:
    """query (a number), item_id, term, repeats for each different row of the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, item, text in zip(*(batch[c].to_pylist() for c in batch.schema.names), strict=True):
                found = Counter(terms_of(text))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([number] * len(found), pa.int64()),
                            pa.array([item] * len(found), pa.string()),
                            pa.array(list(found), pa.binary()),
                            pa.array(list(found.values()), pa.int64()),
                        ],
                        ["query", "item_id", "term", "repeats"],
                    )

    rows = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    numbered = stored(rows.distinct().select(F.monotonically_increasing_id().alias("query"), "*"), "search-queries")
    return numbered.mapInArrow(run, "query long, item_id string, term binary, repeats long")


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (its terms), terms (numbers in the vocabulary) and tfs for documents with terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = shared.value.get, max(1, len(shared.value))
        for batch in batches:
            lengths, numbers = [], []
            for text in batch["text"]:
                words = terms_of(text.as_py())
                lengths.append(len(words))
                ids = np.fromiter((number(w, -1) for w in words), np.int64, len(words))
                numbers.append(ids[ids >= 0])
            row = np.repeat(np.arange(len(numbers)), list(map(len, numbers)))
            keys, tfs = np.unique(row * size + np.concatenate([*numbers, np.zeros(0, np.int64)]), return_counts=True)
            offsets = pa.array(np.searchsorted(keys, np.arange(len(numbers) + 1) * size).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array((keys % size).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int64))),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")
    return found.where(F.col("n") > 0)


@dataclass(frozen=True)
class Statistics:
    """Documents with terms, terms of all of them, documents that hold each term."""

    documents: int
    total: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        top = 2 * self.documents + 2
        return np.array([math.floor(1000 * math.log(top / (2 * df + 1))) for df in self.holding.tolist()], np.int64)


def statistics(posted: DataFrame, n_terms: int) -> Statistics:
    sums = posted.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    holding = np.zeros(n_terms, np.int64)
    counted = posted.select(F.explode("terms").alias("term")).groupBy("term").count()
    for row in counted.collect():
        holding[row["term"]] = row["count"]
    return Statistics(sums["n"], sums["total"], holding)


class Lists:
    """The impact lists of a share of the documents: by impact for reading, by document for look-ups."""

    def __init__(self, ids: np.ndarray, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int) -> None:
        self.ids = ids
        kept = impact > 0
        term, doc, impact = term[kept], doc[kept], impact[kept]
        by_impact = np.lexsort((doc, -impact, term))
        self.starts = np.searchsorted(term[by_impact], np.arange(n_terms + 1))
        self.doc, self.impact = doc[by_impact], impact[by_impact]
        keys = term[by_impact] * len(ids) + self.doc
        #: Place of a posting in its list, in the order of (term, document).
        self.at = np.argsort(keys)
        self.keys = keys[self.at]

    def look_up(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Place of each document's posting in each term's list, or -1."""
        wanted = (terms[:, None] * len(self.ids) + docs[None, :]).ravel()
        found = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[found] == wanted, self.at[found], -1).reshape(len(terms), len(docs))


def search(lists: Lists, terms: np.ndarray, repeats: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, positions read): all that may be among the k best.

    ``floor`` is a score that k documents elsewhere have reached.
    """
    start, stop = lists.starts[terms], lists.starts[terms + 1]
    held = stop > start
    terms, repeats, start, stop = terms[held], repeats[held], start[held], stop[held]
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(terms):
        return docs, scores, 0
    # Seen positions of all lists, one after the other.
    offset = np.concatenate([[0], np.cumsum(stop - start)])
    seen = np.zeros(offset[-1], bool)
    best = start.copy()
    met = np.zeros(len(lists.ids), bool)
    turn, read = FIRST_TURN, 0
    while True:
        # Positions behind the best ones are read next; those seen by a look-up give nothing new.
        ahead = [np.arange(b, min(b + turn, e)) for b, e in zip(best, stop, strict=True)]
        places = np.concatenate(ahead)
        read += len(places)
        fresh = np.unique(lists.doc[places])
        fresh = fresh[~met[fresh]]
        met[fresh] = True
        if len(fresh):
            found = lists.look_up(terms, fresh)
            which, column = np.nonzero(found >= 0)
            place = found[which, column]
            seen[offset[which] + place - start[which]] = True
            total = np.zeros(len(fresh), np.int64)
            np.add.at(total, column, lists.impact[place] * repeats[which])
            docs, scores = np.concatenate([docs, fresh]), np.concatenate([scores, total])
        bound = 0
        for i in range(len(terms)):
            mine = seen[offset[i] : offset[i + 1]]
            rest = mine[best[i] - start[i] :]
            gap = int(np.argmin(rest)) if len(rest) else 0
            best[i] = stop[i] if not len(rest) or rest[gap] else best[i] + gap
            if best[i] < stop[i]:
                # The last contiguous position; before the first one, the list's highest impact.
                bound += int(repeats[i]) * int(lists.impact[max(best[i] - 1, start[i])])
        least = floor
        if len(scores) >= k:
            least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        if not bound or bound < least:
            # Equal scores of smaller ids may still count, lower ones not.
            good = scores >= max(least, 1)
            return docs[good], scores[good], read
        turn *= 2


def _best(ids: np.ndarray, scores: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, missing, -scores))[:k]


def rank(docs: DataFrame, items: DataFrame, k: int = 10, share: int = SHARE, block: int = QUERY_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each query with a score above 0."""
    asked = stored(query_terms(items), "search-terms")
    blocks = max(1, -(-asked.count() // block))
    found = [
        _rank_block(docs, asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b), k, share) for b in range(blocks)
    ]
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
    return (
        reduce(DataFrame.unionAll, found)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(F.col("item_id").cast(items.schema["item_id"].dataType).alias("item_id"), "rank", "doc_id", "score")
    )


def _rank_block(docs: DataFrame, asked: DataFrame, k: int, share: int) -> DataFrame:
    number: dict[bytes, int] = {}
    queries: dict[int, tuple[str, list[int], list[int]]] = {}
    for row in asked.orderBy("query", "term").collect():
        _, terms, repeats = queries.setdefault(row["query"], (row["item_id"], [], []))
        terms.append(number.setdefault(bytes(row["term"]), len(number)))
        repeats.append(row["repeats"])
    posted = stored(postings(docs, number), "search-postings")
    stats = statistics(posted, len(number))
    given = {q: (i, np.array(t), np.array(r)) for q, (i, t, r) in queries.items()}
    shared = docs.sparkSession.sparkContext.broadcast((given, stats, stats.weights()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, stats, weights = shared.value
        floors = dict.fromkeys(given, 0)
        tops: dict[int, np.ndarray] = {q: np.zeros(0, np.int64) for q in given}
        for n_share, rows in enumerate(_shares(batches, share)):
            doc_id, missing, lists = _indexed(rows, stats, weights)
            out: list[tuple] = []
            for query, (item, terms, repeats) in given.items():
                found, scores, _ = search(lists, terms, repeats, k, floors[query])
                best = _best(doc_id[found], scores, missing[found], k)
                found, scores = found[best], scores[best]
                # The k-th best of this task's shares so far.
                tops[query] = np.sort(np.concatenate([tops[query], scores]))[-k:]
                if len(tops[query]) == k:
                    floors[query] = int(tops[query][0])
                out += [
                    (query, item, None if missing[d] else int(doc_id[d]), int(s), n_share * 2**32 + int(d))
                    for d, s in zip(found, scores, strict=True)
                ]
            yield pa.RecordBatch.from_pylist([dict(zip(FOUND.names, row, strict=True)) for row in out], FOUND)

    return posted.mapInArrow(run, "query long, item_id string, doc_id long, score long, row long")


FOUND = pa.schema(
    [("query", pa.int64()), ("item_id", pa.string()), ("doc_id", pa.int64()), ("score", pa.int64()), ("row", pa.int64())]
)


def _shares(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.Table]:
    """Rows of a task in tables of about ``share`` postings."""
    held, n = [], 0
    for batch in batches:
        ends = np.cumsum(batch["terms"].value_lengths().to_numpy(zero_copy_only=False))
        at = 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + share - n, "right")))
            held.append(batch.slice(at, stop - at))
            n += int(ends[stop - 1]) - before
            at = stop
            if n >= share or at < len(ends):
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _indexed(rows: pa.Table, stats: Statistics, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, Lists]:
    ids = rows["doc_id"].combine_chunks()
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
    terms = rows["terms"].combine_chunks()
    doc = np.repeat(np.arange(len(doc_id)), terms.value_lengths().to_numpy(zero_copy_only=False))
    term = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tf = rows["tfs"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    n = rows["n"].to_numpy()
    m = 100 - 75 + (75 * n * stats.documents) // max(1, stats.total)
    impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    return doc_id, missing, Lists(doc_id, term, doc, impact, len(weights))
