"""Text scores by an interpolated modified Kneser-Ney bigram model.

Counting, in Spark, in three passes of training texts:

    words     hashes of different words and their counts, in shards by hash; the place of a
              word in all shards is its number
    pairs     counts of neighbouring word numbers, in shards by the first word; pairs of a
              frequent first word are spread over all shards
    contexts  per word number: how often and with how many different words it is followed, by
              number of times, and how many different words precede it

Each shard is a sorted array in the shared folder, written by the task that counted it. Scoring
tasks map the files into memory and look up sorted batches, so a task holds no more of the
model than the pages it touches, and nothing of it passes the driver but sums over counts.

Tokens: A-Z in lower case, words between ASCII blanks, then one end. A text is preceded by a
beginning, which is counted as a context only. Unknown words share the mass that the lowest
order keeps back, with 1 / (V + 1) each.

Defined results: null and empty texts are the end alone. Without training tokens every token
has probability 1. Repeated rows score alike (and count as often as they occur in training).
Null doc_ids count as the empty string in the fold. At most 2^32 - 1 different training words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.llm.arrays import mapped, merged, mixed, packed, unpacked, write
from flightloom.llm.common import fold, stored
from flightloom.session import scratch_dir

#: Text that is counted, and that is scored, at a time within a task: counting gains from
#: repetitions within a slice, scoring holds many more arrays of its tokens.
SLICE_CHARS = 8_000_000
SCORED_CHARS = 2_500_000
#: Training tokens per shard, and the least number of shards.
SHARD_TOKENS = 3_000_000
LEAST_SHARDS = 16
#: A first word with over this part of a shard's tokens is spread over all shards.
FREQUENT = 8
_END = b" "
_UNKNOWN = np.int64(-1)


class Slice:
    """Tokens of some texts: ``words`` are the different ones, ``ids`` point into them."""

    def __init__(self, texts: list[str | None]):
        seen: defaultdict[bytes, int] = defaultdict()
        seen.default_factory = seen.__len__
        number = seen.__getitem__
        end = number(_END)
        parts, sizes = [], []
        for t in texts:
            found = list(map(number, (t or "").encode("utf-8", "surrogatepass").lower().split()))
            found.append(end)
            parts.append(np.array(found, np.int32))
            sizes.append(len(found))
        self.ids = np.concatenate(parts)
        self.sizes = np.array(sizes, np.int64)
        self.hashes = np.array([xxhash.xxh64_intdigest(w) for w in seen], np.uint64)
        self.counts = np.bincount(self.ids, minlength=len(seen))

    def first_of_text(self) -> np.ndarray:
        starts = np.cumsum(self.sizes) - self.sizes
        out = np.zeros(len(self.ids), bool)
        out[starts] = True
        return out


def slices(texts: list[str | None], most: int) -> Iterator[tuple[int, int, Slice]]:
    begin, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t or "") + 1
        if chars >= most or i + 1 == len(texts):
            yield begin, i + 1, Slice(texts[begin : i + 1])
            begin, chars = i + 1, 0


def _blobs(shard: np.ndarray, keys: np.ndarray, *counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per shard: its keys, which are sorted, and their counts."""
    order = np.argsort(shard, kind="stable")
    shard, keys, counts = shard[order], keys[order], [c[order] for c in counts]
    values, first = np.unique(shard, return_index=True)
    ends = [*first[1:].tolist(), len(shard)]
    blobs = [packed(keys[a:b]) for a, b in zip(first.tolist(), ends, strict=True)]
    sums = [
        b"".join(np.ascontiguousarray(c[a:b].astype(np.uint32)).tobytes() for c in counts)
        for a, b in zip(first.tolist(), ends, strict=True)
    ]
    if len(values):
        yield pa.RecordBatch.from_arrays(
            [pa.array(values.astype(np.int64)), pa.array(blobs, pa.binary()), pa.array(sums, pa.binary())],
            ["shard", "keys", "counts"],
        )


def _gathered(rows: pa.Table, width: int) -> tuple[np.ndarray, ...]:
    keys = [unpacked(x.as_py()) for x in rows["keys"]]
    counts = [np.frombuffer(x.as_py(), np.uint32).reshape(width, -1) for x in rows["counts"]]
    return merged(np.concatenate(keys), *np.concatenate(counts, axis=1))


_BLOB = "shard long, keys binary, counts binary"


class Sharded:
    """Sorted shards of word hashes: numbers of words, and values kept by number."""

    def __init__(self, folder: str, sizes: list[int]):
        self.folder, self.sizes = folder, sizes
        self.begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.files: dict[str, list[np.ndarray]] = {}

    def _arrays(self, name: str) -> list[np.ndarray]:
        if name not in self.files:
            self.files[name] = [mapped(f"{self.folder}/{name}-{i}.npy") for i in range(len(self.sizes))]
        return self.files[name]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for unknown ones."""
        order = np.argsort(hashes)
        wanted, out = hashes[order], np.full(len(hashes), _UNKNOWN)
        cuts = np.searchsorted(hash_shard(wanted, len(self.sizes)), np.arange(len(self.sizes) + 1))
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if a < b and self.sizes[i]:
                known = self._arrays("hash")[i]
                at = np.minimum(np.searchsorted(known, wanted[a:b]), len(known) - 1)
                out[order[a:b]] = np.where(known[at] == wanted[a:b], at + self.begin[i], _UNKNOWN)
        return out

    def values(self, name: str, numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows of the arrays ``name``, cut at ``ends``, for sorted numbers."""
        files = self._arrays(name)
        cuts = np.searchsorted(numbers, ends)
        parts = [
            files[i][numbers[a:b] - ends[i]]
            for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            if a < b
        ]
        return np.concatenate(parts) if parts else np.zeros((0, *files[0].shape[1:]), np.int64)


def hash_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards by the leading bits, so that they are in the order of the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def pair_shard(first: np.ndarray, keys: np.ndarray, frequent: np.ndarray, shards: int) -> np.ndarray:
    at = np.searchsorted(frequent, first)
    spread = (at < len(frequent)) & (frequent[np.minimum(at, len(frequent) - 1)] == first) if len(frequent) else np.zeros(len(first), bool)
    return mixed(np.where(spread, keys, first.astype(np.uint64))) % np.uint64(shards)


def _pairs(piece: Slice, number: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of each token and of the token before it."""
    second = number[piece.ids]
    first = np.concatenate([[begin], second[:-1]])
    first[piece.first_of_text()] = begin
    return first, second


def discounts(n: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ from the numbers of keys counted 1, 2, 3 and 4 times."""
    out = []
    for k in (1, 2, 3):
        if n[0] > 0 and n[k - 1] > 0:
            y = n[0] / (n[0] + 2 * n[1])
            d = k - (k + 1) * y * n[k] / n[k - 1]
        else:
            d = 0.5
        # Small samples may give values outside; a discount must leave something of a count.
        out.append(float(np.clip(d, 0.05, k - 0.05)))
    return np.array([0.0, *out])


def _count_words(train: DataFrame, folder: str, shards: int) -> list:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, piece in slices(batch["text"].to_pylist(), SLICE_CHARS):
                order = np.argsort(piece.hashes)
                hashes = piece.hashes[order]
                yield from _blobs(hash_shard(hashes, shards), hashes, piece.counts[order])

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        hashes, counts = _gathered(rows, 1)
        write(f"{folder}/hash-{shard}.npy", hashes)
        write(f"{folder}/count-{shard}.npy", counts)
        return pa.table({"shard": [shard], "n": [len(hashes)], "total": [int(counts.sum())]})

    rows = train.select("text").mapInArrow(count, _BLOB)
    return rows.groupBy("shard").applyInArrow(merge, "shard long, n long, total long").collect()


def _frequent_words(spark: SparkSession, words: Sharded, least: float) -> np.ndarray:
    """Numbers of the words with more than ``least`` tokens; all tokens over ``least`` bound how many."""
    folder, begin, shards = words.folder, words.begin, len(words.sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch["id"].to_pylist():
                above = np.flatnonzero(mapped(f"{folder}/count-{shard}.npy") > least) + begin[shard]
                yield pa.RecordBatch.from_arrays([pa.array(above.astype(np.int64))], ["number"])

    found = spark.range(shards).mapInArrow(run, "number long").collect()
    return np.array(sorted(r["number"] for r in found), np.int64)


def _count_pairs(train: DataFrame, words: Sharded, folder: str, frequent: np.ndarray, shards: int, ids: int) -> tuple[np.ndarray, DataFrame]:
    begin = int(words.begin[-1])
    id_ends = np.linspace(0, begin + 1, ids + 1).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, piece in slices(batch["text"].to_pylist(), SLICE_CHARS):
                first, second = _pairs(piece, words.numbers(piece.hashes), begin)
                keys, counts = np.unique((first.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64), return_counts=True)
                shard = pair_shard((keys >> np.uint64(32)).astype(np.int64), keys, frequent, shards)
                yield from _blobs(shard, keys, counts)

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys, counts = _gathered(rows, 1)
        write(f"{folder}/pair-{shard}.npy", keys)
        write(f"{folder}/times-{shard}.npy", counts.astype(np.uint32))
        first, second = (keys >> np.uint64(32)), keys & np.uint64(0xFFFFFFFF)
        context, total, one, two, more = merged(first, counts, counts == 1, counts == 2, counts > 2)
        word, before = merged(second, np.ones(len(second), np.int64))
        none = np.zeros(len(word), np.int64)
        both = merged(
            np.concatenate([context, word]),
            *[np.concatenate(x) for x in ((total, none), (one, none), (two, none), (more, none), (np.zeros(len(context), np.int64), before))],
        )
        part = np.searchsorted(id_ends, both[0].astype(np.int64), "right") - 1
        of_counts = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
        out = pa.Table.from_batches(list(_blobs(part, both[0], *both[1:])))
        out = out.append_column("seen", pa.array([of_counts.tolist() if i == 0 else [0] * 4 for i in range(len(out))], pa.list_(pa.int64())))
        return out

    rows = train.select("text").mapInArrow(count, _BLOB)
    sums = stored(rows.groupBy("shard").applyInArrow(merge, f"{_BLOB}, seen array<long>"), "lm-contexts")
    seen = sums.agg(*[F.coalesce(F.sum(F.col("seen")[i]), F.lit(0)) for i in range(4)]).first()
    return np.array([int(x) for x in seen]), sums


def _count_contexts(sums: DataFrame, folder: str, end_of: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense arrays by word number: followed (total, 1, 2, 3+ times) and preceded."""

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        numbers, *counts = _gathered(rows, 5)
        dense = np.zeros((int(end_of[part + 1] - end_of[part]), 5), np.uint32)
        dense[numbers.astype(np.int64) - end_of[part]] = np.stack(counts, axis=1)
        write(f"{folder}/context-{part}.npy", dense)
        before = dense[:, 4]
        seen = np.bincount(np.minimum(before, 5), minlength=6)
        return pa.table(
            {"seen": pa.array([seen[1:5].tolist()], pa.list_(pa.int64())), "words": [int((before > 2).sum())], "pairs": [int(before.sum())]}
        )

    found = sums.select("shard", "keys", "counts").groupBy("shard").applyInArrow(
        merge, "seen array<long>, words long, pairs long"
    ).collect()
    seen = np.array([r["seen"] for r in found]).reshape(-1, 4).sum(axis=0)
    return np.append(seen, sum(r["words"] for r in found)), sum(r["pairs"] for r in found)


def _scores(piece: Slice, words: Sharded, context: Sharded, m: dict) -> tuple[np.ndarray, ...]:
    """Per token: whether it is known, log10 of the base and of the model."""
    begin = int(words.begin[-1])
    number = words.numbers(piece.hashes)
    known = number >= 0
    total, different = m["tokens"], begin
    count = np.zeros(len(number))
    order = np.flatnonzero(known)[np.argsort(number[known])]
    count[order] = words.values("count", number[order], words.begin)
    base = np.log10((count + 0.5) / (total + 0.5 * (different + 1)))

    # Per different word: what it is followed and preceded by. The last row is the beginning.
    around = np.zeros((len(number) + 1, 5))
    if len(order):
        around[order] = context.values("context", number[order], m["ends"])
    if total:
        around[-1] = context.values("context", np.array([begin]), m["ends"])[0]
    d1, d2 = m["single"], m["pair"]
    before = around[:, 4].astype(np.int64)
    if m["pairs"]:
        kept = np.maximum(before - d1[np.minimum(before, 3)], 0.0)
        low = kept / m["pairs"] + m["left"] / m["pairs"] / (different + 1)
    else:
        low = np.full(len(before), 1.0 / (different + 1))
    back = around[:, 1] * d2[1] + around[:, 2] * d2[2] + around[:, 3] * d2[3]

    first = np.concatenate([[len(number)], piece.ids[:-1]]).astype(np.int64)
    first[piece.first_of_text()] = len(number)
    all_numbers = np.append(number, begin)
    u, w = all_numbers[first], number[piece.ids]
    times = np.zeros(len(w), np.int64)
    both = np.flatnonzero((u >= 0) & (w >= 0))
    keys, back_to = np.unique((u[both].astype(np.uint64) << np.uint64(32)) | w[both].astype(np.uint64), return_inverse=True)
    shard = pair_shard((keys >> np.uint64(32)).astype(np.int64), keys, m["frequent"], m["shards"])
    by_shard = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[by_shard], np.arange(m["shards"] + 1))
    found = np.zeros(len(keys), np.int64)
    for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if a < b:
            have, often = m["files"](i)
            if len(have):
                wanted = keys[by_shard[a:b]]
                at = np.minimum(np.searchsorted(have, wanted), len(have) - 1)
                found[by_shard[a:b]] = np.where(have[at] == wanted, often[at], 0)
    times[both] = found[back_to]
    followed = around[first, 0]
    lower = low[piece.ids]
    seen = followed > 0
    top = np.maximum(times - d2[np.minimum(times, 3)], 0.0) + back[first] * lower
    p = np.where(seen, top / np.where(seen, followed, 1.0), lower)
    return known[piece.ids], base[piece.ids], np.log10(p)


def score(docs: DataFrame, train_on: int = 5) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row.

    Learns from rows whose ``fold`` by ``train_on`` is not 1.
    """
    spark = docs.sparkSession
    held_out: Column = fold(F.col("doc_id"), train_on) == 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    train = rows.where(~F.col("held_out"))
    folder = scratch_dir(spark, "lm")
    word_shards = max(LEAST_SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    counted = {r["shard"]: r for r in _count_words(train, folder, word_shards)}
    sizes = [counted[i]["n"] if i in counted else 0 for i in range(word_shards)]
    tokens = sum(r["total"] for r in counted.values())
    words = Sharded(folder, sizes)
    if words.begin[-1] >= 2**32 - 1:
        raise ValueError("more than 2^32 - 2 different training words")
    shards = max(LEAST_SHARDS, -(-tokens // SHARD_TOKENS))
    frequent = np.append(_frequent_words(spark, words, tokens / shards / FREQUENT), words.begin[-1])
    id_parts = word_shards
    ends = np.linspace(0, int(words.begin[-1]) + 1, id_parts + 1).astype(np.int64)
    seen, sums = _count_pairs(train, words, folder, frequent, shards, id_parts)
    low_seen, pairs = _count_contexts(sums, folder, ends)
    single = discounts(low_seen[:4])
    model = {
        "tokens": tokens,
        "pairs": pairs,
        "pair": discounts(seen),
        "single": single,
        "left": float(single[1] * low_seen[0] + single[2] * low_seen[1] + single[3] * low_seen[4]),
        "frequent": frequent,
        "shards": shards,
        "ends": ends,
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, context = Sharded(folder, sizes), Sharded(folder, [0] * id_parts)
        opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def files(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in opened:
                opened[i] = mapped(f"{folder}/pair-{i}.npy"), mapped(f"{folder}/times-{i}.npy")
            return opened[i]

        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for _, _, piece in slices(batch["text"].to_pylist(), SCORED_CHARS):
                known, base, kn = _scores(piece, vocabulary, context, model | {"files": files})
                starts = np.cumsum(piece.sizes) - piece.sizes
                out[0].append(piece.sizes)
                for column, values in zip(out[1:], (known.astype(np.int64), base, kn), strict=True):
                    column.append(np.add.reduceat(values, starts))
            n, n_known, base, kn = [np.concatenate(x) if x else np.zeros(0) for x in out]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array(n.astype(np.int64)),
                    pa.array(n_known.astype(np.int64)),
                    pa.array(np.full(len(n), tokens, np.int64)),
                    pa.array(base.astype(float)),
                    pa.array(kn.astype(float)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return rows.mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
