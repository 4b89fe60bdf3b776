"""Byte-level BPE: texts to token ids and back, with the ranks of a public vocabulary.

A text is cut into pieces by the vocabulary's pattern, and each piece is encoded on its own, in two
tiers:

    1. a minimal perfect hash over the tokens: a piece that is a token as a whole is resolved by
       one probe and one comparison of bytes
    2. a piece that is none starts as a chain of its bytes; a heap gives the neighbours whose
       joined bytes have the lowest rank, leftmost first, which become one link, until no two
       neighbours are a token

Pieces repeat, so the pieces of some two million characters are made distinct, probed together
in numpy, and what a worker has encoded it keeps for the next texts, up to ``KNOWN`` pieces.
The vocabulary is read by the driver and broadcast; its size is bounded by its file. Documents are
neither shuffled nor collected.

The pattern's letter and number classes are those of the installed `regex`; code points that
younger versions of Unicode added may be classed otherwise by older tokenizers.

Defined results: null and empty texts have no tokens, and decode to no bytes. Texts are encoded
whole; long ones are cut for the pattern only where white space follows something else, which
always ends a piece. Special tokens are ordinary text. Repeated rows give a row each; null ids stay
null; other columns are ignored. Ids that the vocabulary lacks decode to no bytes.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.llm.arrays import mixed

#: Characters whose pieces are held at once, and encoded pieces that a worker keeps.
GROUP_CHARS = 1 << 21
KNOWN = 1 << 19
#: Bytes or ids after which decoding hands on what it has.
GROUP_IDS = 1 << 21

#: Tokens to a bucket of the perfect hash, and displacements tried at once.
BUCKET = 4
TRIES = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0 to {len(ranks) - 1}")
    return [ranks[i] for i in range(len(ranks))]


@dataclass(frozen=True)
class PerfectHash:
    """A place of its own for every key, and no place left over.

    Keys are dealt into buckets by their hash. A bucket has a displacement that sends its keys to
    free places; a bucket of one key names its place instead (as a negative number).
    """

    seed: int
    buckets: np.ndarray
    hashes: np.ndarray
    order: np.ndarray

    @staticmethod
    def over(keys: list[bytes]) -> PerfectHash:
        n = len(keys)
        if len(set(keys)) < n:
            raise ValueError("keys are repeated")
        seed = 0
        while len(np.unique(found := _hashes(keys, seed))) < n:
            seed += 1
        number = max(1, -(-n // BUCKET))
        bucket = (found % np.uint64(number)).astype(np.int64)
        members = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=number)
        ends = np.cumsum(sizes)
        displacement = np.zeros(number, np.int64)
        place = np.full(n, -1, np.int64)
        taken = np.zeros(n, bool)
        by_size = np.argsort(-sizes, kind="stable")
        for b in by_size[: int((sizes > 1).sum())]:
            mine = members[ends[b] - sizes[b] : ends[b]]
            displacement[b], at = _free_places(found[mine], taken)
            taken[at] = True
            place[mine] = at
        single = np.flatnonzero(sizes == 1)
        rest = np.flatnonzero(~taken)
        displacement[single] = -rest - 1
        place[members[ends[single] - 1]] = rest
        order = np.empty(n, np.int64)
        order[place] = np.arange(n)
        return PerfectHash(seed, displacement, found[order], order)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The number of the key with the same hash as each given one, or -1."""
        if not keys or not len(self.order):
            return np.full(len(keys), -1, np.int64)
        found = _hashes(keys, self.seed)
        step = self.buckets[(found % np.uint64(len(self.buckets))).astype(np.int64)]
        at = np.where(step < 0, -step - 1, _place(found, step, len(self.order)))
        return np.where(self.hashes[at] == found, self.order[at], -1)


def _hashes(keys: list[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(k, seed) for k in keys), np.uint64, len(keys))


def _place(hashes: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    spread = mixed(hashes ^ (displacement.astype(np.uint64) * _STEP))
    return (spread % np.uint64(n)).astype(np.int64)


def _free_places(hashes: np.ndarray, taken: np.ndarray) -> tuple[int, np.ndarray]:
    first = 0
    while True:
        tried = np.arange(first, first + TRIES)
        at = _place(hashes[None, :], tried[:, None], len(taken))
        ordered = np.sort(at, axis=1)
        good = ~taken[at].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
        if good.any():
            found = int(np.argmax(good))
            return first + found, at[found]
        first += TRIES


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by rank, their perfect hash, and the pattern that cuts texts into pieces."""

    tokens: list[bytes]
    whole: PerfectHash
    pattern: str

    @staticmethod
    def read(path: str, pattern: str) -> Vocabulary:
        tokens = read_ranks(path)
        return Vocabulary(tokens, PerfectHash.over(tokens), pattern)


def merged_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: a heap over its linked bytes, lowest rank first, then leftmost."""
    n = len(piece)
    # A link is named by where it starts; end is 0 for links that were joined to one before.
    end = list(range(1, n + 1))
    before = list(range(-1, n))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, at, stop = heappop(heap)
        middle = end[at]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[at], end[middle] = stop, 0
        before[stop] = at
        left = before[at]
        if left >= 0 and (r := ranks.get(piece[left:stop])) is not None:
            heappush(heap, (r, left, stop))
        if stop < n and (r := ranks.get(piece[at : end[stop]])) is not None:
            heappush(heap, (r, at, end[stop]))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class Encoder:
    """Encodes texts in one worker."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.tokens, self.whole = vocabulary.tokens, vocabulary.whole
        self.ranks = {token: rank for rank, token in enumerate(self.tokens)}
        self.cut = regex.compile(vocabulary.pattern).findall
        self.ending = regex.compile(r"\S\s").search
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.sizes = array("i"), array("q"), array("q")

    def _learn(self, pieces: Iterable[str]) -> None:
        fresh = [p for p in pieces if p not in self.known]
        if len(self.known) + len(fresh) > KNOWN:
            self._forget()
            fresh = list(pieces)
        raw = [p.encode("utf-8") for p in fresh]
        for piece, data, rank in zip(fresh, raw, self.whole.find(raw).tolist(), strict=True):
            # Equal hashes are no proof: the bytes are compared.
            found = [rank] if rank >= 0 and self.tokens[rank] == data else merged_bytes(data, self.ranks)
            self.known[piece] = len(self.starts)
            self.starts.append(len(self.ids))
            self.sizes.append(len(found))
            self.ids.extend(found)

    def _sections(self, text: str) -> Iterator[str]:
        """A text in sections that end where a piece ends."""
        at = 0
        while len(text) - at > GROUP_CHARS and (found := self.ending(text, at + GROUP_CHARS - 1)):
            yield text[at : found.start() + 1]
            at = found.start() + 1
        yield text[at:]

    def _group(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and the ids of all."""
        pieces: list[str] = []
        ends = []
        for text in texts:
            pieces += self.cut(text)
            ends.append(len(pieces))
        self._learn(set(pieces))
        number = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        sizes = np.array(self.sizes, np.int64)[number]
        total = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(np.array(self.starts, np.int64)[number] - total[:-1], sizes) + np.arange(total[-1])
        return np.diff(total[ends], prepend=0), np.array(self.ids, np.int32)[at]

    def encode(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of texts, ids of each, all ids) for groups of texts."""
        group: list[str] = []
        chars = 0
        for text in texts:
            if len(text) > GROUP_CHARS:
                if group:
                    yield len(group), *self._group(group)
                parts = [self._group([section])[1] for section in self._sections(text)]
                ids = np.concatenate(parts)
                yield 1, np.array([len(ids)]), ids
                group, chars = [], 0
                continue
            group.append(text)
            chars += len(text)
            if chars > GROUP_CHARS:
                yield len(group), *self._group(group)
                group, chars = [], 0
        if group:
            yield len(group), *self._group(group)


_latest: list[Encoder] = []


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """The worker's encoder; tasks that follow one another share what it knows."""
    if not _latest or _latest[0].vocabulary is not vocabulary:
        _latest[:] = [Encoder(vocabulary)]
    return _latest[0]


def _lists(sizes: np.ndarray, values: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32, copy=False)))


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids (array of int) per row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            at = 0
            for n, sizes, ids in encoder.encode(texts):
                yield pa.RecordBatch.from_arrays([batch["doc_id"][at : at + n], _lists(sizes, ids)], ["doc_id", "ids"])
                at += n

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, ids, decoded (binary) per row of (doc_id, ids)."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary.tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        blob = np.frombuffer(b"".join(known), np.uint8)
        # The last entry, without bytes, stands for ids that are not known.
        sizes = np.array([*map(len, known), 0], np.int64)
        starts = np.cumsum(sizes) - sizes
        for batch in batches:
            for part in _by_ids(batch):
                lists = part["ids"]
                ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = np.where((ids < 0) | (ids >= len(known)), len(known), ids)
                size = sizes[ids]
                total = np.concatenate([[0], np.cumsum(size)])
                at = np.repeat(starts[ids] - total[:-1], size) + np.arange(total[-1])
                held = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = total[np.concatenate([[0], np.cumsum(held)])].astype(np.int32)
                data = pa.Array.from_buffers(
                    pa.binary(), len(held), [None, pa.py_buffer(ends), pa.py_buffer(blob[at])]
                )
                yield pa.RecordBatch.from_arrays([part["doc_id"], lists, data], ["doc_id", "ids", "decoded"])

    rows = tokens.select("doc_id", "ids")
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def _by_ids(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about GROUP_IDS ids."""
    ends = np.cumsum(batch["ids"].value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        held = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, held + GROUP_IDS, "right")))
        yield batch.slice(at, stop - at)
        at = stop
