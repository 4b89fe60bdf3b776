"""Ranked search, byte-level BPE and hard negatives against plain Python and tiktoken."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.llm import bpe, negatives, queries, ranked

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Ranked search


def plain_ranking(docs: list[tuple], items: list[tuple], k: int) -> set[tuple]:
    held = [(d, [t.translate(ASCII_LOWER) for t in TERM.findall(text or "")]) for d, text in docs]
    held = [(d, Counter(words)) for d, words in held if words]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    out = set()
    for item, text in set(items):
        wanted = Counter(t.translate(ASCII_LOWER) for t in TERM.findall(text or ""))
        scores = []
        for doc, counts in held:
            m = 100 - 75 + (75 * sum(counts.values()) * n_docs) // total
            score = 0
            for term, repeats in wanted.items():
                if counts[term]:
                    df = sum(1 for _, c in held if c[term])
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += repeats * w * ((1_000_000_000 * counts[term]) // (1000 * counts[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out |= {(item, r + 1, None if gone else d, -s) for r, (s, gone, d) in enumerate(sorted(scores)[:k])}
    return out


def rows_of(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(("share", "block"), [(ranked.SHARE, ranked.QUERY_TERMS), (40, 30)])
def test_ranking_is_that_of_plain_python(spark: SparkSession, share: int, block: int) -> None:
    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["É", "ünder", "a1"]

    def text(n: int) -> str:
        return " ".join(draw.choice(words[: draw.choice([5, 20, 63])]).upper() for _ in range(n))

    docs = [(i, text(draw.choice([1, 3, 30, 200]))) for i in range(150)]
    docs += [(200, docs[3][1]), (3, docs[3][1]), (None, docs[3][1]), (None, docs[4][1]), (201, None), (202, " .,;"), (203, "")]
    items = [(i, text(draw.choice([1, 5, 25]))) for i in range(12)]
    items += [(0, items[0][1]), (12, docs[3][1]), (13, None), (14, "..."), (15, "nowhere to be found")]
    found = rows_of(
        ranked.rank(
            spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(items, "item_id long, text string"),
            k=10,
            share=share,
            block=block,
        )
    )
    assert len(found) == len(set(found))
    assert set(found) == plain_ranking(docs, items, 10)


def test_search_stops_before_the_lists_end_and_keeps_ties() -> None:
    n = 5000
    impact = np.concatenate([np.arange(n, 0, -1), np.arange(n, 0, -1)])
    doc = np.concatenate([np.arange(n), np.arange(n)])
    term = np.repeat([0, 1], n)
    impact[:20] = impact[n : n + 20] = 10_000
    lists = ranked.Lists(np.arange(n), term, doc, impact, 2)
    docs, scores, read = ranked.search(lists, np.array([0, 1]), np.array([1, 1]), 10, 0)
    # Twenty documents share the best score: none may be lost before ids settle the ties.
    assert sorted(docs.tolist()) == list(range(20)) and set(scores.tolist()) == {20_000}
    assert read < n // 20


def test_look_ups_move_best_positions() -> None:
    """The first list's postings are all found by look-ups from the second, so it is not read to its end."""
    n = 400
    doc = np.concatenate([np.arange(n), np.arange(n)])
    impact = np.concatenate([np.full(n, 7), np.full(n, 7)])
    lists = ranked.Lists(np.arange(n), np.repeat([0, 1], n), doc, impact, 2)
    docs, _, read = ranked.search(lists, np.array([0, 1]), np.array([1, 1]), 3, 0)
    assert len(docs) == n and read <= 2 * n


def test_ranking_of_odd_input(odd_docs: DataFrame, no_docs: DataFrame) -> None:
    items = odd_docs.select(F.lit("x").alias("item_id"), "text", "score").where("doc_id = 6")
    found = rows_of(ranked.rank(odd_docs, items))
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(found, key=repr) == sorted(plain_ranking(docs, [("x", docs[-1][1])], 10), key=repr)
    assert [r[2] for r in found][:2] == [6, None]
    assert rows_of(ranked.rank(no_docs, items)) == []
    assert rows_of(ranked.rank(odd_docs, items.where("false"))) == []
    assert rows_of(ranked.rank(odd_docs, items.withColumn("item_id", F.lit(None).cast("long")))) == []


# Byte-level BPE


@pytest.fixture(scope="module")
def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary.read(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary: bpe.Vocabulary) -> tiktoken.Encoding:
    ranks = {token: rank for rank, token in enumerate(vocabulary.tokens)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_finds_every_token(vocabulary: bpe.Vocabulary) -> None:
    whole = vocabulary.whole
    assert whole.find(vocabulary.tokens).tolist() == list(range(len(vocabulary.tokens)))
    assert sorted(whole.order.tolist()) == list(range(len(vocabulary.tokens)))
    strangers = [b"not a token %d" % i for i in range(1000)]
    assert all(r < 0 or vocabulary.tokens[r] != s for r, s in zip(whole.find(strangers), strangers, strict=True))
    assert bpe.PerfectHash.over([]).find([b"x"]).tolist() == [-1]


def encoded(vocabulary: bpe.Vocabulary, texts: list[str]) -> list[list[int]]:
    out = []
    for _, sizes, ids in bpe.Encoder(vocabulary).encode(texts):
        ends = np.cumsum(sizes)
        out += [ids[e - s : e].tolist() for s, e in zip(sizes, ends, strict=True)]
    return out


def test_ids_are_those_of_tiktoken(
    vocabulary: bpe.Vocabulary, reference: tiktoken.Encoding, documents: list, monkeypatch: pytest.MonkeyPatch
) -> None:
    draw = random.Random(3)
    letters = list("aabcde'st  \n\t0019.,!?éß漢字😀  \x1c\x85") + ["'ll", "<|endoftext|>", "aaaa", "\r\n"]
    texts = ["".join(draw.choices(letters, k=draw.choice([0, 1, 5, 40, 300]))) for _ in range(500)]
    texts += ["a" * 10_000, " " * 10_000, "\n \n" * 500, "x" * 50 + " y" * 9000]
    texts += [r["text"] or "" for r in documents]
    expected = reference.encode_ordinary_batch(texts)
    assert encoded(vocabulary, texts) == expected
    # The same through many groups, cuts of long texts, and a worker that forgets.
    monkeypatch.setattr(bpe, "GROUP_CHARS", 100)
    monkeypatch.setattr(bpe, "KNOWN", 50)
    assert encoded(vocabulary, texts) == expected


def test_round_trip_of_odd_input(
    odd_docs: DataFrame, no_docs: DataFrame, vocabulary: bpe.Vocabulary, reference: tiktoken.Encoding
) -> None:
    docs = odd_docs.select("doc_id", "text").collect()
    found = bpe.decode(bpe.encode(odd_docs, vocabulary), vocabulary).collect()
    expected = [(r["doc_id"], reference.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()) for r in docs]
    assert [(r["doc_id"], r["ids"], bytes(r["decoded"])) for r in found] == expected
    assert bpe.decode(bpe.encode(no_docs, vocabulary), vocabulary).collect() == []


def test_decoding_of_unknown_ids(spark: SparkSession, vocabulary: bpe.Vocabulary, monkeypatch: pytest.MonkeyPatch) -> None:
    monkeypatch.setattr(bpe, "GROUP_IDS", 2)
    rows = [(1, [10, -1, 10**6, None, 11]), (2, None), (3, [])]
    found = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), vocabulary).collect()
    assert [bytes(r["decoded"]) for r in found] == [vocabulary.tokens[10] + vocabulary.tokens[11], b"", b""]


def test_bpe_query(spark: SparkSession, sf: str, documents: list, reference: tiktoken.Encoding) -> None:
    expected = set()
    for r in documents:
        ids = reference.encode_ordinary(r["text"] or "")
        listed = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.add((r["doc_id"], len(ids), listed, hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert set(rows_of(queries.op12_byte_bpe(spark, sf))) == expected


# Hard negatives


def plain_negatives(rows: list[tuple], is_anchor, positives: int, negatives_: int) -> list[tuple]:
    kept = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]

    def dot(a: list[int], b: list[int]) -> int:
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for i, label, v in {(i, label, tuple(v)) for i, label, v in kept if is_anchor(i)}:
        scored = [(-dot(v, w), j, other) for j, other, w in kept if j != i]
        near = sorted((s, j) for s, j, other in scored if other == label)[:positives]
        for s, j in near:
            fit = sorted((t, k) for t, k, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s)
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(fit[:negatives_])]
    return sorted(out)


def random_vectors(seed: int, n: int, width: int) -> list[tuple]:
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = draw.randrange(4)
        rows.append((i, draw.choice([c, c, draw.randrange(4)]), [x + draw.gauss(0, 0.4) for x in centres[c]]))
    return rows


@pytest.mark.parametrize(("block", "blocks", "anchors"), [(128, 32, 1024), (4, 2, 3)])
def test_negatives_are_those_of_plain_python(
    spark: SparkSession, monkeypatch: pytest.MonkeyPatch, block: int, blocks: int, anchors: int
) -> None:
    monkeypatch.setattr(negatives, "BLOCKS", blocks)
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    rows = random_vectors(1, 160, 12)
    # Ties, repeated candidates, an anchor given twice, one id with two vectors, odd vectors.
    rows += [(300 + i, 1, rows[5][2]) for i in range(8)] + [rows[7], rows[10], (20, 2, rows[3][2])]
    rows += [(None, 1, rows[1][2]), (401, None, rows[1][2]), (402, 1, None), (403, 1, [1.0, None]), (404, 1, [math.nan])]
    rows += [(410, 1, [math.inf, 0.0]), (411, 2, rows[2][2][:5]), (420, 3, []), (430, 0, [0.0] * 12)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    frame = frame.withColumn("score", F.lit("mine")).withColumn("block", F.lit(1))
    ready = negatives.vectors(frame, "vec_id", "embedding", F.col("label"), 256.0)
    found = rows_of(negatives.mine(ready, lambda i: i % 10 == 0, block=block))
    assert sorted(found) == plain_negatives(rows, lambda i: i % 10 == 0, 5, 10)


def test_negatives_of_huge_components_are_exact(spark: SparkSession) -> None:
    rows = [(0, 0, [2.0**20, 3.0]), (1, 0, [2.0**20, 1.0]), (2, 1, [2.0**19, 1.0]), (3, 1, [2.0**19, 2.0])]
    ready = negatives.vectors(
        spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), "vec_id", "embedding", F.col("label"), 256.0
    )
    assert sorted(rows_of(negatives.mine(ready, lambda i: i == 0))) == plain_negatives(rows, lambda i: i == 0, 5, 10)


def test_negatives_of_nothing(spark: SparkSession) -> None:
    none = spark.createDataFrame([], "id long, label long, terms array<long>")
    assert rows_of(negatives.mine(none, lambda i: i == 0)) == []
    alone = spark.createDataFrame([(0, 1, [1])], "id long, label long, terms array<long>")
    assert rows_of(negatives.mine(alone, lambda i: i == 0)) == []


@pytest.mark.parametrize(("width", "bits"), [(2, 4), (3, 3), (5, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(width: int, bits: int) -> None:
    points = np.stack(np.meshgrid(*[np.arange(2**bits)] * width), -1).reshape(-1, width)
    index = negatives.hilbert(points, bits)
    ordered = points[np.argsort(index)]
    assert sorted(index.tolist()) == list(range(len(points)))
    assert (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()


def test_blocks_out_of_reach_are_not_read() -> None:
    import pyarrow as pa

    longs = pa.list_(pa.int64())
    asked = pa.table({
        "anchor": [1], "id": [1], "label": [0], "same": [False], "terms": pa.array([[10, -10]], longs),
        "lows": pa.array([[50]], longs), "highs": pa.array([[100]], longs),
    })
    zones = pa.table({
        "block": [7, 8, 9, 10],
        "low": pa.array([[0, 0], [5, 0], [20, 0], [5, 0]], longs),
        "high": pa.array([[4, 1], [9, 2], [30, 1], [9, 2]], longs),
        "labels": pa.array([[1], [0, 1], [1], [0]], longs),
    })
    # Scores of block 7 end at 40, those of 9 begin at 190, 10 has the anchor's label only.
    assert negatives._choose(asked, zones).to_pydict() == {"block": [8], "anchors": [[0]]}
