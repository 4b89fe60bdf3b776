"""Toxicity by subword-bag embeddings and a linear softmax.

A word is the bag of its character n-grams, with marks for its beginning and end; its vector
is the mean of their embeddings. A text's vector is the mean over its words, times a fixed
scale, and a softmax over two classes reads it. Embeddings and softmax are trained together by
gradient descent in numpy, so a misspelling never seen shares the vectors of the n-grams it has
in common with known words.

Softmax and means are linear, so a trained model is one number per n-gram bucket: a word's
score is the mean over its n-grams, a text's the mean over all its words. Every word counts.

Training reads a bounded sample: of either class about ``PER_CLASS`` labelled texts (each by its
own hash, so a few more or less), or all if there are fewer, each text whole. Scoring reads all texts.

Defined results: a text without words (null, empty) gets the score of the bias alone. Without
labels of both classes every score is the share of toxic labels (0 without labels). Several
labels of one doc_id: toxic if any says so; null labels don't count. Repeated rows score alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import fold, join_counted

THRESHOLD = 0.7
#: The bound of the labelled sample: the expected number of texts per class.
PER_CLASS = 3000
BUCKETS = 1 << 20
DIMENSIONS = 2
#: Lengths of the n-grams.
GRAMS = (3, 4, 5)
#: Words that fewer sampled texts hold do not enter training (their n-grams still score).
LEAST_TEXTS = 2
#: Log-odds where nothing is labelled.
NO_LABELS = -50.0
SCALE = 30.0
#: Words of the parts in which clean texts enter training.
PART = 24
STEPS = 150
RATE = 1.0
#: Different words that a task remembers; beyond, it begins anew.
MEMORY = 200_000
#: Words whose n-grams a task cuts at once.
CUT = 10_000

_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def subwords(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, word after word, and the number of them per word."""
    marked = "".join([f"<{w}>" for w in vocabulary])
    letters = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary)) + 2
    ends = np.repeat(np.cumsum(sizes), sizes)
    owners = np.repeat(np.arange(len(vocabulary)), sizes)
    at = np.arange(len(letters))
    found, of = [], []
    code = np.zeros(len(letters), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        shifted = np.zeros(len(letters), np.uint64)
        shifted[: len(letters) - n + 1] = letters[n - 1 :]
        code = code * np.uint64(0x100000001B3) + shifted + np.uint64(1)
        if n in GRAMS:
            inside = at + n <= ends
            mixed = code[inside] * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(40)).astype(np.int64) % BUCKETS)
            of.append(owners[inside])
    grams, owner = np.concatenate(found), np.concatenate(of)
    order = np.argsort(owner, kind="stable")
    return grams[order], np.bincount(owner, minlength=len(vocabulary))


def _means(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means of consecutive groups of ``counts`` rows; 0 for empty groups."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    ends = np.cumsum(counts)
    sums = total[ends] - total[ends - counts]
    return sums / np.maximum(counts, 1).reshape(-1, *[1] * (values.ndim - 1))


#: Entries of the sparse matrix that are multiplied at once.
_ENTRIES = 1 << 18


def _product(to: np.ndarray, of: np.ndarray, weight: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sparse matrix (entries at ``to``, ``of``) times each row of ``values``, a slice of entries at a time."""
    out = np.zeros((len(values), size))
    for at in range(0, len(to), _ENTRIES):
        part = slice(at, at + _ENTRIES)
        # Entries are ordered by text: a slice goes to few of them.
        low = int(to[part].min())
        for d, row in enumerate(values):
            sums = np.bincount(to[part] - low, row[of[part]] * weight[part])
            out[d, low : low + len(sums)] += sums
    return out


def _matrix(texts: Iterable[str], toxic: Iterable[int]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, classes of the parts, and entries: part, word, share of the part's words."""
    place: dict[str, int] = {}
    held_by: list[np.ndarray] = []
    classes: list[int] = []
    for t, label in zip(texts, toxic, strict=True):
        ids = np.array([place.setdefault(w, len(place)) for w in words(t)], np.int64)
        # Any part of a clean text is clean: parts teach that no word alone may tip a short text.
        size = len(ids) if label else PART
        for at in range(0, max(1, len(ids)), max(1, size)):
            part = ids[at : at + size]
            held_by.append(np.stack(np.unique(part, return_counts=True)).astype(np.int32))
            classes.append(int(label))
    text_of = np.repeat(np.arange(len(classes), dtype=np.int32), [h.shape[1] for h in held_by])
    word_of, times = np.concatenate([*held_by, np.zeros((2, 0), np.int32)], axis=1)
    del held_by
    weight = times / np.bincount(text_of, times, len(classes))[text_of]
    known = np.bincount(word_of, minlength=len(place)) >= LEAST_TEXTS
    kept = known[word_of]
    number = (np.cumsum(known) - 1).astype(np.int32)
    vocabulary = [w for w, k in zip(place, known, strict=True) if k]
    return vocabulary, np.array(classes), text_of[kept], number[word_of[kept]], weight[kept]


def train(
    texts: Iterable[str], toxic: Iterable[int], steps: int = STEPS, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Scores per bucket and the bias: log-odds of a text are bias + mean over its words.

    Texts are read once and not kept.
    """
    vocabulary, toxic, text_of, word_of, weight = _matrix(texts, toxic)
    share = float(np.clip(toxic.mean(), 1e-3, 1 - 1e-3)) if len(toxic) else 0.0
    if not len(toxic) or toxic.min() == toxic.max() or not vocabulary:
        return np.zeros(BUCKETS), float(np.log(share / (1 - share))) if share else NO_LABELS
    grams, counts = subwords(vocabulary)
    gram_word = np.repeat(np.arange(len(vocabulary)), counts)
    gram_weight = 1.0 / np.maximum(counts, 1)[gram_word]
    random = np.random.default_rng(seed)
    params = {
        "embedding": random.normal(0, 1e-3, (DIMENSIONS, BUCKETS)),
        "softmax": random.normal(0, 0.5, (DIMENSIONS, 2)),
        "bias": np.log(np.array([1 - share, share])),
    }
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    target = np.stack([1 - toxic, toxic], axis=1).astype(float)
    # Both classes weigh the same, whatever their share of the sample.
    balance = np.where(toxic == 1, 0.5 / toxic.sum(), 0.5 / (1 - toxic).sum())[:, None]
    for step in range(1, steps + 1):
        e, u = params["embedding"], params["softmax"]
        word_vec = np.stack(
            [np.bincount(gram_word, e[d][grams] * gram_weight, len(vocabulary)) for d in range(DIMENSIONS)]
        )
        text_vec = SCALE * _product(text_of, word_of, weight, word_vec, len(toxic))
        logits = text_vec.T @ u + params["bias"]
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = (odds / odds.sum(axis=1, keepdims=True) - target) * balance
        text_grad = SCALE * (error @ u.T).T
        word_grad = _product(word_of, text_of, weight, text_grad, len(vocabulary))
        grads = {
            "embedding": np.stack(
                [np.bincount(grams, word_grad[d][gram_word] * gram_weight, BUCKETS) for d in range(DIMENSIONS)]
            ),
            "softmax": text_vec @ error,
            "bias": error.sum(axis=0),
        }
        rate = 1 - (step - 1) / steps
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
            params[k] = params[k] - rate * move * (RATE if k == "embedding" else 0.1)
    direction = params["softmax"][:, 1] - params["softmax"][:, 0]
    return SCALE * (direction @ params["embedding"]), float(params["bias"][1] - params["bias"][0])


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, toxic, text of the bounded training sample; labels other than 0 and 1 don't count."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    keyed = docs.where(F.col("text").isNotNull()).select("doc_id").distinct()
    labelled = keyed.join(known, "doc_id")
    sizes = {r["toxic"]: r["count"] for r in labelled.where("toxic IN (0, 1)").groupBy("toxic").count().collect()}
    # Each task takes its part by itself: ids whose hash is below the share that is wanted.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(2**32)) / F.lit(float(2**32))
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col("toxic") == value, per_class / n).otherwise(share)
    chosen = labelled.where(place < share)
    rows = join_counted(docs.select("doc_id", "text"), chosen, ["doc_id"])
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _fit(_: tuple, rows: pa.Table) -> pa.Table:
    # In an order of their own, so that reruns agree; one text at a time becomes a string.
    rows = rows.combine_chunks().sort_by("doc_id")
    weights, bias = train((t.as_py() for t in rows["text"]), (y.as_py() for y in rows["toxic"]))
    return pa.table({"weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary()), "bias": [bias]})


def scorer(weights: np.ndarray, bias: float):
    """A function from texts to probabilities, which remembers words it has seen."""
    place: dict[str, int] = {}
    store = np.zeros(1 << 12)

    def score(texts: list[str | None]) -> np.ndarray:
        nonlocal store
        if len(place) > MEMORY:
            place.clear()
        tokens = [words(t) for t in texts]
        new = list(dict.fromkeys(w for t in tokens for w in t if w not in place))
        if new:
            begin = len(place)
            while begin + len(new) > len(store):
                store = np.concatenate([store, np.zeros(len(store))])
            for at in range(0, len(new), CUT):
                part = new[at : at + CUT]
                grams, counts = subwords(part)
                store[begin + at : begin + at + len(part)] = _means(weights[grams], counts)
            place.update(zip(new, range(begin, begin + len(new)), strict=True))
        flat = np.fromiter((place[w] for t in tokens for w in t), np.int64)
        means = _means(store[flat], np.fromiter(map(len, tokens), np.int64, len(tokens)))
        return 1 / (1 + np.exp(-np.clip(bias + means, -50, 50)))

    return score


_SLICE_CHARS = 1_000_000


def _slices(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, chars = [], 0
    for t in texts:
        part.append(t)
        chars += len(t or "")
        if chars > _SLICE_CHARS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def _assessed(texts: pa.Array, assess) -> np.ndarray:
    found = [assess(part) for part in _slices(texts.to_pylist())]
    return np.concatenate(found) if found else np.zeros(0)


def learned(docs: DataFrame, labels: DataFrame, train_on: int) -> Broadcast:
    """The trained model, of fixed size, for tasks; trained in one of them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    train_rows = rows.where(fold(F.col("doc_id"), train_on) != 1)
    some = sample(train_rows, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"))
    # The sample is bounded, so one task holds it; the driver sees the model alone.
    fitted = some.groupBy(F.lit(0).alias("all")).applyInArrow(_fit, "weights binary, bias double").collect()
    if fitted:
        model = np.frombuffer(fitted[0]["weights"], np.float32), fitted[0]["bias"]
    else:
        model = np.zeros(BUCKETS, np.float32), NO_LABELS
    return docs.sparkSession.sparkContext.broadcast(model)


def score(docs: DataFrame, labels: DataFrame, train_on: int = 3, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted per row of (doc_id, text).

    Learns from labels of rows whose ``fold`` by ``train_on`` is not 1.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out: Column = fold(F.col("doc_id"), train_on) == 1
    model = learned(docs, labels, train_on)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assess = scorer(*model.value)
        for batch in batches:
            p = _assessed(batch["text"], assess)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return rows.withColumn("held_out", held_out).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def reject(docs: DataFrame, labels: DataFrame, train_on: int = 3, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    model = learned(docs, labels, train_on)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assess = scorer(*model.value)
        for batch in batches:
            yield batch.filter(pa.array(_assessed(batch["text"], assess) < threshold))

    return docs.mapInArrow(run, docs.schema)
