"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds the substrings of a bounded sample of labelled
text. A text is parsed greedily into phrases, each the longest match that the automaton can
follow; the better the language fits, the fewer phrases. Phrases times the logarithm of the
sample's length, over the length of the text, estimate the cross entropy; the smallest wins.

Texts are parsed in pieces of ``PIECE`` characters, many side by side: all pieces of a batch
advance by one character at a time, and no phrase crosses pieces. Every character of every
text is parsed.

Defined results: ``und`` with score 0 for a null text, one without a letter, or if nothing was
learned. Ties go to the language first in code point order. score is the runner-up's share of
the two best entropies, scaled to 0..1: 0 for a tie, near 1 for a text the winner knows by
heart and the other doesn't; 1 if there is one language. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import fold, join_counted, stored

UNKNOWN = "und"
#: The bound of the labelled sample: characters learned per language.
SAMPLE_CHARS = 20_000
#: Characters of one text that may enter the sample, so that no text fills it alone. They begin
#: at a place that the text's hash chooses.
SAMPLE_SHARE = 2_000
#: The sample is drawn from so many times its characters.
MARGIN = 4
PIECE = 512
_BATCH_CHARS = 4_000_000

_LETTER = regex.compile(r"\p{L}")
_NO_LETTERS = regex.compile(r"\P{L}+")


def samples(docs: DataFrame, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Text per language, from rows with a lang: the different texts of smallest hash, until
    they have ``chars`` characters or there are no more."""
    labelled = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0)).withColumn("h", F.xxhash64("text"))
    begin = F.pmod("h", F.greatest(F.length("text") - SAMPLE_SHARE, F.lit(0)) + 1).cast("int")
    pieces = labelled.select("lang", "h", F.substring("text", begin + 1, F.lit(SAMPLE_SHARE)).alias("t"))
    size = F.length(F.trim(F.regexp_replace("t", r"[^\p{L}]+", " ")))
    # Copies of a text have one hash and count once.
    texts = stored(pieces.select("lang", "h", size.alias("size")).where(F.col("size") > 0).distinct(), "langid-texts")
    totals = stored(texts.groupBy("lang").agg(F.sum("size").alias("total")), "langid-totals")
    place = F.col("h").cast("double") / float(2**64) + 0.5
    margin = MARGIN
    while True:
        # Each task takes its part by itself: hashes below the share that is wanted.
        near = join_counted(texts, totals, ["lang"]).where(place * F.col("total") <= margin * chars)
        rows = sorted((r["lang"], r["h"], r["size"], r["total"]) for r in near.collect())
        have: dict[str, int] = {}
        chosen = []
        for lang, h, n, _ in rows:
            if have.setdefault(lang, 0) < chars:
                have[lang] += n + 1
                chosen.append((lang, h))
        short = [r["lang"] for r in totals.collect() if have.get(r["lang"], 0) < chars and r["total"] > margin * chars]
        if not short:
            break
        margin *= MARGIN
    wanted = docs.sparkSession.createDataFrame(chosen, "lang string, h long")
    taken = join_counted(pieces, wanted, ["lang", "h"], "left_semi", len(chosen))
    found: dict[str, str] = {}
    for row in sorted(taken.distinct().collect(), key=lambda r: (r["lang"], r["h"])):
        text = (found.get(row["lang"], "") + " " + _NO_LETTERS.sub(" ", row["t"].lower()))[:chars]
        found[row["lang"]] = text
    return {lang: text for lang, text in found.items() if _LETTER.search(text)}


def automaton(symbols: np.ndarray, width: int) -> np.ndarray:
    """Transitions of the suffix automaton: states x width, -1 where there is none."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols.tolist():
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    table = np.full((len(follow), width), -1, np.int32)
    for state, out in enumerate(follow):
        if out:
            table[state, list(out)] = list(out.values())
    return table


class Languages:
    """The automata of all languages over one alphabet."""

    def __init__(self, texts: dict[str, str]):
        self.langs = sorted(texts)
        letters = sorted(set("".join(texts.values())))
        # Symbol 0 is any character that no sample has: it ends a phrase.
        self.codes = np.zeros(max(map(ord, letters), default=0) + 2, np.uint8 if len(letters) < 255 else np.int32)
        for symbol, letter in enumerate(letters, 1):
            self.codes[ord(letter)] = symbol
        self.tables = [
            automaton(self.codes[np.array([ord(x) for x in texts[lang]])].astype(int), len(letters) + 1)
            for lang in self.langs
        ]
        self.bits = np.array([np.log2(max(2, len(texts[lang]))) for lang in self.langs])

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases per language and text; every text has a character at least."""
        symbols = [
            self.codes[np.minimum(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32), len(self.codes) - 1)]
            for t in texts
        ]
        sizes = np.array([len(s) for s in symbols])
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        rows = np.zeros((int(pieces.sum()), PIECE), symbols[0].dtype)
        long = np.zeros(len(rows), np.int64)
        at = 0
        for s, n in zip(symbols, pieces.tolist(), strict=True):
            rows[at : at + n].reshape(-1)[: len(s)] = s
            long[at : at + n] = PIECE
            long[at + n - 1] = len(s) - (n - 1) * PIECE
            at += n
        # Long pieces first: those still running are a prefix at every step.
        order = np.argsort(-long, kind="stable")
        columns, long = np.ascontiguousarray(rows[order].T), long[order]
        running = np.searchsorted(-long, -np.arange(PIECE), "left")
        out = np.empty((len(self.langs), len(texts)), np.int64)
        for k, table in enumerate(self.tables):
            flat, width = table.reshape(-1), table.shape[1]
            state = np.zeros(len(rows), np.int32)
            # The first character begins the first phrase.
            count = np.ones(len(rows), np.int64)
            for j in range(PIECE):
                n = int(running[j])
                if not n:
                    break
                symbol = columns[j, :n]
                to = flat[state[:n] * width + symbol]
                stuck = np.flatnonzero(to < 0)
                if len(stuck):
                    if j:
                        # At the root nothing was begun, so nothing ends.
                        count[stuck] += state[stuck] > 0
                    to[stuck] = flat[symbol[stuck]]
                    alone = stuck[to[stuck] < 0]
                    to[alone] = 0
                    count[alone] += j + 1 < long[alone]
                state[:n] = to
            out[k] = np.bincount(owner[order], weights=count, minlength=len(texts)).astype(np.int64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return langs, scores
        wanted = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        at = 0
        while at < len(wanted):
            chars, stop = 0, at
            while stop < len(wanted) and (stop == at or chars + len(texts[wanted[stop]]) <= _BATCH_CHARS):
                chars += len(texts[wanted[stop]])
                stop += 1
            part = wanted[at:stop]
            plain = [_NO_LETTERS.sub(" ", texts[i].lower()) for i in part]
            entropy = self.phrases(plain) * self.bits[:, None] / np.array([len(t) for t in plain])
            ranked = np.sort(entropy, axis=0)
            best = entropy.argmin(axis=0)
            for j, i in enumerate(part):
                langs[i] = self.langs[best[j]]
                scores[i] = 1.0 if len(ranked) < 2 else float(1 - ranked[0, j] / ranked[1, j])
            at = stop
        return langs, scores


def identify(docs: DataFrame, train_on: int = 3) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row of (doc_id, text, lang).

    Learns from rows whose ``fold`` by ``train_on`` is not 1.
    """
    spark = docs.sparkSession
    held_out = fold(F.col("doc_id"), train_on) == 1
    model = spark.sparkContext.broadcast(Languages(samples(docs.where(~held_out))).__dict__)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = Languages.__new__(Languages)
        languages.__dict__ = model.value
        for batch in batches:
            langs, scores = languages.predict(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
