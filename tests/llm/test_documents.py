"""Document operators against plain Python, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flightloom.llm import common, decontamination, langid, lm, mixing, pii, queries, simhash, substrings, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def frame(spark, texts, **more):
    rows = [(i, t, more.get("lang"), more.get("source"), None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# --- language ----------------------------------------------------------------------


def test_language_of_held_out_documents(spark, sf, documents):
    found = {r["doc_id"]: r for r in queries.op1_language_id(spark, sf).collect()}
    assert len(found) == len(documents)
    held = [d for d in documents if zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1]
    assert {r["doc_id"] for r in found.values() if r["held_out"]} == {d["doc_id"] for d in held}
    assert sum(found[d["doc_id"]]["lang_pred"] == d["lang"] for d in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_phrases_are_those_of_a_greedy_parse():
    texts = {"x": "the cat sat on the mat ", "y": "le chat est sur le tapis "}
    languages = langid.Languages(texts)
    plain = ["the mat sat", "zzz cat", "q", "le chat " * 200]
    got = languages.phrases(plain)
    for lang, row in zip(languages.langs, got.tolist(), strict=True):
        for text, count in zip(plain, row, strict=True):
            n = 0
            for at in range(0, len(text), langid.PIECE):
                piece, i = text[at : at + langid.PIECE], 0
                while i < len(piece):
                    j = i + 1
                    if piece[i] in texts[lang]:
                        while j < len(piece) and piece[i : j + 1] in texts[lang]:
                            j += 1
                    i, n = j, n + 1
            assert count == n, (lang, text[:20])


def test_copies_and_beginnings_do_not_fill_the_language_sample(spark):
    copy = max(("the same words " + str(i) for i in range(100)), key=lambda t: -xxhash.xxh64(t, seed=42).intdigest() % 2**64)
    rows = [(i, copy, "en") for i in range(200)]
    head, tail = "boilerplate " * 200, "".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)} " for i in range(600))
    rows += [(300 + i, f"number {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]} of the texts", "en") for i in range(100)]
    rows += [(500 + i, f"{head}{tail * 3}{i}", "fr") for i in range(40)]
    found = langid.samples(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    # Texts are short here, so all different ones fit.
    assert found["en"].count("number") == 100 and found["en"].count("the same words") == 1
    assert len(found["fr"]) == langid.SAMPLE_CHARS and found["fr"].count("boilerplate") < len(found["fr"]) / 24


def test_language_of_odd_rows(odd_docs, no_docs):
    found = langid.identify(odd_docs).collect()
    assert len(found) == 10
    assert {r["lang_pred"] for r in found if r["doc_id"] in (1, 2, 5)} == {"und"}
    assert all(r["score"] == 0 for r in found if r["lang_pred"] == "und")
    assert langid.identify(no_docs).collect() == []


# --- decontamination ---------------------------------------------------------------


def contaminated(docs, items):
    windows = defaultdict(set)
    for item_id, text in items:
        w = WORDS.findall(small(text))
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add(str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = WORDS.findall(small(text))
        hit, ids = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    ids |= own
        out.append((doc_id, len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def found_by(docs, items):
    rows = decontamination.decontaminate(docs, items).collect()
    return sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in rows), key=repr
    )


def test_decontamination_of_short_and_repeated_items(spark, odd_docs, no_docs):
    long = " ".join(f"w{i}" for i in range(30))
    items = [(1, long), (2, "The Words of é ñ 漢字"), (10, long), (3, "same id"), (4, "more"), (5, None), (6, ""), (None, "text")]
    docs = [
        (r["doc_id"], r["text"])
        for r in odd_docs.collect()
    ] + [(20, f"x {long} y"), (21, " ".join(f"W{i}" for i in range(5, 19))), (22, "w0 w1 " * 50)]
    given = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    assert found_by(given, table) == contaminated(docs, [i for i in items if i[0] is not None])
    assert found_by(no_docs, table) == []
    nothing = found_by(given, table.where("false"))
    assert all(r[2:] == (0, [], False) for r in nothing) and len(nothing) == len(docs)
    kept = decontamination.clean(odd_docs, table)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(
        (d or -1) for d, *_, bad in contaminated([(r["doc_id"], r["text"]) for r in odd_docs.collect()], [i for i in items if i[0] is not None]) if not bad
    )


def test_windows_in_several_broadcast_parts(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    whole = found_by(docs, items)
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 4000)
    assert found_by(docs, items) == whole
    pairs = [[(r[0], r["text"]) for r in t.collect()] for t in (docs, items)]
    assert whole == contaminated(*pairs)


# --- mixing ------------------------------------------------------------------------


def targets(sizes: list[int], most: float = 3.0) -> list[float]:
    """By resharing what is above the limit, round by round."""
    open_, out, rest = list(range(len(sizes))), [0.0] * len(sizes), float(sum(sizes))
    weights = [1 + i % 3 for i in range(len(sizes))]
    while open_:
        share = rest / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * share > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = weights[i] * share
            break
        for i in over:
            out[i] = most * sizes[i]
            rest -= out[i]
        open_ = [i for i in open_ if i not in over]
    return out


@pytest.mark.parametrize("block", [4, 256])
def test_mix_meets_its_targets(spark, block):
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for source, n in (("a", 300), ("b", 3), ("é", 40), ("Z", 60), (None, 25)):
        for _ in range(n):
            rows.append((i, "w " * int(rng.lognormal(3, 1.2)), "en", source, None))
            i += 1
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs, block=block).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(i))
    source_of = {r[0]: r[3] for r in rows}
    size_of = {r[0]: len(r[1].split()) for r in rows}
    order = sorted({s for s in source_of.values() if s is not None}) + [None]
    per = [sum(size_of[d] for d in size_of if source_of[d] == s) for s in order]
    for s, total, want in zip(order, per, targets(per), strict=True):
        own = [r for r in got if source_of[r["doc_id"]] == s]
        assert all(r["size"] == size_of[r["doc_id"]] and r["source_size"] == total for r in own)
        assert all(math.isclose(r["target"], want) for r in own)
        assert all(r["copies"] in (math.floor(want / total), math.ceil(want / total)) for r in own if r["size"])
        taken = sum(r["copies"] * r["size"] for r in own)
        assert abs(taken - want) <= max(size_of[r["doc_id"]] for r in own)
    again = mixing.mix(docs.repartition(7), block=block).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_mix_of_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs.drop("size", "target", "copies")).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in odd_docs.collect())
    assert all(r["copies"] == 0 for r in got if r["size"] == 0)
    assert all(0 <= r["copies"] <= 3 for r in got)
    assert mixing.mix(no_docs).collect() == []


def test_many_rows_of_one_id_meet_in_many_blocks(spark):
    """Null and repeated ids, some of them with thousands of equal rows, are spread over the blocks."""
    ids = "CASE WHEN id % 3 = 0 THEN null WHEN id % 3 = 1 THEN 7 ELSE id END"
    text = "CASE WHEN id % 2 = 0 THEN 'one and the same text' ELSE repeat('w ', cast(1 + id % 9 AS int)) END"
    docs = spark.range(20_000).selectExpr(f"{ids} AS doc_id", "'en' AS lang", f"{text} AS text", "id % 2 = 1 AS small")
    docs = docs.selectExpr("doc_id", "text", "CASE WHEN small THEN 'a' ELSE 'b' END AS source")
    rows = mixing.numbered(mixing.sizes(docs), copies=100)
    assert rows.count() == 20_000 and rows.distinct().count() == 20_000
    assert rows.where("(row < 0) != (doc_id IS NULL)").count() == 0
    blocks = rows.groupBy("source", F.pmod(F.xxhash64("doc_id", "row", F.lit(0)), F.lit(40)).alias("block")).count()
    assert blocks.agg(F.max("count")).first()[0] < 2 * 10_000 / 40
    got = mixing.mix(docs).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.col("copies") * F.col("size")).alias("w"))
    found = {r["doc_id"]: r["n"] for r in got.collect()}
    assert found[None] == 6_667 and found[7] == 6_667 and len(found) == 2 + 6_666
    per = mixing.mix(docs).groupBy("source_size").agg(F.sum(F.col("copies") * F.col("size")).alias("w"), F.max("target").alias("t"))
    assert all(abs(r["w"] - r["t"]) <= 9 for r in per.collect())


# --- toxicity ----------------------------------------------------------------------


def toxic_texts(n: int, seed: int):
    rng = np.random.default_rng(seed)
    plain = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    bad = ["zzyrkon", "wuxxolp", "quivvert"]
    texts, labels = [], []
    for i in range(n):
        words = rng.choice(plain, 40).tolist()
        if toxic := i % 4 == 0:
            for at in rng.integers(0, 40, 3):
                words[at] = str(rng.choice(bad)) + str(rng.choice(["", "ab", "he", "dd"]))
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, np.array(labels)


def test_toxicity_knows_misspellings(spark):
    texts, labels = toxic_texts(400, 1)
    weights, bias = toxicity.train(texts, labels, steps=60)
    score = toxicity.scorer(weights, bias)
    other, truth = toxic_texts(200, 2)
    unseen = [t.replace("zzyrkon", "zzyrkonn").replace("wuxxolp", "wuxxxolp") for t in other]
    predicted = score(unseen) >= toxicity.THRESHOLD
    assert (predicted == truth.astype(bool)).mean() > 0.95


def plain_score(weights, bias, text):
    """The score word by word, gram by gram."""
    total, found = 0.0, toxicity.words(text)
    for word in found:
        marked, grams = f"<{word}>", []
        for n in toxicity.GRAMS:
            for at in range(len(marked) - n + 1):
                code = 0
                for c in marked[at : at + n]:
                    code = (code * 0x100000001B3 + ord(c) + 1) % 2**64
                grams.append(((code * 0x9E3779B97F4A7C15) % 2**64 >> 40) % toxicity.BUCKETS)
        total += sum(weights[g] for g in grams) / len(grams) if grams else 0.0
    return 1 / (1 + math.exp(-(bias + (total / len(found) if found else 0.0))))


def test_scores_are_those_of_a_loop_over_words_and_grams():
    rng = np.random.default_rng(4)
    weights, bias = rng.normal(0, 2, toxicity.BUCKETS), -0.3
    score = toxicity.scorer(weights, bias)
    texts = ["", None, "a", "one two two", "漢字 ß É x1", "word " * 300 + "another", "one other"]
    for _ in range(2):
        got = score(texts)
        assert all(math.isclose(a, plain_score(weights, bias, t), abs_tol=1e-9) for a, t in zip(got, texts, strict=True))


def test_the_loss_falls_along_the_gradient(monkeypatch):
    """The products in slices are those of whole matrices, and training lowers the loss."""
    texts, labels = toxic_texts(120, 5)
    whole = toxicity.train(texts, labels, steps=5)
    monkeypatch.setattr(toxicity, "_ENTRIES", 7)
    sliced = toxicity.train(iter(texts), iter(labels.tolist()), steps=5)
    assert np.allclose(whole[0], sliced[0], atol=1e-6) and math.isclose(whole[1], sliced[1], abs_tol=1e-6)
    vocabulary, classes, part, word, weight = toxicity._matrix(texts, labels)
    dense = np.zeros((len(classes), len(vocabulary)))
    dense[part, word] = weight
    values = np.random.default_rng(1).normal(size=(2, len(vocabulary)))
    assert np.allclose(toxicity._product(part, word, weight, values, len(classes)), values @ dense.T)
    back = np.random.default_rng(2).normal(size=(2, len(classes)))
    assert np.allclose(toxicity._product(word, part, weight, back, len(vocabulary)), back @ dense)
    losses = []
    for steps in (1, 30):
        p = np.clip(toxicity.scorer(*toxicity.train(texts, labels, steps=steps))(texts), 1e-9, 1 - 1e-9)
        losses.append(-np.mean(np.where(labels == 1, np.log(p) / labels.mean(), np.log(1 - p) / (1 - labels.mean()))))
    assert losses[1] < losses[0] / 2


def test_training_reads_whole_texts(spark):
    clean = "plain words here " * 4_000
    docs = spark.createDataFrame([(1, clean + "vile"), (2, clean + "fine")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    got = {r["toxic"]: r["text"] for r in toxicity.sample(docs, labels).collect()}
    assert got == {1: clean + "vile", 0: clean + "fine"}


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(2, 0, 0), (3, 1, 1), (3, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.where("false")):
        got = toxicity.score(odd_docs, given).collect()
        assert len(got) == 10 and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 5)}) == 1
    assert toxicity.score(no_docs, labels).collect() == []
    kept = toxicity.reject(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    scores = Counter(r["doc_id"] for r in toxicity.score(odd_docs, labels).collect() if not r["predicted"])
    assert Counter(r["doc_id"] for r in kept.collect()) == scores


# --- personal data -----------------------------------------------------------------


def luhn(value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return 14 <= len(digits) <= 19 and total % 10 == 0


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", luhn),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 10 <= len(re.sub("[^0-9]", "", v)) <= 15),
]


def base_spans(text: str | None) -> list:
    return sorted(
        (m.start(), k, m.end())
        for k, (_, pattern, keep) in enumerate(PLAIN)
        for m in re.finditer(pattern, text or "")
        if keep(m.group())
    )


HARD = [
    "a@b.c_d@e.f x@y.z.",
    "..a@b.c @b.c a@b a@b..c a@-.-",
    "é漢😀 a@b.co 1.2.3.4.5.6.7.8 1.2.3.256 001.002.003.0004 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 +1 (555) 010-9999. +123 +1555010999912345",
    "+1 4111 1111 1111 1111 a+1@b.c+12 3",
    "9" * 3000 + " a" * 50 + "." * 3000 + "@x.y",
    None,
    "",
]


def test_identifiers_are_those_of_the_plain_patterns(spark, documents):
    texts = HARD + [d["text"] for d in documents]
    got = {r["doc_id"]: r["spans"] for r in pii.find(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        own = [(s["start"], s["kind"], s["end"]) for s in got[i] if s["kind"] < 4]
        assert own == base_spans(text), text


def test_a_term_that_gives_an_identifier_away_goes(spark):
    filler = [f"{a}{b}talk" for a in "abcdefgh" for b in "aeiou"]
    texts = [f"{filler[i]} Zorblax writes from zor@blax.org {filler[-i - 1]} about this" for i in range(6)]
    texts += [f"{filler[i]} somebody writes from there about this {filler[-i]}" for i in range(30)]
    # A copied passage is one context, whatever it repeats.
    texts += [f"Quuxword is me@copy.org here, {' ' * 200}{filler[i]}" for i in range(6)]
    got = {r["doc_id"]: r["spans"] for r in pii.find(frame(spark, texts)).collect()}
    for i in range(6):
        terms = [texts[i][s["start"] : s["end"]] for s in got[i] if s["kind"] == 4]
        assert terms == ["Zorblax"]
    assert all(s["kind"] < 4 for i in range(6, len(texts)) for s in got[i])
    cleaned = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, texts)).collect()}
    assert "Zorblax" not in cleaned[0] and "zor@blax.org" not in cleaned[0] and "[EMAIL]" in cleaned[0]
    assert cleaned[10] == texts[10]


def test_a_term_far_from_its_identifier_counts_and_goes(spark):
    filler = ["".join(chr(97 + (i * 7 + j * 11) % 26) for j in range(9)) for i in range(60)]
    far = " ".join(["of it"] * 60)
    texts = [f"Zorblax {filler[i]} {far} wrote {filler[i + 8]} zor@blax.org today, Zorblax" if i % 2 else
             f"zor@blax.org {filler[i]} {far} Zorblax {filler[i + 8]}" for i in range(6)]
    texts += [f"{filler[i]} and {filler[(i * 3) % 60]} wrote {i} today" for i in range(60)]
    texts += ["Zorblax without an address"]
    got = {r["doc_id"]: r["spans"] for r in pii.find(frame(spark, texts)).collect()}
    for i in range(6):
        terms = [texts[i][s["start"] : s["end"]] for s in got[i] if s["kind"] == 4]
        assert terms == ["Zorblax"] * (1 + i % 2), i
    cleaned = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, texts)).collect()}
    assert all("Zorblax" not in cleaned[i] and "[EMAIL]" in cleaned[i] for i in range(6))
    assert cleaned[len(texts) - 1] == texts[-1]


def plain_disclosures(texts: list[str], support: int, least: float) -> dict:
    """By counting every pair of an address and a term; texts are words between spaces."""
    said = [set(t.split()) for t in texts]
    terms = [{w.lower() for w in words if "@" not in w and len(w) >= 4} for words in said]
    out = {}
    for mail in {w for words in said for w in words if "@" in w}:
        at = [i for i, words in enumerate(said) if mail in words]
        if len(at) == len(texts):
            continue
        for term in set().union(*(terms[i] for i in at)):
            both, n = sum(term in terms[i] for i in at), sum(term in t for t in terms)
            value = math.log2(both * len(texts) / (len(at) * n)) / math.log2(len(texts) / len(at))
            assert abs(value - least) > 1e-9
            if both >= support and value >= least:
                out["email:" + mail, term] = pytest.approx(value)
    return out


def disclosed(spark, texts: list[str]) -> dict:
    docs = frame(spark, texts)
    holders = pii._holders(pii._contexts(pii.identifiers(docs)), pii.SUPPORT)
    told = pii.disclosures(docs, holders, len(texts)).collect()
    assert len({(r["entity"], r["term"]) for r in told}) == len(told)
    return {(r["entity"], r["term"]): r["disclosure"] for r in told}


@pytest.mark.parametrize("shuffled", [False, True])
def test_disclosures_are_those_of_a_plain_count(spark, monkeypatch, shuffled):
    """Rare and frequent addresses, one that all texts hold, terms tied to them more or less."""
    if shuffled:
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    random = np.random.default_rng(11)
    letters = "abcdefghijklmnopqrst"
    shares = [0.03, 0.05, 0.1, 0.35, 0.6]
    texts = []
    for i in range(240):
        own = "".join(letters[int(d)] for d in str(i))
        parts = [f"{own}from all@texts.org"]
        for k, share in enumerate(shares):
            held = random.random() < share
            if held:
                parts.append(f"{own}near{letters[k]} id{k}@host{k}.org")
            for j, tie in enumerate((0.95, 0.7, 0.4)):
                if random.random() < (tie if held else 0.004 * j):
                    parts.append(f"Name{letters[k]}{letters[j]}")
        parts += [f"common{letters[j]}" for j in range(6) if random.random() < 0.5]
        texts.append(" ".join(parts))
    want = plain_disclosures(texts, pii.SUPPORT, pii.GENERALISE)
    assert len({mail for mail, _ in want}) >= 4 and len(want) >= 8
    assert disclosed(spark, texts) == want


@pytest.mark.parametrize("rows", [0, 200_000])
def test_texts_with_a_word_are_counted_once(spark, monkeypatch, rows):
    monkeypatch.setattr(common, "BROADCAST_ROWS", rows)
    texts = ["Some words here, some THERE", "words of École", "", "école: a 1word", "nothing"]
    docs = frame(spark, texts + texts[:2] * 40 + [texts[3]]).withColumn("text_hash", F.xxhash64("text"))
    got = {r["term"]: r["n_term"] for r in pii._texts_with(docs).collect()}
    assert got == {"some": 1, "words": 2, "here": 1, "there": 1, "école": 2, "word": 1, "nothing": 1}


def test_an_identifier_of_all_texts_hides_no_other(spark):
    """It has no information of its own, but what discloses others goes all the same."""
    letters = "abcdefghijklmnopqrst"
    texts = [
        f"{letters[i % 20]}{letters[i // 20]}sent from all@texts.org"
        + (f" by Zorblax {letters[i]}{letters[i]}wrote zor@blax.org" if i < 5 else "")
        for i in range(60)
    ]
    assert disclosed(spark, texts) == {("email:zor@blax.org", "zorblax"): pytest.approx(1.0)}
    cleaned = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, texts)).collect()}
    assert not any("Zorblax" in cleaned[i] for i in range(5)) and "sent from [EMAIL]" in cleaned[59]


def test_long_lists_of_spans_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 10)
    docs = frame(spark, [" ".join(f"a{i}{j}@b.org" for j in range(20)) for i in range(3)])
    cleaned = pii.sanitise(docs)
    assert "broadcast" not in cleaned._jdf.queryExecution().analyzed().toString()
    assert all(r["text"] == " ".join(["[EMAIL]"] * 20) for r in cleaned.collect())


def test_personal_data_of_odd_rows(spark, odd_docs, no_docs):
    assert len(pii.find(odd_docs).collect()) == 10
    assert pii.find(no_docs).collect() == []
    cleaned = pii.sanitise(odd_docs)
    assert cleaned.columns == odd_docs.columns
    before = Counter(r["text"] for r in odd_docs.collect())
    mail = "a text without an id, mail me@example.org"
    want = Counter({t.replace("me@example.org", "[EMAIL]") if t == mail else t: n for t, n in before.items()})
    assert Counter(r["text"] for r in cleaned.collect()) == want


# --- repeated passages -------------------------------------------------------------


def without_repeats(rows: list) -> list:
    first: dict[bytes, int] = {}
    for doc_id, text in sorted(r for r in rows if r[0] is not None):
        data = (text or "").encode()
        for j in range(len(data) - 49):
            first.setdefault(data[j : j + 50], doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for j in range(len(data) - 49):
            if doc_id is not None and first[data[j : j + 50]] < doc_id:
                gone[j : j + 50] = True
        out.append((doc_id, len(data), np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return sorted(out, key=repr)


def test_repeated_passages(spark, odd_docs, no_docs, documents):
    a = "".join(chr(97 + (i * i) % 23) for i in range(120))
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    rows += [
        (30, f"start {a} end"), (31, f"other {a[5:60]} x {a[50:110]} y"), (32, a[:50]), (33, a[:49]), (29, a[20:80]),
        (34, "ab" * 400), (35, "x" + "ab" * 100 + "y"), (36, "é" * 60), (37, "ü" + "é" * 30), (38, "\0" * 80), (39, "\0" * 60),
    ]
    rows += [(d["doc_id"] + 100, d["text"]) for d in documents[:80]]
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = [(r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in found.collect()]
    assert sorted(got, key=repr) == without_repeats(rows)
    assert substrings.remove_repeats(no_docs).collect() == []
    for r in found.collect():
        removed = sum(s["end"] - s["start"] for s in r["spans"])
        assert removed == r["n_bytes"] - len(r["kept"])
        assert all(x["end"] < y["start"] for x, y in zip(r["spans"], r["spans"][1:]))


def test_strips_at_the_edges_of_a_common_passage_spread(spark, documents, tmp_path, monkeypatch):
    passage = "".join(chr(97 + (i * i) % 23) for i in range(120))
    rows = [(i, f"{i * 7919 % 1000:>60}{passage}{i * 104729 % 1000:<60}") for i in range(300)]
    rows += [(400 + i, f"{'ab' * 30}{i % 3}{passage[:90]}") for i in range(30)]
    rows += [(i, r["text"]) for i, r in enumerate(documents[:40], 500)] * 2
    monkeypatch.setattr(substrings, "HOT", 20, raising=False)
    monkeypatch.setattr(substrings, "WINDOWS", 500, raising=False)
    monkeypatch.setattr(substrings, "scratch_dir", lambda spark, label: str(tmp_path / "repeats"))
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = [(r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in found.collect()]
    assert sorted(got, key=repr) == without_repeats(rows)
    # No shard holds the strips of all the documents that have the passage.
    assert max(len(np.load(f)) for f in (tmp_path / "repeats").glob("strip-*.npy")) < 300


def test_strips_and_their_hashes_do_not_depend_on_blocks(documents, monkeypatch):
    texts = [b"", b"ab" * 200, b"x" * 49, b"y" * 50, *[(r["text"] or "").encode() for r in documents[:30]], b"ab" * 200, b""]

    def cut(block):
        monkeypatch.setattr(substrings, "BLOCK", block)
        strips = substrings.Strips(texts, 50, 24)
        return strips, strips.hashes(np.arange(len(strips.begin)))

    (few, one), (many, other) = cut(1 << 20), cut(97)
    for name in ("begin", "windows", "text", "seeds"):
        assert np.array_equal(getattr(few, name), getattr(many, name))
    # Every window is in one strip, and strips are alike where their bytes are.
    assert few.windows.sum() == sum(max(0, len(t) - 49) for t in texts)
    assert np.array_equal(one, other)
    stops = few.stops(np.arange(len(one))).tolist()
    strings = [few.data[a:b] for a, b in zip(few.begin.tolist(), stops, strict=True)]
    assert len(set(strings)) == len(set(one.tolist())) == len(set(zip(strings, one.tolist(), strict=True)))
    assert all(a >= 0 and few.data[a:b] in texts[t] for a, b, t in zip(few.begin, stops, few.text, strict=True))



# --- language model ----------------------------------------------------------------


def test_scores_are_those_of_a_plain_model(spark, odd_docs, no_docs, documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()] + [(d["doc_id"] + 100, d["text"]) for d in documents[:60]]
    got = sorted(map(tuple, lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    tokens = [(i, (t or "").encode().lower().split() + [b" "]) for i, t in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _ in rows]
    train = [t for (_, t), h in zip(tokens, held, strict=True) if not h]
    count = Counter(w for t in train for w in t)
    total, different = sum(count.values()), len(count)
    pairs = Counter(p for t in train for p in zip([None, *t[:-1]], t, strict=True))
    before = Counter(w for _, w in pairs)
    after = defaultdict(lambda: [0, 0, 0, 0])
    for (u, _), n in pairs.items():
        after[u][0] += n
        after[u][min(n, 3)] += 1
    often = lambda c: lm.discounts(np.array([sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]))
    d1, d2 = often(before), often(pairs)
    left = sum(d1[min(n, 3)] for n in before.values())

    def low(w):
        return max(before[w] - d1[min(before[w], 3)], 0) / len(pairs) + left / len(pairs) / (different + 1)

    want = []
    for (i, t), h in zip(tokens, held, strict=True):
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (different + 1))) for w in t)
        score = 0.0
        for u, w in zip([None, *t[:-1]], t, strict=True):
            p = low(w)
            if u in after:
                n, rest = pairs.get((u, w), 0), after[u]
                p = (max(n - d2[min(n, 3)], 0) + sum(d2[k] * rest[k] for k in (1, 2, 3)) * p) / rest[0]
            score += math.log10(p)
        want.append((i, h, len(t), sum(w in count for w in t), total, base, score))
    for a, b in zip(got, sorted(want, key=repr), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])
    assert lm.score(no_docs).collect() == []
    mine = spark.createDataFrame([(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1), "no training")], "doc_id long, text string")
    assert [tuple(r)[2:] for r in lm.score(mine).collect()] == [(3, 0, 0, 0.0, 0.0)]


# --- SimHash -----------------------------------------------------------------------


def groups_of(rows: list) -> list:
    prints = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    return [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, linked(rows, prints), strict=True)]


def linked(rows, prints):
    group = list(range(len(rows)))
    for _ in range(len(rows)):
        changed = False
        for x in range(len(rows)):
            for y in range(len(rows)):
                if group[y] < group[x] and (prints[x] ^ prints[y]).bit_count() <= 2:
                    group[x], changed = group[y], True
        if not changed:
            break
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min([v for v in (least.get(g), i) if v is not None], default=None)
    return [least[g] for g in group]


def test_simhash_groups(spark, odd_docs, no_docs, documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()] + [(d["doc_id"] + 100, d["text"]) for d in documents]
    got = simhash.simhash(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(groups_of(rows), key=repr)
    assert simhash.simhash(no_docs).collect() == []


@pytest.mark.parametrize("dense", [1, 3, 48])
def test_links_connect_all_pairs_within_two_bits(spark, dense):
    rng = np.random.default_rng(5)
    centres = [int(x) for x in rng.integers(0, 2**63, 12)]
    prints = {0, 2**64 - 1}
    for c in centres:
        for _ in range(25):
            p = c
            for b in rng.integers(0, 64, rng.integers(0, 4)):
                p ^= 1 << int(b)
            prints.add(p)
    prints = sorted(prints)
    frame_ = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    found = [(a % 2**64, b % 2**64) for a, b in simhash.links(frame_, dense=dense).distinct().collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in found)
    rows = [(i, None) for i in range(len(prints))]
    at = {p: i for i, p in enumerate(prints)}
    root = list(range(len(prints)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        x, y = sorted((top(at[a]), top(at[b])))
        root[y] = x
    assert [top(i) for i in range(len(prints))] == linked(rows, prints)


def test_one_of_each_group(odd_docs, no_docs):
    kept = simhash.one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns
    # Empty texts (1, 2, 5, a null id) are one group; 6 is what the nameless copy repeats.
    # Both texts of 4 are nobody's copy.
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 4, 6]
    assert simhash.one_of_each_group(no_docs).collect() == []


def test_digests_are_hexadecimal(spark, sf, documents):
    for row in queries.op6_repeated_passages(spark, sf).collect():
        if row["n_removed"] == 0:
            text = next(d["text"] for d in documents if d["doc_id"] == row["doc_id"])
            assert row["kept_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_texts_that_share_an_id_are_documents_of_their_own(spark, odd_docs):
    a, b, c = "one text of some words and more", "quite another matter to talk about", "a third thing nobody has said yet"
    rows = [(1, a), (2, a), (2, b), (2, b), (None, c), (None, c), (None, a), (3, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, simhash.one_of_each_group(docs).collect())) == [(1, a), (2, b), (3, c)]
    twice = spark.createDataFrame([(7, a), (7, b), (7, b), (8, c), (None, a), (None, a)], "doc_id long, text string")
    keyed = common.document_key(twice, "k").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in keyed) == sorted([(7, a), (7, b), (8, c), (0, a)])
    assert len({r["k"] for r in keyed}) == 4
    assert next(r["k"] for r in keyed if r["doc_id"] == 8) == 8


@pytest.mark.parametrize("text", ["½ ²", "①", "12 34", "Ⅳ", "_", "!?"])
def test_texts_without_a_letter_have_no_language(text):
    languages = langid.Languages({"en": "some words of one language", "de": "ganz andere sachen"})
    assert languages.predict([text, text + " words"])[0] == [langid.UNKNOWN, "en"]


def test_maps_keep_no_file_open(tmp_path):
    import os

    from flightloom.llm import arrays

    for i in range(40):
        arrays.write(f"{tmp_path}/a-{i}.npy", np.arange(i, dtype=np.uint64))
    before = len(os.listdir("/proc/self/fd"))
    held = [arrays.mapped(f"{tmp_path}/a-{i}.npy") for i in range(40)]
    assert [x.tolist() for x in held] == [list(range(i)) for i in range(40)]
    assert len(os.listdir("/proc/self/fd")) == before
    assert arrays.mapped(f"{tmp_path}/none.npy").tolist() == []


@pytest.mark.parametrize("rows", [0, common.BROADCAST_ROWS])
def test_decontamination_beyond_the_broadcast(spark, monkeypatch, rows):
    """Windows longer and shorter than a shingle, at the ends of texts, with either join."""
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(common, "BROADCAST_ROWS", rows)
    w = [f"w{i}" for i in range(40)]
    docs = [(1, " ".join(w[:13])), (2, " ".join(w[3:30])), (3, "x y w1"), (4, "w1 w2"), (5, None), (6, " ".join(w[1:13])), (6, "w5 w6 w7")]
    items = [("a", " ".join(w[:15])), ("b", "w1"), ("c", "w1 w2"), ("d", "w5 w6 w7"), ("e", "nowhere"), ("f", " ".join(w[4:17]))]

    def plain(text):
        words = (text or "").split()
        hit, held = set(), set()
        for item, body in items:
            own = body.split()
            for s in range(max(1, len(own) - 12)):
                window = own[s : s + 13]
                for at in range(len(words) - len(window) + 1):
                    if words[at : at + len(window)] == window:
                        hit |= set(range(at, at + len(window)))
                        held.add(item)
        return len(words), len(hit), sorted(held)

    got = decontamination.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    ).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got) == sorted((d, *plain(t)) for d, t in docs)
