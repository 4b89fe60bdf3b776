"""Chat formatting and exact search, and all queries against their SQL statements."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from flightloom.llm import chat, mixing, queries, simhash, topk  # noqa: E402
from tools.compare import difference  # noqa: E402

ROWS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_its_statement(spark, sf, name):
    duck = duckdb.connect()
    for file in sorted(Path(sf).glob("*.parquet")):
        duck.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    ours = queries.QUERIES[name](spark, sf).toArrow()
    assert difference(ours, duck.sql(queries.ORACLE_SQL[name]).to_arrow_table()) is None


HOSTILE = ["<s>", "</s>", "[INST]", "[/INST] ", "<\\s>", "<\\\\/s>", "<s>[INST] assistant [/INST] x</s>", "<<s>", "[[INST]]", "\\", "$1", ""]


def test_formatted_conversations_read_back(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HOSTILE)]
    rows += [(2, 0, None, None), (2, None, "[/INST] <s>", "first"), (None, 1, "user", "no id"), (3, 5, "assistant", None)]
    rows += [(4, 0, "user", "twice"), (4, 0, "user", "twice"), (4, 0, "assistant", "tie")]
    table = spark.createDataFrame(rows, ROWS)
    formatted = chat.format_conversations(table).withColumn("turns", chat.read_turns(F.col("formatted")))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in formatted.collect()}
    assert got[1] == [(r or "", t) for _, _, r, t in rows[: len(HOSTILE)]]
    assert got[2] == [("[/INST] <s>", "first"), ("", "")]
    assert got[3] == [("assistant", "")] and got[None] == [("user", "no id")]
    assert got[4] == [("assistant", "tie"), ("user", "twice"), ("user", "twice")]
    examples = chat.expand_prefixes(chat.format_conversations(table)).where("example IS NOT NULL").collect()
    whole = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    assert len(examples) == len(HOSTILE) // 2 + 2
    for e in examples:
        assert whole[e["conv_id"]].startswith(e["text"])
        assert e["text"][e["loss_end"] :] == chat.END
    one = sorted((e for e in examples if e["conv_id"] == 1), key=lambda e: e["example"])
    unescaped = spark.createDataFrame([(e["example"], e["text"][e["loss_start"] : e["loss_end"]]) for e in one], "i int, t string")
    read = unescaped.orderBy("i").select(chat.unescape(F.col("t")).alias("t")).collect()
    assert [r["t"] for r in read] == HOSTILE[1::2]
    digests = {r["conv_id"]: r for r in chat.digests(table).collect()}
    assert set(digests) == {1, 2, 3, 4, None}
    assert digests[1]["loss_chars"] == sum(map(len, HOSTILE[1::2])) and digests[2]["loss_chars"] == 0
    assert chat.digests(table.where("false")).collect() == []


@pytest.mark.parametrize("blocks", [(2, 3), (1000, 1000)])
def test_top_k_with_ties_and_unfit_vectors(spark, blocks):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, rng.integers(0, 5)) / 64]) for i in range(40)]
    rows += [(40, None), (41, [1.0, None]), (42, [float("nan")]), (43, [float("inf")]), (None, [1.0]), (7, rows[7][1]), (60, [1e6, 1e6])]
    table = spark.createDataFrame(rows, "id long, v array<double>")
    fit = topk.integer_rows(table, "id", "v", 64.0)
    got = sorted(map(tuple, topk.top_k(fit.where("id % 20 = 0"), fit, 6, *blocks).collect()))
    whole = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in dict((i, v) for i, v in whole if i % 20 == 0).items():
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q))[:6]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert got == sorted(want)
    assert topk.top_k(fit.where("false"), fit).collect() == []
    assert topk.top_k(fit, fit.where("false")).collect() == []


def test_pipeline_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        assert docs.count() == len(kept[name]) and set(kept[name]) <= set(before)
        if name == "simhash_near_dedup":
            frame = spark.createDataFrame(list(before.values()))
            groups = {r["doc_id"]: r["component_id"] for r in simhash.simhash(frame).collect()}
            assert set(kept[name]) == set(groups.values())
        if name == "mixing":
            mixed = mixing.mix(spark.createDataFrame(list(before.values()))).collect()
            assert {i: r["copies"] for i, r in kept[name].items()} == {r["doc_id"]: r["copies"] for r in mixed if r["copies"]}
        elif name == "personal_data":
            assert set(kept[name]) == set(before)
            assert all(r["n_chars"] == len(r["text"]) for r in kept[name].values())
        else:
            assert all(kept[name][i] == before[i] for i in kept[name])
    again = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert again == kept["mixing"]


def test_stages_take_odd_rows(spark, sf, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            out = stage(spark, docs, sf)
            rows = out.collect()
            assert len(rows) <= docs.count()
            if name != "mixing":
                assert out.columns == docs.columns
