"""Cross-parsing against a plain version, held-out accuracy, and rows at the edges."""

import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid, queries


def phrases(text: bytes, sample: bytes) -> int:
    at = n = 0
    while at < len(text):
        k = 1
        while at + k <= len(text) and text[at : at + k] in sample:
            k += 1
        at += max(1, k - 1)
        n += 1
    return n


@pytest.mark.parametrize("few", [0, 40, 10**9])
def test_phrases_equal_the_plain_version(few, monkeypatch):
    """Whether texts advance together, one by one, or first together and then one by one."""
    monkeypatch.setattr(langid, "FEW", few)
    rng = random.Random(few)
    samples = tuple(bytes(rng.choice(b"abcd ") for _ in range(n)) for n in (300, 50, 3, 0))
    texts = [bytes(rng.choice(b"abcde ") for _ in range(rng.choice([0, 1, 5, 40, 200]))) for _ in range(200)]
    got = langid.Parser(samples).phrases(texts)
    assert np.array_equal(got, [[phrases(t, s) for s in samples] for t in texts])


def test_automaton_has_all_substrings_and_no_others():
    data = bytes(random.Random(3).choice(b"ab") for _ in range(40))
    step = langid.suffix_automaton(data)
    for k in range(1 << 7):
        word = bytes(b"ab"[k >> j & 1] for j in range(6))
        state = 0
        for c in word:
            state = step[state].get(c, -1) if state >= 0 else -1
        assert (state >= 0) == (word in data)
    assert len(step) <= 2 * len(data)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    known = dict(duckdb.execute(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").fetchall())
    rows = queries.QUERIES["op13_language_id"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(known)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {*known.values(), "und"}
    judged = [r["lang_pred"] == known[r["doc_id"]] for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert np.mean(judged) >= 0.97


SCHEMA = "doc_id long, text string, lang string"
LEARNT = [(k, t, lang) for k, (t, lang) in enumerate([("the cat sat on the mat and the dog ran", "en"), ("der hund und die katze sind nicht hier", "de")] * 8)]


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(spark.createDataFrame([*LEARNT, (98, "nul", None), (99, None, "en"), (None, "zzzz", "xx"), (97, "", "yy")], SCHEMA))


def test_learns_from_labelled_texts_that_are_not_held_out(spark, model):
    assert model.languages == ("de", "en")
    assert b"katze" in model.samples[0] and b"cat" in model.samples[1]
    held = spark.createDataFrame([r for r in LEARNT if zlib.crc32(str(r[0]).encode()) % 4 == 2], SCHEMA)
    assert held.count() and langid.learn(held).languages == ()


def test_sample_keeps_to_its_bounds_and_not_to_file_splits(spark):
    rows = [(3 * k, f"text number {k} " * (1 + k % 40), f"l{k % 7}") for k in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    bounds = {"languages": 5, "documents": 9, "window": 20, "sample_bytes": 500}
    a, b = langid.learn(docs.repartition(7), **bounds), langid.learn(docs.repartition(2, "text"), **bounds)
    assert a == b and len(a.languages) == 5 and all(0 < len(s) <= 100 for s in a.samples)
    # A copy counts once, however often it is there.
    assert langid.learn(docs.union(docs.where("doc_id < 300")).union(docs), languages=7, documents=9) == langid.learn(docs, languages=7, documents=9)


def test_rows_at_the_edges(spark, model):
    long = "the dog and the cat " * 40_000
    rows = [(1, None), (2, ""), (3, "123 456 !?"), (None, "the cat"), (None, None), (4, long), (5, "the cat"), (5, "the cat"), (6, "Ünïcödé Ω 漢字"), (7, "\x00\U0001f600")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("held_out", "lang_pred", "score", "lang", "a.b")])
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["lang_pred"]) for r in got}
    assert {(1, "und"), (2, "und"), (3, "und"), (None, "und"), (7, "und"), (None, "en"), (4, "en"), (5, "en")} <= by
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    assert len({tuple(r) for r in got if r["doc_id"] == 5}) == 1
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert langid.predict(docs.limit(0), model).count() == 0
    unlearnt = langid.predict(docs, langid.learn(spark.createDataFrame([], SCHEMA))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlearnt} == {("und", 0.0)}


def test_ties_go_to_the_first_language():
    both = langid.Model(("aa", "bb"), (b"some text", b"some text"))
    assert langid.identify(["some", "xyz"], both) == [("aa", 0.5), ("aa", 0.5)]
    assert langid.identify(["some"], langid.Model(("aa",), (b"text",))) == [("aa", 1.0)]
