"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontamination, html_wrapper, lm_scoring, mixing, pii, quality_fm, quality_rules, simhash, tokens, url_filter

LONG = "the quick brown fox 12 " * 60_000
ROWS = [
    (1, "plain words of a text that is not long at all", "en", "a", 40),
    (1, "plain words of a text that is not long at all", "en", "a", 40),
    (2, None, None, None, None),
    (None, "a text without an id", "en", "a", 5),
    (None, None, None, None, None),
    (3, "", "", "", 0),
    (4, LONG, "en", "b", len(LONG)),
    (5, "two", "de", "b", 3),
    (5, "another text for the same id, with a@b.cd in it", "de", "b", 30),
    (-6, "\x00   \U0001f600 é", "en", "c", 7),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["id", "key", "size", "score", "fp", "path", "host", "words", "n", "copies", "target", "taken", "_row", "part", "file", "position", "meta", "held_out", "a.b", "y", "_sh_row", "_sh_fp", "_mix", "_mix_n", "_mix_copy", "_mix_position", "_dc_id", "_dc_key", "_fm_score", "c0", "copy"]


def with_clashes(df):
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)])


@pytest.fixture(scope="module")
def docs(spark):
    return with_clashes(spark.createDataFrame(ROWS, SCHEMA))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (4, 0, 0), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark_items(spark):
    return spark.createDataFrame([(1, "words of a text that is not long at all"), (None, "the quick brown fox 12 the quick"), (2, None), (3, "two")], "item_id long, text string")


def by_text(docs, labels, benchmark_items, tmp):
    import public_tokenizers

    def encoded(d):
        path = f"{tmp}/{'full' if d.count() else 'empty'}"
        tokens.write(d, path, public_tokenizers.path("word_bpe_49k.json"))
        return tokens.digests(tokens.spans(d.sparkSession, path))

    return {
        "mixing": lambda d: mixing.assign(d.withColumn("_w", mixing.size_of(F.col("text"))), size_col="_w"),
        "pii": lambda d: pii.digests(pii.find(d)),
        "quality_fm": lambda d: quality_fm.score(d, quality_fm.train(d, labels)),
        "quality_rules": quality_rules.score,
        "tokens": encoded,
        "lm_scoring": lm_scoring.score,
        "simhash": simhash.near_duplicates,
    }


NAMES = ["mixing", "pii", "quality_fm", "quality_rules", "tokens", "lm_scoring", "simhash"]


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_each_row(name, docs, labels, benchmark_items, tmp_path):
    operator = by_text(docs, labels, benchmark_items, tmp_path)[name]
    rows = operator(docs).collect()
    assert sorted(str(r["doc_id" if "doc_id" in r else "id"]) for r in rows) == sorted(str(r[0]) for r in ROWS)
    same = [tuple(v for k, v in r.asDict().items() if k not in ("start", "_mix")) for r in rows if r["doc_id" if "doc_id" in r else "id"] == 1]
    assert same[0] == same[1]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(name, docs, labels, benchmark_items, tmp_path):
    assert by_text(docs, labels, benchmark_items, tmp_path)[name](docs.limit(0)).count() == 0


def test_decontamination(docs, benchmark_items):
    rows = decontamination.matches(docs, benchmark_items).collect()
    assert sorted((r["id"], r["item_id"]) for r in rows) == sorted([(1, 1), (1, 1), (4, None)], key=str) or {(r["id"], r["item_id"]) for r in rows} == {(1, 1), (4, None)}
    assert decontamination.matches(docs.limit(0), benchmark_items).count() == 0
    assert decontamination.matches(docs, benchmark_items.limit(0)).count() == 0


PAGES = [
    (1, "https://a.com/x", "<p>one</p>"), (1, "https://a.com/x", "<p>one</p>"), (2, None, None), (None, "", ""), (3, "no scheme", "<p>two"),
    (4, "https://a.com", "<div>" * 3000 + "deep"), (5, "https://A.com:80/é?q#f", "<p>" + "long text " * 50_000),
]


def test_pages(spark):
    pages = with_clashes(spark.createDataFrame(PAGES, "page_id long, url string, html string"))
    got = {r["page_id"]: r["text"] for r in html_wrapper.extract(pages).collect()}
    assert got[1] == "one" and got[2] == "" and got[None] == "" and got[3] == "two" and got[4] == "deep" and len(got[5]) == 499_999
    assert html_wrapper.extract(pages.limit(0)).count() == 0
    rules = [("allow", "com/")]
    judged = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules, default="block").collect()}
    assert judged[1] == ("a.com", "/x", "com/", "allow") and judged[2] == ("", "", None, "block") and judged[5] == ("a.com:80", "/é", None, "block") and judged[4] == ("a.com", "", None, "block")
    assert url_filter.judge(pages, [], default="allow").count() == len(PAGES) and url_filter.judge(pages.limit(0), rules).count() == 0


# --- pipeline


@pytest.fixture(scope="module")
def folder(spark, docs, labels, benchmark_items, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    benchmark_items.write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_edge_rows(spark, docs, folder, name, stage):
    out = stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    rows = out.collect()
    if name == "token_ids":
        assert len(rows) == len(ROWS) and [r["start"] for r in sorted(rows, key=lambda r: r["start"])][0] == 0
    else:
        assert out.columns == docs.columns
        assert {(r["doc_id"], r["text"]) for r in rows} <= {(r[0], r[1]) for r in ROWS}
    if name == "near_duplicates":
        # Null, empty and repeated texts: one row of each group, with the smallest id.
        kept = [(r["doc_id"], r["text"]) for r in rows]
        assert len(kept) == len(set(kept)) and (1, ROWS[0][1]) in kept and sum(not t for _, t in kept) == 1
    if name == "decontamination":
        assert {r["doc_id"] for r in rows} == {2, None, 3, 5, -6}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_an_empty_table(spark, folder, name, stage):
    assert stage(spark, spark.read.parquet(f"{folder}/documents.parquet").limit(0), folder).count() == 0


def test_quality_without_usable_labels_keeps_all(spark, docs, tmp_path):
    # None at all, ids of no document, and no label in the row.
    for k, rows in enumerate(([], [(999, 1, 0)], [(1, None, None), (None, 1, 0)])):
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{k}/labels.parquet")
        assert corpus_pipeline.quality(spark, docs, f"{tmp_path}/{k}").count() == len(ROWS)
