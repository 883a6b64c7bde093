"""Matrix and audit against plain versions; the query itself has a SQL twin."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import filter_audit
from tidemark.llm.common import split_words

SCHEMA = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_audit(rows, labels):
    marks = defaultdict(lambda: [False, False])
    for i, quality, toxic in labels:
        marks[i][0] |= quality == 1
        marks[i][1] |= toxic == 1
    out = {}
    for i, text, lang in rows:
        text, part, w = text or "", lang or "", words(text)
        copy = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": copy}
        failed = {f for f, x in fails.items() if x}
        good, toxic = marks[i] if i is not None else (False, False)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                row = out.setdefault((part, "".join(order), step), [0] * 7)
                before = failed & set(order[: step - 1])
                row[0] += not before and f not in failed
                removed = not before and f in failed
                row[1] += removed
                row[2] += bool(before) and f in failed
                row[3] += failed == {f}
                row[4] += removed and good
                row[5] += removed and toxic
                row[6] += 120 // len(failed) if f in failed else 0
    return out


def audited(docs, labels, **options):
    counts = filter_audit.failures(filter_audit.row_stats(filter_audit.encode(docs, **options)), labels)
    return {(r[0], r[1], r[2]): list(r)[3:] for r in filter_audit.audit(counts).collect()}


def made_rows():
    rng = random.Random(9)
    common = [f"w{k}" for k in range(40)]
    rows = []
    for k in range(120):
        text = " ".join(rng.choice(common) if rng.random() < 0.5 else f"rare{rng.randrange(10**6)}" for _ in range(rng.choice([3, 150, 260])))
        rows.append((k, text + rng.choice(["", " AB CD", " a|b", "\n\té"]), rng.choice(["en", "de", None, ""])))
    rows += [(200 + k, rows[5][1], "en") for k in range(60)]
    return rows + [(300, None, "en"), (301, "", None), (301, "", None), (None, "", "en"), (None, rows[5][1], "xx"), (None, None, None), (3, "other text of id three", "en"), (302, "É" * 30 + "A", "en"), (303, "word " * 50_000, "de")]


@pytest.mark.parametrize("head_words", [1, 30, 1_000_000])
def test_row_sums_and_nonzero_counts(spark, head_words):
    rows = made_rows()
    matrix = filter_audit.encode(spark.createDataFrame(rows, SCHEMA).repartition(3), head_words=head_words)
    got = sorted((str(r["doc_id"]), r["words"], r["distinct"]) for r in filter_audit.row_stats(matrix).collect())
    assert got == sorted((str(i), len(words(t)), len(set(words(t)))) for i, t, _ in rows)
    # Each word has one id: its place in the head, or one beyond.
    entries = [(bytes(r["word"]), r["id"]) for r in matrix.tail_dictionary.collect()]
    ids, used = [i for _, i in entries], {w.encode() for _, t, _ in rows for w in words(t)}
    assert len(matrix.words) <= head_words and len(ids) == len(set(ids)) and all(i >= len(matrix.words) for i in ids)
    assert sorted([*matrix.words, *(w for w, _ in entries)]) == sorted(used)
    name = dict(enumerate(matrix.words)) | {i: w for w, i in entries}
    counts = Counter()
    for r in [*matrix.head.collect(), *matrix.tail.collect()]:
        for i, n in zip(r["indices"], r["data"], strict=True):
            counts[name[i]] += n
    assert counts == Counter(w.encode() for _, t, _ in rows for w in words(t))


def test_a_frequent_word_is_in_the_head_whatever_the_split(spark):
    rows = [(k, " ".join(["often"] * (k % 3) + [f"word{k}-{j}" for j in range(50)]), "en") for k in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    # 300 of 15 300 words; more than twice one in 200.
    for n in (1, 3, 30):
        assert filter_audit.frequent_words(docs.repartition(n), head_words=200) == [b"often"]


def test_shards_are_csr(spark):
    rows = made_rows()
    matrix = filter_audit.encode(spark.createDataFrame(rows, SCHEMA), head_words=30)
    counts = Counter(w for _, t, _ in rows for w in words(t))
    assert sum(n for r in matrix.head.collect() for n in r["data"]) + sum(n for r in matrix.tail.collect() for n in r["data"]) == sum(counts.values())
    for r in [*matrix.head.collect(), *matrix.tail.collect()]:
        rows_here = len(r["docs"]) if "docs" in r else len(r["rows"])
        assert len(r["indptr"]) == rows_here + 1 and r["indptr"][-1] == len(r["indices"]) == len(r["data"])
        for a, b in zip(r["indptr"][:-1], r["indptr"][1:], strict=True):
            assert list(r["indices"][a:b]) == sorted(set(r["indices"][a:b]))


def test_a_document_is_in_one_shard_of_the_tail(spark):
    rows = [(k, " ".join(f"rare{k * j}" for j in range(1, 60)), "en") for k in range(200)]
    for partitions in (2, 9):
        matrix = filter_audit.encode(spark.createDataFrame(rows, SCHEMA).repartition(partitions), head_words=1)
        assert sum(len(r["rows"]) for r in matrix.tail.collect()) == len(rows)


def test_words_are_cut_at_ascii_white_space_and_between_texts():
    texts = [b"a b", b"", b" \t", b"c", b"c\x0bd\x0c\r\ne\x1cf ", "é\u00a0x".encode(), b""]
    for column in (pa.array(texts), pa.array([b"zz", *texts]).slice(1), pa.array(texts, pa.binary()).slice(2)):
        words, sizes = split_words(column)
        assert words.to_pylist() == [w for t in column.to_pylist() for w in t.split()] and sizes.tolist() == [len(t.split()) for t in column.to_pylist()]
    assert [len(x) for x in split_words(pa.array([], pa.binary()))] == [0, 0]


@pytest.mark.parametrize("head_words", [20, 1_000_000])
def test_equals_the_plain_version(spark, head_words):
    rows = made_rows()
    labels = [(k, k % 2, k % 3) for k in range(0, 240, 2)] + [(4, 0, 0), (4, None, 1), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("row", "word", "n", "id", "part", "good", "digest", "shard", "docs", "a.b")])
    assert audited(docs.repartition(4), spark.createDataFrame(labels, LABELS), head_words=head_words) == plain_audit(rows, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame(made_rows(), SCHEMA), spark.createDataFrame([], LABELS)
    assert audited(docs.limit(0), labels) == {}
    assert audited(docs, labels) == plain_audit(made_rows(), [])
