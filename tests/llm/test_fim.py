"""Skip list and fill-in-middle against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fim


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 17, 64, 65, 1000, 20_000])
def test_reach_equals_prefix_sums(n):
    rng = np.random.default_rng(n)
    points = rng.integers(1, 9, n)
    units, ends = fim.SkipList(points, 2 * points), np.concatenate([[0], np.cumsum(points)])
    for rank in {0, n, n // 2, *rng.integers(0, n + 1, 50).tolist()}:
        assert units.reach(rank) == (rank, ends[rank], 2 * ends[rank])
    assert units.reach(n + 5) == (n, ends[n], 2 * ends[n])


def test_every_lane_adds_up_to_the_same():
    units = fim.SkipList(np.arange(1, 5001), np.arange(1, 5001) * 3)
    assert len(units.lanes) > 4
    for lane in units.lanes:
        assert lane.sum(axis=1).tolist() == [5000, 5000 * 5001 // 2, 3 * 5000 * 5001 // 2]


def test_a_descent_takes_few_steps():
    units = fim.SkipList(np.ones(1 << 17, np.int64))
    assert len(units.lanes) <= 12
    # Nodes of a lane that lie between two nodes of the next bound the steps there.
    assert max(int(np.diff(down).max()) for down in units.down[1:]) <= 80


def plain_version(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def made_rows():
    rng = random.Random(5)
    rows = [(k, "".join(rng.choice("aé\U0001f600 \n\r<P") for _ in range(rng.choice([0, 1, 2, 9, 300])))) for k in range(400)]
    rows += [(1000, None), (None, "a\nb\nc"), (None, None), (1001, ""), (1002, "\n"), (1003, "\n\n\n"), (1004, "x<S>y\nz"), (1005, "<M>"), (1006, "line é\n" * 60_000), (1006, "line é\n" * 60_000)]
    return rows + [(-7, "<\nP>\n<S\n>\n<")] * 3


@pytest.mark.parametrize("parameters", [{}, {"rate": 30, "spm_rate": 80, "seed": 11}])
def test_equals_the_plain_version(spark, parameters):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("id", "n", "form", "output", "h0", "a.b")])
    made = fim.transform(docs, **parameters)
    got = made.withColumn("restored", fim.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((plain_version(*r, **parameters) for r in rows), key=key)
    assert sorted((str(r["id"]), r["restored"]) for r in got) == sorted((str(i), t or "") for i, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], "doc_id long, text string")).count() == 0
