import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import series


@pytest.fixture(scope="module")
def hot(spark):
    """600 rows of which a third belong to one key."""
    r = random.Random(3)
    data = [(i, "hot" if r.random() < 0.34 else r.choice("abcde"), r.randint(0, 50)) for i in range(600)]
    return data, spark.createDataFrame(data, "i bigint, k string, v int").repartition(7)


@pytest.mark.parametrize("width", [1, 3, 25, 10_000])
def test_previous_row_matches_brute_force(hot, width):
    data, df = hot
    got = {r.i: r.prev and (r.prev.i, r.prev.v) for r in series.previous_row(df, ["k"], ["i"], series.number_slices("i", width), ["i", "v"]).collect()}
    last, want = {}, {}
    for i, k, v in data:
        want[i], last[k] = last.get(k), (i, v)
    assert got == want


@pytest.mark.parametrize("width", [1, 4, 10_000])
def test_running_max_matches_brute_force(hot, width):
    data, df = hot
    got = {r.i: r.m for r in series.running_max_before(df, ["k"], ["i"], series.number_slices("i", width), "v", "m").collect()}
    top, want = {}, {}
    for i, k, v in data:
        want[i] = top.get(k)
        top[k] = v if k not in top else max(top[k], v)
    assert got == want


def test_no_key_at_all(hot):
    data, df = hot
    got = {r.i: r.prev and r.prev.i for r in series.previous_row(df, [], ["i"], series.number_slices("i", 8), ["i"]).collect()}
    assert got == {i: (i - 1 if i else None) for i, _, _ in data}


def test_repeated_flag(spark):
    df = spark.createDataFrame([(1, "f", 10), (2, "f", 10), (3, "f", 12), (4, "f", 11), (5, "f", 13), (6, "g", 5)], "o bigint, feed string, t bigint")
    got = {r.o: r.repeated for r in series.repeated_flag(df, "feed", "t", ["o"], series.number_slices("o", 2)).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True, 5: False, 6: False}


def test_centered_mean_needs_all_days(spark):
    days = [(dt.date(2025, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(10) if i != 8]
    got = {r.day.day: (r.v, r.rolling_mean) for r in series.centered_mean(spark.createDataFrame(days, "day date, v double"), "day", "v").collect()}
    assert len(got) == 9 and got[4] == (3.0, 3.0) and got[5] == (4.0, 4.0) and got[6][1] is None and got[1][1] is None


def test_contiguity_and_overlap(spark):
    log = spark.createDataFrame([(0, 0, 9), (1, 10, 14), (2, 16, 20)], "b bigint, a bigint, z bigint")
    r = series.contiguous(log, "a", "z", "b", series.number_slices("b", 2)).first()
    assert (r.ranges, r.breaks, r.contiguous) == (3, 1, False)
    spans = log.withColumn("z", F.when(F.col("b") == 0, 12).otherwise(F.col("z")))
    assert [x.overlaps for x in series.overlaps(spans, "b", "a", "z", series.number_slices("b", 2)).orderBy("b").collect()] == [False, True, False]


def test_first_rows_limits_each_task_before_the_shuffle(hot):
    _, df = hot
    out = series.first_rows(df, ["k"], [F.desc("v"), F.asc("i")], 2)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    data = hot[0]
    want = {k: sorted(((-v, i) for i, kk, v in data if kk == k))[:2] for k in {k for _, k, _ in data}}
    got = {}
    for r in out.collect():
        got.setdefault(r.k, []).append((-r.v, r.i))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_top_names_and_cumulative_share(spark):
    df = spark.createDataFrame([("x", "a", 5), ("x", "b", 9), ("x", "c", 7), ("x", "d", 1), ("y", "e", 2)], "g string, n string, v int")
    assert {r.g: r.top_names for r in series.top_names(df, ["g"], "n", "v").collect()} == {"x": "b; c; a", "y": "e"}
    got = {r.k: r.share_pct for r in series.cumulative_share(df, "v", [1, 2], [F.desc("v"), F.asc("n")]).collect()}
    assert got == {1: pytest.approx(100 * 9 / 24), 2: pytest.approx(100 * 16 / 24)}
