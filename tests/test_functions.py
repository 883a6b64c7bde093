import datetime as dt
from zoneinfo import ZoneInfo

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import nested, stats, textfns, timefns

NY = ZoneInfo("America/New_York")


def one(spark, expr, **values):
    df = spark.range(1)
    for name, v in values.items():
        df = df.withColumn(name, F.lit(v))
    return df.select(expr.alias("x")).first().x


def test_clock_changes_of_any_year(spark):
    times = [dt.datetime(1975, 2, 23, 2), dt.datetime(1975, 10, 26, 1), dt.datetime(2075, 3, 10, 2), dt.datetime(2075, 11, 3, 1), dt.datetime(2075, 3, 10, 3), dt.datetime(2020, 7, 1, 2)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    assert [r.x for r in df.select(timefns.is_dst_hour("t").alias("x")).collect()] == [True, True, True, True, False, False]


def test_dst_kind_of_two_years(spark):
    span = spark.sql("SELECT timestamp_ntz'2025-01-01 00:00:00' AS t UNION ALL SELECT timestamp_ntz'2026-12-31 23:00:00'")
    hours = timefns.hour_span(span, "t").withColumn("kind", timefns.dst_kind("hour")).where("kind IS NOT NULL")
    assert [(r.hour, r.kind) for r in hours.orderBy("hour").collect()] == [
        (dt.datetime(2025, 3, 9, 2), "nonexistent"),
        (dt.datetime(2025, 11, 2, 1), "repeated"),
        (dt.datetime(2026, 3, 8, 2), "nonexistent"),
        (dt.datetime(2026, 11, 1, 1), "repeated"),
    ]


def test_holidays_list_and_test_agree(spark):
    years = spark.range(1995, 2031).select(F.col("id").cast("int").alias("year"))
    listed = {r.day for r in timefns.holidays(years).collect()}
    days = spark.sql("SELECT explode(sequence(date'1995-01-02', date'2030-12-30')) AS day")
    tested = {r.day for r in days.where(timefns.is_holiday("day")).collect()}
    assert {d for d in listed if dt.date(1995, 1, 2) <= d <= dt.date(2030, 12, 30)} == tested
    for d in [(2025, 1, 20), (2025, 5, 26), (2025, 11, 27), (2026, 7, 3), (2026, 7, 4), (2026, 9, 7), (2026, 10, 12)]:
        assert dt.date(*d) in listed


def test_clock_seconds(spark):
    df = spark.createDataFrame([("25:10:00",), ("00:00:01",), ("x",)], "c string")
    assert [r.x for r in df.select(timefns.clock_seconds("c").alias("x")).collect()] == [90600, 1, None]


@pytest.mark.parametrize("day", [dt.date(2025, 3, 9), dt.date(2025, 11, 2), dt.date(2025, 7, 1)])
def test_service_instant_is_wall_clock(spark, day):
    got = one(spark, timefns.service_instant("d", "s"), d=day, s=8 * 3600)
    assert got == int(dt.datetime.combine(day, dt.time(8), NY).timestamp())


def test_service_day(spark):
    late = int(dt.datetime(2025, 7, 1, 23, 30, tzinfo=NY).timestamp())
    assert one(spark, timefns.service_day("s", F.col("t")), s="20250630", t=late) == dt.date(2025, 6, 30)
    assert one(spark, timefns.service_day(F.lit(None).cast("string"), F.col("t")), t=late) == dt.date(2025, 7, 1)


def test_trip_keys(spark):
    df = spark.createDataFrame([("084600_A..S74R", "AFA_084600_A..S74R"), ("1234", "x"), (None, None)], "r string, s string")
    got = [(r.a, r.b) for r in df.select(textfns.trip_key("r").alias("a"), textfns.static_trip_key("s").alias("b")).collect()]
    assert got == [("084600_A..S", "084600_A..S"), (None, None), (None, None)]


def test_points_and_labels(spark):
    assert one(spark, textfns.point_lon("p"), p="POINT (-73.9 40.7)") == -73.9
    assert one(spark, textfns.point_lat("p"), p="POINT (-73.9 40.7)") == 40.7
    assert one(spark, textfns.point_lat("p"), p="broken") is None
    assert one(spark, textfns.month_range_label("m"), m="2025-01, 2025-02, 2025-03") == "2025-01–2025-03"
    assert one(spark, textfns.month_range_label("m"), m="2025-01") == "2025-01"


def test_nested(spark):
    df = spark.sql("SELECT array('b', '', NULL, 'a', 'b') AS ids, array(named_struct('text', 'hola', 'language', 'es'), named_struct('text', 'hi', 'language', CAST(NULL AS STRING))) AS t")
    r = df.select(nested.sorted_ids(F.col("ids")).alias("ids"), nested.first_in_language(F.col("t")).alias("h")).first()
    assert r.ids == ["a", "b"] and r.h == "hi"


def test_sample_skewness(spark):
    x = [1.0, 2.0, 3.0, 10.0, 11.0, 50.0]
    got = spark.createDataFrame([(v,) for v in x], "x double").agg(stats.sample_skewness("x").alias("s")).first().s
    a = np.array(x)
    n, m = len(a), a.mean()
    g1 = ((a - m) ** 3).mean() / ((a - m) ** 2).mean() ** 1.5
    assert got == pytest.approx(g1 * np.sqrt(n * (n - 1)) / (n - 2))


@pytest.mark.parametrize("fan", [2, 16])
def test_exact_quantiles_with_a_hot_group_and_a_hot_value(spark, fan):
    rng = np.random.default_rng(1)
    groups = rng.choice(["hot", "a", "b", "c"], size=4000, p=[0.6, 0.2, 0.15, 0.05])
    values = np.round(rng.exponential(50, size=4000), 1)
    values[rng.random(4000) < 0.33] = 7.0
    df = spark.createDataFrame([(g, float(v)) for g, v in zip(groups, values)] + [("hot", None), ("one", 3.0)], "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 0.95, 0.99, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(probs))] for r in stats.exact_quantiles(df, "v", probs, ["g"], fan).collect()}
    for g in ("hot", "a", "b", "c"):
        assert got[g] == pytest.approx(list(np.quantile(values[groups == g], probs)))
    assert got["one"] == [3.0] * len(probs)
    whole = stats.exact_quantiles(df.where("g <> 'one'"), "v", probs, (), fan).first()
    assert list(whole) == pytest.approx(list(np.quantile(values, probs)))


def test_listed_clock_changes_equal_the_conversions(spark):
    """Every hour of days around changes, in listed and other years, in two zones."""
    days = spark.sql("SELECT explode(array(date'1918-03-31', date'1968-04-28', date'1974-01-06', date'1987-10-25', date'2007-03-11', date'2024-11-03', date'2025-03-09', date'2025-07-01', date'2149-11-02', date'2199-03-10', date'2025-03-30', date'2024-10-27')) AS d")
    around = days.select(F.explode(F.sequence(F.date_sub("d", 1), F.date_add("d", 1))).alias("d"))
    hours = around.select("d", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
    times = hours.select((F.col("d").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("h"), F.lit(30))).alias("t"))
    times = times.unionByName(times.select((F.col("t") - F.expr("INTERVAL 30 MINUTE")).alias("t")))
    for zone in ("America/New_York", "Europe/Berlin"):
        kinds = times.select(timefns.dst_kind("t", zone).alias("a"), timefns.converted_dst_kind("t", zone).alias("b"), timefns.is_dst_hour("t", zone).alias("c"))
        got = kinds.collect()
        assert [r.a for r in got] == [r.b for r in got] and [r.c for r in got] == [r.b is not None for r in got]
        assert {r.b for r in got} == {None, "nonexistent", "repeated"}
    assert spark.sql("SELECT CAST(NULL AS timestamp_ntz) AS t").select(timefns.is_dst_hour("t")).first()[0] is False


def test_value_parts_equal_the_statistics_of_all_rows(spark):
    from tidemark.operators import profile, value_parts

    df = spark.range(2000).select(
        F.expr("date_add(date'2025-01-01', cast(id % 100 as int))").alias("d"), F.expr("cast(id * 7919 % 613 as double) / 8 - 3").alias("x"),
        F.expr("cast(id % 17 as int)").alias("n"), F.expr("if(id % 5 = 0, null, concat('v', id % 23))").alias("s"),
    )
    parts = value_parts.value_parts(df, ["x", "n", "s"], "d").persist()
    assert sorted(map(tuple, value_parts.cardinality(parts).collect())) == sorted(map(tuple, profile.cardinality(df, ["x", "n", "s"]).collect()))
    a = {r.variable: r.asDict() for r in value_parts.numeric_summary(parts, ["x", "n"]).collect()}
    b = {r.variable: r.asDict() for r in profile.numeric_summary(df, ["x", "n"]).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert {c: v for c, v in a[k].items() if c != "variable"} == pytest.approx({c: v for c, v in b[k].items() if c != "variable"})
