"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import textfns, timefns
from tidemark.workload.fixtures import FACT, dst_sql, fact, table
from tidemark.workload.registry import query


@query(
    "text_functions",
    "F01 F03 F04 F07 F09 F10 F12",
    """SELECT o_orderkey, lower(trim(o_orderpriority)) AS lowered, trim(o_orderpriority) = '' AS blank, split_part(o_orderpriority, '-', 1) AS before, substr(o_orderpriority, 1, 3) AS prefix,
    contains(o_orderpriority, 'URG') AS urgent, "left"(o_orderpriority, 5) AS short, strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS stamp FROM orders""",
)
def _(spark, sf):
    p = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.lower(F.trim(p)).alias("lowered"),
        textfns.is_blank(p).alias("blank"),
        textfns.text_before(p, "-").alias("before"),
        textfns.stop_code(p).alias("prefix"),
        p.contains("URG").alias("urgent"),
        textfns.shorten(p, 5).alias("short"),
        timefns.month_key("o_orderdate").alias("month"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("stamp"),
    )


@query(
    "month_range_labels",
    "F06 F12 L01",
    r"""WITH m AS (SELECT o_custkey, string_agg(DISTINCT strftime(o_orderdate, '%Y-%m'), ', ' ORDER BY strftime(o_orderdate, '%Y-%m')) AS months FROM orders GROUP BY 1)
    SELECT o_custkey, months, regexp_replace(months, '^([^,]+),.*?([^, ]+)$', '\1–\2') AS label FROM m""",
)
def _(spark, sf):
    # Distinct months per customer: the calendar bounds the set.
    months = table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set(timefns.month_key("o_orderdate"))), ", ").alias("months"))
    return months.withColumn("label", textfns.month_range_label("months"))


@query(
    "date_parts",
    "D01 D02 D03 D06",
    """SELECT l_orderkey, l_linenumber, l_shipdate, CAST(date_trunc('hour', l_shipdate) AS TIMESTAMP) AS hour, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(year(l_shipdate) AS INT) AS y, CAST(month(l_shipdate) AS INT) AS m, CAST(day(l_shipdate) AS INT) AS d,
    CAST(isodow(l_shipdate) AS INT) AS dow, isodow(l_shipdate) >= 6 AS weekend, dayname(l_shipdate) AS name, CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE) AS next_month, CAST(24 * day(last_day(l_shipdate)) AS INT) AS month_hours FROM lineitem""",
)
def _(spark, sf):
    c = "l_shipdate"
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", c,
        timefns.hour_start(c).alias("hour"), timefns.month_start(c).alias("month"),
        F.year(c).alias("y"), F.month(c).alias("m"), F.dayofmonth(c).alias("d"),
        timefns.iso_weekday(c).alias("dow"), timefns.is_weekend(c).alias("weekend"), timefns.weekday_name(c).alias("name"),
        timefns.next_month(c).alias("next_month"), timefns.hours_in_month(c).alias("month_hours"),
    )


@query(
    "interval_arithmetic",
    "D04 D07",
    """SELECT event_id, ts - INTERVAL 7 DAY AS week_before, ts + INTERVAL 2 HOUR AS later, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS minute, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour FROM events""",
)
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("seconds", F.unix_seconds(F.col("ts").cast("timestamp")))
    return e.select(
        "event_id",
        (F.col("ts") - F.expr("INTERVAL 7 DAY")).alias("week_before"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(2))).alias("later"),
        "seconds",
        timefns.minute_floor("seconds").cast("timestamp_ntz").alias("minute"),
        timefns.hour_floor("seconds").cast("timestamp_ntz").alias("hour"),
    )


@query(
    "clock_text_seconds",
    "D08",
    """SELECT l_orderkey, l_partkey, lpad(CAST(l_orderkey % 30 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ':00' AS clock,
    CAST((l_orderkey % 30) * 3600 + (l_partkey % 60) * 60 AS INT) AS seconds FROM lineitem""",
)
def _(spark, sf):
    l = table(spark, sf, "lineitem")
    clock = F.format_string("%02d:%02d:00", F.col("l_orderkey") % 30, F.col("l_partkey") % 60)
    return l.select("l_orderkey", "l_partkey", clock.alias("clock")).withColumn("seconds", timefns.clock_seconds("clock"))


_U = "(hour AT TIME ZONE 'America/New_York')"


@query(
    "dst_hours",
    "D10 R12 D05",
    f"""WITH h AS (SELECT unnest(generate_series(date_trunc('hour', min(o_orderdate)), date_trunc('hour', max(o_orderdate)), INTERVAL 1 HOUR)) AS hour FROM orders)
    SELECT hour, CASE WHEN {_U} AT TIME ZONE 'America/New_York' <> hour THEN 'nonexistent' ELSE 'repeated' END AS kind FROM h WHERE {dst_sql('hour')}""",
)
def _(spark, sf):
    """Every hour of the orders' span classified; a few change the clock."""
    hours = timefns.hour_span(table(spark, sf, "orders"), "o_orderdate")
    return hours.withColumn("kind", timefns.dst_kind("hour")).where("kind IS NOT NULL")


@query("dst_marks", "R12 D10", f"WITH {FACT} SELECT transit_timestamp, count(*) AS rows FROM fact WHERE {dst_sql('transit_timestamp')} GROUP BY 1")
def _(spark, sf):
    return fact(spark, sf).where(timefns.is_dst_hour("transit_timestamp")).groupBy("transit_timestamp").agg(F.count("*").alias("rows"))


_HOLIDAYS = """y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders),
  d AS (SELECT CAST(unnest(generate_series(make_date(year, 1, 1), make_date(year, 12, 31), INTERVAL 1 DAY)) AS DATE) AS day FROM y),
  fixed AS (SELECT day FROM d WHERE (month(day), day(day)) IN ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))),
  hol AS (SELECT day FROM fixed UNION SELECT CAST(day + CASE isodow(day) WHEN 6 THEN -1 WHEN 7 THEN 1 ELSE 0 END AS DATE) FROM fixed
    UNION SELECT day FROM d WHERE (month(day) = 1 AND isodow(day) = 1 AND day(day) BETWEEN 15 AND 21) OR (month(day) = 2 AND isodow(day) = 1 AND day(day) BETWEEN 15 AND 21)
      OR (month(day) = 5 AND isodow(day) = 1 AND day(day) >= 25) OR (month(day) = 9 AND isodow(day) = 1 AND day(day) <= 7) OR (month(day) = 10 AND isodow(day) = 1 AND day(day) BETWEEN 8 AND 14)
      OR (month(day) = 11 AND isodow(day) = 4 AND day(day) BETWEEN 22 AND 28))"""


def holiday_days(spark, sf):
    return timefns.holidays(table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct())


@query("holidays", "D11", f"WITH {_HOLIDAYS} SELECT DISTINCT day FROM hol")
def _(spark, sf):
    return holiday_days(spark, sf)


@query(
    "holiday_flags",
    "J15 M03",
    f"WITH {_HOLIDAYS} SELECT o_orderkey, CAST(o_orderdate AS DATE) IN (SELECT day FROM hol) AS is_holiday FROM orders",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    flags = holiday_days(spark, sf).withColumn("_h", F.lit(True))
    # At most 17 dates a year.
    return orders.join(F.broadcast(flags), "day", "left").select("o_orderkey", F.col("_h").isNotNull().alias("is_holiday"))


@query(
    "category_lists",
    "L01 L03",
    """WITH g AS (SELECT user_id, list_sort(list_distinct(list(event_type))) AS kinds FROM events GROUP BY 1)
    SELECT user_id, array_to_string(kinds, ',') AS kinds, CAST(len(kinds) AS INT) AS n, list_contains(kinds, 'error') AS has_error, list_has_any(kinds, ['click', 'view']) AS browsed FROM g""",
)
def _(spark, sf):
    # Five event types bound the set.
    g = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("k"))
    return g.select(
        "user_id",
        F.array_join("k", ",").alias("kinds"),
        F.size("k").alias("n"),
        F.array_contains("k", "error").alias("has_error"),
        F.arrays_overlap("k", F.array(F.lit("click"), F.lit("view"))).alias("browsed"),
    )


@query(
    "number_functions",
    "N01 N02 N03",
    """SELECT event_id, floor(value) AS floored, round(value, 1) AS rounded, greatest(value - 50, 0) AS clipped, abs(value - 50) AS distance, round(ln(1 + value), 9) AS logged, round(exp(ln(1 + value)) - 1, 6) AS back,
    100.0 * value / nullif(floor(value / 40), 0) AS pct FROM events""",
)
def _(spark, sf):
    from tidemark.functions.stats import percent

    v = F.col("value")
    return table(spark, sf, "events").select(
        "event_id",
        F.floor(v).cast("double").alias("floored"),
        F.round(v, 1).alias("rounded"),
        F.greatest(v - 50, F.lit(0.0)).alias("clipped"),
        F.abs(v - 50).alias("distance"),
        F.round(F.log1p(v), 9).alias("logged"),
        F.round(F.expm1(F.log1p(v)), 6).alias("back"),
        percent(v, F.floor(v / 40).cast("double")).alias("pct"),
    )


@query("value_types", "H02", "SELECT 'value' AS name, lower(typeof(value)) AS type FROM events LIMIT 1")
def _(spark, sf):
    return table(spark, sf, "events").agg(F.any_value(F.typeof("value")).alias("type")).select(F.lit("value").alias("name"), "type")


@query("row_hash_spread", "H01")
def _(spark, sf):
    """Rows-only: rows per bucket of a 64-bit hash over two columns."""
    h = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(16))
    return table(spark, sf, "lineitem").groupBy(h.alias("bucket")).agg(F.count("*").alias("rows"))
