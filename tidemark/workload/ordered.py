"""Neighbours, running values, rolling means and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import series, shape
from tidemark.workload.fixtures import FACT, fact, table
from tidemark.workload.registry import query


@query(
    "order_check",
    "W01 O01",
    """SELECT count(*) AS rows, count(*) FILTER (p = o_orderdate) AS adjacent_duplicates, count(*) FILTER (o_orderdate < p) AS out_of_order FROM (SELECT o_orderdate, lag(o_orderdate) OVER (ORDER BY o_orderkey) AS p FROM orders)""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return series.order_check(orders, ["o_orderdate"], ["o_orderkey"], series.number_slices("o_orderkey"))


@query(
    "previous_event",
    "W05 T08",
    "SELECT event_id, user_id, lag(event_id) OVER w AS previous_id, lag(event_type) OVER w AS previous_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    stepped = series.previous_row(e, ["user_id"], ["ts"], series.time_slices("ts"), ["event_id", "event_type"])
    return stepped.select("event_id", "user_id", F.col("prev.event_id").alias("previous_id"), F.col("prev.event_type").alias("previous_type"))


@query(
    "running_max",
    "W04",
    "SELECT event_id, max(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_before FROM events",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    return series.running_max_before(e, ["event_type"], ["event_id"], series.number_slices("event_id"), "value", "max_before").select("event_id", "max_before")


@query(
    "top_n_per_group",
    "W02",
    "SELECT o_custkey, o_orderkey, o_totalprice, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return series.first_rows(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query(
    "centered_mean_7",
    "W03",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(floor(o_totalprice)) AS total FROM orders GROUP BY 1)
    SELECT day, CAST(total AS DOUBLE) AS total, (SELECT CASE WHEN count(*) = 7 THEN round(avg(n.total), 7) END FROM d n WHERE n.day BETWEEN d.day - 3 AND d.day + 3) AS rolling_mean FROM d""",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    days = shape.system_days(o.withColumn("v", F.floor("o_totalprice").cast("double")), "o_orderdate", "v")
    return series.centered_mean(days, "day", "total").withColumn("rolling_mean", F.round("rolling_mean", 7))


_RANGES = "r AS (SELECT CAST(ts AS DATE) AS day, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY 1)"


@query(
    "range_contiguity",
    "W06 A53",
    f"WITH {_RANGES}, s AS (SELECT *, lag(b) OVER (ORDER BY a) AS p FROM r) SELECT count(*) AS ranges, count(*) FILTER (a <> p + 1) AS breaks, count(*) FILTER (a <> p + 1) = 0 AS contiguous FROM s",
)
def _(spark, sf):
    ranges = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.min("event_id").alias("a"), F.max("event_id").alias("b"))
    return series.contiguous(ranges, "a", "b", "a", F.trunc("day", "MM"))


@query(
    "range_overlaps",
    "W07",
    """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY 1)
    SELECT month, first_key, last_key, coalesce(lag(last_key) OVER (ORDER BY month) >= first_key, false) AS overlaps FROM m""",
)
def _(spark, sf):
    spans = table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", "MM").alias("month")).agg(F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
    return series.overlaps(spans, "month", "first_key", "last_key", F.year("month"))


_UH = "u AS (SELECT user_id, CAST(hour(ts) AS INT) AS hour, count(*) AS n FROM events GROUP BY 1, 2)"


def user_hours(spark, sf):
    return table(spark, sf, "events").groupBy("user_id", F.hour("ts").alias("hour")).agg(F.count("*").alias("n"))


@query("share_in_group", "W08", f"WITH {_UH} SELECT user_id, hour, n, round(n / sum(n) OVER (PARTITION BY user_id), 9) AS share FROM u")
def _(spark, sf):
    return series.share_in_group(user_hours(spark, sf), ["user_id"], "n").withColumn("share", F.round("share", 9))


@query("peak_hour", "W09", f"WITH {_UH} SELECT user_id, hour AS peak, n AS peak_value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, hour) AS r FROM u) WHERE r = 1")
def _(spark, sf):
    return series.peak_label(user_hours(spark, sf), ["user_id"], "hour", "n", "peak")


_ST = "s AS (SELECT station_complex_id, any_value(borough) AS borough, sum(ridership) AS total FROM fact GROUP BY 1)"


def stations(spark, sf):
    return fact(spark, sf).groupBy("station_complex_id").agg(F.any_value("borough").alias("borough"), F.sum("ridership").alias("total"))


@query(
    "top_names",
    "W10",
    f"""WITH {FACT}, {_ST}, r AS (SELECT *, row_number() OVER (PARTITION BY borough ORDER BY total DESC, station_complex_id) AS i FROM s)
    SELECT borough, string_agg(station_complex_id, '; ' ORDER BY i) AS top_names FROM r WHERE i <= 3 GROUP BY 1""",
)
def _(spark, sf):
    return series.top_names(stations(spark, sf), ["borough"], "station_complex_id", "total")


@query(
    "renumbered_groups",
    "W11",
    f"""WITH {FACT}, {_ST}, m AS (SELECT borough, row_number() OVER (ORDER BY avg(total), borough) - 1 AS number FROM s GROUP BY 1) SELECT station_complex_id, borough, CAST(total AS DOUBLE) AS total, CAST(number AS INT) AS number FROM s JOIN m USING (borough)""",
)
def _(spark, sf):
    return series.renumber(stations(spark, sf), "borough", "total", "number").select("station_complex_id", "borough", "total", "number")
