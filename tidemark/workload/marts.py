"""Marts, dimensions and the result queries on top of them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import marts, quality, series, shape
from tidemark.plans import dashboard
from tidemark.session import scratch
from tidemark.sources.tables import bucketed
from tidemark.workload.fixtures import CLEAN, FACT, clean_fact, fact, table
from tidemark.workload.registry import query

_DAILY = """d AS (SELECT CAST(transit_timestamp AS DATE) AS day, station_complex_id, CAST(sum(ridership) AS BIGINT) AS ridership, CAST(sum(transfers) AS BIGINT) AS transfers,
  CAST(coalesce(sum(ridership) FILTER (payment_method = 'omny'), 0) AS BIGINT) AS omny_ridership FROM clean GROUP BY 1, 2)"""
_HOURLY = """h AS (SELECT transit_timestamp AS hour, payment_method, CAST(sum(ridership) AS BIGINT) AS ridership, CAST(sum(transfers) AS BIGINT) AS transfers,
  bool_or(is_dst_transition) AS is_dst_transition FROM clean GROUP BY 1, 2)"""
_STATION = """s AS (SELECT station_complex_id, arg_max(station_complex, (transit_timestamp, station_complex)) AS station_complex, arg_max(borough, (transit_timestamp, borough)) AS borough,
  arg_max(transit_mode, (transit_timestamp, transit_mode)) AS transit_mode, arg_max(latitude, (transit_timestamp, latitude)) AS latitude,
  arg_max(longitude, (transit_timestamp, longitude)) AS longitude FROM clean GROUP BY 1)"""
_PROFILE = """typed AS (SELECT *, CASE WHEN isodow(transit_timestamp) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type FROM clean),
  n AS (SELECT day_type, count(DISTINCT CAST(transit_timestamp AS DATE)) AS days FROM typed GROUP BY 1),
  p AS (SELECT station_complex_id, day_type, CAST(hour(transit_timestamp) AS INT) AS hour_of_day, sum(ridership) / any_value(days) AS mean_ridership
        FROM typed JOIN n USING (day_type) GROUP BY 1, 2, 3)"""


@query("hourly_by_method", "A03 O02 D01", f"WITH {CLEAN}, {_HOURLY} SELECT * FROM h")
def _(spark, sf):
    return marts.hourly_by_method(clean_fact(spark, sf), dst_flag=True)


@query("daily_by_station", "A04 P10", f"WITH {CLEAN}, {_DAILY} SELECT * FROM d")
def _(spark, sf):
    return marts.daily_by_station(clean_fact(spark, sf))


@query(
    "daily_by_class",
    "A05",
    f"WITH {CLEAN} SELECT CAST(transit_timestamp AS DATE) AS day, fare_class_category, CAST(sum(ridership) AS BIGINT) AS ridership FROM clean GROUP BY 1, 2",
)
def _(spark, sf):
    return marts.daily_by_class(clean_fact(spark, sf))


@query("station_dim_latest", "A06 A10", f"WITH {CLEAN}, {_STATION} SELECT * FROM s")
def _(spark, sf):
    return marts.station_dim(clean_fact(spark, sf))


_DATE = """SELECT d AS date, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(isodow(d) AS INT) AS day_of_week, isodow(d) >= 6 AS is_weekend"""


@query(
    "date_dim",
    "A07 D05 D03",
    f"{_DATE} FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)",
)
def _(spark, sf):
    return marts.date_dim(table(spark, sf, "orders"), "o_orderdate")


@query("date_dim_observed", "A07", f"{_DATE} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)")
def _(spark, sf):
    return marts.date_dim(table(spark, sf, "orders"), "o_orderdate", observed_only=True)


@query(
    "dominant_category",
    "A08",
    """SELECT user_id, event_type AS main_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type DESC) AS rn
    FROM events GROUP BY 1, 2) WHERE rn = 1""",
)
def _(spark, sf):
    return quality.dominant_value(table(spark, sf, "events"), "user_id", "event_type", "main_type")


@query("hour_profile_zero_filled", "A09 P08", f"WITH {CLEAN}, {_PROFILE} SELECT station_complex_id, day_type, hour_of_day, round(mean_ridership, 6) AS mean_ridership FROM p")
def _(spark, sf):
    return marts.station_hour_profile(clean_fact(spark, sf)).withColumn("mean_ridership", F.round("mean_ridership", 6))


@query(
    "fact_dimension_totals",
    "J02 S13",
    f"WITH {CLEAN}, {_DAILY}, {_STATION} SELECT borough, transit_mode, CAST(sum(ridership) AS BIGINT) AS ridership FROM d JOIN s USING (station_complex_id) GROUP BY 1, 2",
)
def _(spark, sf):
    cleaned = clean_fact(spark, sf)
    return marts.fact_with_dimension(marts.daily_by_station(cleaned), marts.station_dim(cleaned), "station_complex_id", ["borough", "transit_mode"], "ridership")


@query(
    "bucketed_station_totals",
    "J01 J02 J16",
    f"""WITH {CLEAN}, {_DAILY}, {_STATION}, t AS (SELECT station_complex_id, sum(ridership) AS total FROM d GROUP BY 1)
    SELECT day, borough, transit_mode, CAST(sum(ridership) AS BIGINT) AS ridership, round(sum(ridership / total), 9) AS shares FROM d JOIN s USING (station_complex_id) JOIN t USING (station_complex_id) GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    """Fact, dimension and station totals in the same buckets: they meet without an exchange."""
    days, stations, totals = bucketed_marts(clean_fact(spark, sf), scratch(spark, "buckets"))
    joined = days.join(stations, "station_complex_id").join(totals, "station_complex_id")
    return joined.groupBy("day", "borough", "transit_mode").agg(F.sum("ridership").alias("ridership"), F.round(F.sum(F.col("ridership") / F.col("total")), 9).alias("shares"))


def bucketed_marts(cleaned, path: str, buckets: int = 8):
    spark, key, tag = cleaned.sparkSession, "station_complex_id", uuid.uuid4().hex[:8]
    days = bucketed(marts.daily_by_station(cleaned), f"tidemark_days_{tag}", f"{path}/days", [key], buckets)
    stations = bucketed(marts.station_dim(cleaned), f"tidemark_stations_{tag}", f"{path}/stations", [key], buckets)
    totals = bucketed(days.groupBy(key).agg(F.sum("ridership").alias("total")), f"tidemark_totals_{tag}", f"{path}/totals", [key], buckets)
    return days, stations, totals


# --- dashboard ---------------------------------------------------------------


@query(
    "dashboard_overview",
    "V01 W12 J18",
    f"""WITH {CLEAN}, {_DAILY}, t AS (SELECT day, sum(ridership) AS total, sum(omny_ridership) AS omny FROM d GROUP BY 1),
    a AS (SELECT *, (SELECT max(day) FROM t) - day AS age FROM t)
    SELECT max(day) AS last_day, CAST(sum(total) FILTER (age < 7) AS BIGINT) AS week_total,
    round(100.0 * sum(total) FILTER (age < 7) / sum(total) FILTER (age >= 7 AND age < 14) - 100, 6) AS week_change_pct,
    round(avg(total) FILTER (age < 30), 6) AS mean_day_30, round(100.0 * sum(omny) FILTER (age < 30) / sum(total) FILTER (age < 30), 6) AS omny_pct_30 FROM a""",
)
def _(spark, sf):
    out = dashboard.overview(marts.daily_by_station(clean_fact(spark, sf)))
    return out.select("last_day", "week_total", *[F.round(c, 6).alias(c) for c in ("week_change_pct", "mean_day_30", "omny_pct_30")])


@query(
    "dashboard_daily_series",
    "V02 P04 P11",
    f"""WITH {CLEAN}, {_DAILY} SELECT day, series, CAST(value AS BIGINT) AS value FROM (
    SELECT day, 'omny' AS series, sum(omny_ridership) AS value FROM d WHERE day >= DATE '2024-03-05' AND day < DATE '2024-03-20' GROUP BY 1
    UNION ALL SELECT day, 'metrocard', sum(ridership) - sum(omny_ridership) FROM d WHERE day >= DATE '2024-03-05' AND day < DATE '2024-03-20' GROUP BY 1)""",
)
def _(spark, sf):
    return dashboard.daily_series(marts.daily_by_station(clean_fact(spark, sf)), "2024-03-05", "2024-03-20")


@query(
    "dashboard_top_stations",
    "V03 J18 J02 O03",
    f"""WITH {CLEAN}, {_DAILY}, {_STATION}, m AS (SELECT max(day) AS last FROM d),
    t AS (SELECT station_complex_id, sum(ridership) AS total FROM d, m WHERE day > last - 30 GROUP BY 1),
    n AS (SELECT count(DISTINCT day) AS days FROM d, m WHERE day > last - 30)
    SELECT station_complex_id, station_complex, borough, round(total / days, 6) AS mean_daily FROM t JOIN s USING (station_complex_id), n ORDER BY total DESC, station_complex_id LIMIT 15""",
)
def _(spark, sf):
    cleaned = clean_fact(spark, sf)
    out = dashboard.top_stations(marts.daily_by_station(cleaned), marts.station_dim(cleaned))
    return out.withColumn("mean_daily", F.round("mean_daily", 6))


@query(
    "dashboard_station_series",
    "V04",
    f"""WITH {CLEAN}, {_DAILY}, b AS (SELECT station_complex_id FROM d GROUP BY 1 ORDER BY sum(ridership) DESC, station_complex_id LIMIT 1)
    SELECT day, ridership, transfers FROM d WHERE station_complex_id = (SELECT station_complex_id FROM b)""",
)
def _(spark, sf):
    daily = marts.daily_by_station(clean_fact(spark, sf))
    return dashboard.station_series(daily, dashboard.busiest_station(daily))


_HOURS = "x AS (SELECT hour, sum(ridership) AS total FROM h GROUP BY 1)"


@query(
    "dashboard_week_matrix",
    "V05 A37 D04",
    f"""WITH {CLEAN}, {_HOURLY}, {_HOURS}, w AS (SELECT * FROM x WHERE hour > (SELECT max(hour) FROM x) - INTERVAL 14 DAY)
    SELECT CAST(isodow(hour) AS INT) AS iso_weekday, """
    + ", ".join(f"round(coalesce(avg(total) FILTER (hour(hour) = {i}), 0), 6) AS h{i:02d}" for i in range(24))
    + " FROM w GROUP BY 1",
)
def _(spark, sf):
    hourly = marts.hourly_by_method(clean_fact(spark, sf))
    out = dashboard.week_matrix(hourly, 2)
    return out.select("iso_weekday", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query(
    "dashboard_quality_pivot",
    "V06 P12",
    f"""WITH {CLEAN}, m AS (SELECT CAST(date_trunc('month', transit_timestamp) AS DATE) AS month, * FROM moded)
    SELECT month, count(*) FILTER (transfers < 0) AS negative_transfers, count(*) FILTER (transit_mode <> station_mode) AS station_mode_mismatch FROM m GROUP BY 1""",
)
def _(spark, sf):
    from tidemark.workload.fixtures import moded

    long = quality.counts_by_month(moded(fact(spark, sf)), quality.fact_rules())
    return dashboard.quality_pivot(long, ["negative_transfers", "station_mode_mismatch"])


@query(
    "top_station_totals",
    "O03 A13",
    f"WITH {FACT} SELECT station_complex_id, CAST(sum(ridership) AS DOUBLE) AS total, count(*) AS rows FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def _(spark, sf):
    per = fact(spark, sf).groupBy("station_complex_id").agg(F.sum("ridership").alias("total"), F.count("*").alias("rows"))
    return series.top_k(per, 10, F.desc("total"), "station_complex_id")


@query(
    "extreme_station_hours",
    "A58",
    f"""WITH {FACT} SELECT transit_timestamp, station_complex_id, CAST(sum(ridership) AS DOUBLE) AS total, dayname(transit_timestamp) AS weekday FROM fact
    GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""",
)
def _(spark, sf):
    from tidemark.functions.timefns import weekday_name

    per = fact(spark, sf).groupBy("transit_timestamp", "station_complex_id").agg(F.sum("ridership").alias("total"))
    return series.top_k(per, 20, F.desc("total"), "transit_timestamp", "station_complex_id").withColumn("weekday", weekday_name("transit_timestamp"))
