"""Time profiles, shares, concentration, grids and lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import timefns
from tidemark.operators import grid, series, shape
from tidemark.workload.fixtures import CLEAN, FACT, clean_fact, dst_sql, fact, table
from tidemark.workload.registry import query

_H = "h AS (SELECT date_trunc('hour', ts) AS hour, sum(value) AS total FROM events GROUP BY 1)"
_D = "d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS total FROM orders GROUP BY 1)"


def hours(spark, sf):
    return shape.system_hours(table(spark, sf, "events"), "ts", "value")


def days(spark, sf):
    return shape.system_days(table(spark, sf, "orders"), "o_orderdate", "o_totalprice")


def rounded(df, **digits):
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in df.columns])


@query("hour_of_day_profile", "A35 D02", f"WITH {_H} SELECT CAST(hour(hour) AS INT) AS hour_of_day, round(avg(total), 7) AS mean_total, count(*) AS hours FROM h GROUP BY 1")
def _(spark, sf):
    return rounded(shape.hour_profile(hours(spark, sf)), mean_total=7)


@query("weekday_profile", "A36 D03", f"WITH {_D} SELECT CAST(isodow(day) AS INT) AS iso_weekday, dayname(day) AS weekday, round(avg(total), 7) AS mean_total, count(*) AS days FROM d GROUP BY 1, 2")
def _(spark, sf):
    return rounded(shape.weekday_profile(days(spark, sf)), mean_total=7)


@query(
    "weekday_hour_matrix",
    "A37 P12",
    f"WITH {_H} SELECT CAST(isodow(hour) AS INT) AS iso_weekday, " + ", ".join(f"round(coalesce(avg(total) FILTER (hour(hour) = {i}), 0), 7) AS h{i:02d}" for i in range(24)) + " FROM h GROUP BY 1",
)
def _(spark, sf):
    return rounded(shape.weekday_hour_matrix(hours(spark, sf)), **{f"h{i:02d}": 7 for i in range(24)})


@query(
    "busiest_hours",
    "A38",
    f"""WITH {_H}, p AS (SELECT CAST(hour(hour) AS INT) AS hour_of_day, avg(total) AS m FROM h WHERE isodow(hour) < 6 GROUP BY 1)
    SELECT hour_of_day, round(m, 7) AS mean_total, round(100.0 * m / (SELECT sum(m) FROM p), 7) AS share_pct FROM p ORDER BY m DESC, 1 LIMIT 4""",
)
def _(spark, sf):
    return rounded(shape.busiest_hours(hours(spark, sf)), mean_total=7, share_pct=7)


@query(
    "headline_numbers",
    "A39 N03",
    f"""WITH {CLEAN}, d AS (SELECT CAST(transit_timestamp AS DATE) AS day, sum(ridership) AS r, sum(transfers) AS t, sum(ridership) FILTER (payment_method = 'omny') AS o FROM clean GROUP BY 1)
    SELECT count(*) AS days, CAST(sum(r) AS BIGINT) AS total, round(avg(r), 7) AS mean_day, round(avg(r) FILTER (isodow(day) < 6), 7) AS mean_weekday, round(avg(r) FILTER (isodow(day) >= 6), 7) AS mean_weekend_day,
    round(100.0 * sum(t) / sum(r), 7) AS transfers_pct, round(100.0 * sum(o) / sum(r), 7) AS omny_pct FROM d""",
)
def _(spark, sf):
    h = shape.headline(clean_fact(spark, sf), "transit_timestamp", "ridership", "transfers", F.col("payment_method") == "omny")
    return rounded(h, mean_day=7, mean_weekday=7, mean_weekend_day=7, transfers_pct=7, omny_pct=7)


_M = "m AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS days, avg(total) AS mean_day FROM d GROUP BY 1)"


@query("monthly_mean", "A40 D06", f"WITH {_D}, {_M} SELECT month, days, round(mean_day, 7) AS mean_day, days >= day(last_day(month)) AS complete FROM m")
def _(spark, sf):
    return rounded(shape.monthly_mean(days(spark, sf)), mean_day=7)


@query(
    "year_over_year",
    "A41",
    f"""WITH {_D}, {_M}, n AS (SELECT max(year(month)) AS newest FROM m),
    y AS (SELECT CAST(month(month) AS INT) AS calendar_month, max(mean_day) FILTER (year(month) = newest - 1) AS a, max(mean_day) FILTER (year(month) = newest) AS b FROM m, n GROUP BY 1)
    SELECT calendar_month, round(a, 7) AS mean_previous, round(b, 7) AS mean_latest, round(100 * (b / a - 1), 7) AS change_pct FROM y""",
)
def _(spark, sf):
    """The two newest years of the data."""
    months = shape.monthly_mean(days(spark, sf))
    newest = months.agg(F.year(F.max("month"))).first()[0]
    both = shape.year_over_year(months, [newest - 1, newest]).withColumnsRenamed({f"mean_{newest - 1}": "mean_previous", f"mean_{newest}": "mean_latest"})
    return rounded(both, mean_previous=7, mean_latest=7, change_pct=7)


@query(
    "monthly_share",
    "A42",
    "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(100.0 * sum(o_totalprice) FILTER (o_orderstatus = 'F') / sum(o_totalprice), 7) AS share_pct FROM orders GROUP BY 1",
)
def _(spark, sf):
    return rounded(shape.monthly_share(table(spark, sf, "orders"), "o_orderdate", "o_totalprice", F.col("o_orderstatus") == "F"), share_pct=7)


@query(
    "yearly_category_share",
    "A43 W08",
    """WITH t AS (SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderpriority, sum(o_totalprice) AS total FROM orders GROUP BY 1, 2)
    SELECT year, o_orderpriority, round(total, 2) AS total, round(total / sum(total) OVER (PARTITION BY year), 6) AS share FROM t""",
)
def _(spark, sf):
    return rounded(shape.yearly_category_share(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority", "o_totalprice"), total=2, share=6)


_ST = "st AS (SELECT station_complex_id, any_value(borough) AS borough, CAST(sum(ridership) AS DOUBLE) AS total FROM fact GROUP BY 1)"


def stations(spark, sf):
    return fact(spark, sf).groupBy("station_complex_id").agg(F.any_value("borough").alias("borough"), F.sum("ridership").alias("total"))


@query(
    "borough_rollup",
    "A44",
    f"""WITH {FACT}, {_ST} SELECT borough, count(*) AS entities, CAST(sum(total) AS DOUBLE) AS total, round(100.0 * sum(total) / (SELECT sum(total) FROM st), 6) AS share_pct,
    round(sum(total) / count(*) / (SELECT count(DISTINCT CAST(transit_timestamp AS DATE)) FROM fact), 6) AS mean_entity_day FROM st GROUP BY 1""",
)
def _(spark, sf):
    n = fact(spark, sf).select(F.to_date("transit_timestamp")).distinct().agg(F.count("*")).scalar()
    return rounded(shape.rollup_share(stations(spark, sf), "borough", "total", n), share_pct=6, mean_entity_day=6)


@query(
    "top_k_share",
    "A45 W13",
    f"""WITH {FACT}, {_ST}, r AS (SELECT total, row_number() OVER (ORDER BY total DESC, station_complex_id) AS i FROM st), k(k) AS (VALUES (10), (50))
    SELECT k.k, round(100.0 * sum(total) FILTER (i <= k.k) / sum(total), 6) AS share_pct FROM r, k GROUP BY 1""",
)
def _(spark, sf):
    return rounded(series.cumulative_share(stations(spark, sf), "total", [10, 50], [F.desc("total"), F.asc("station_complex_id")]), share_pct=6)


_SHARE = """sh AS (SELECT station_complex_id, CAST(sum(ridership) AS DOUBLE) AS total, 100.0 * coalesce(sum(ridership) FILTER (hour(transit_timestamp) IN (6, 7, 8, 9)), 0) / sum(ridership) AS am_share,
  100.0 * coalesce(sum(ridership) FILTER (hour(transit_timestamp) IN (16, 17, 18, 19)), 0) / sum(ridership) AS pm_share FROM fact WHERE isodow(transit_timestamp) < 6 GROUP BY 1)"""


def shares(spark, sf):
    return shape.hour_shares(fact(spark, sf), "station_complex_id", "transit_timestamp", "ridership")


@query("station_hour_shares", "A46 W08", f"WITH {FACT}, {_SHARE} SELECT station_complex_id, total, round(am_share, 6) AS am_share, round(pm_share, 6) AS pm_share FROM sh")
def _(spark, sf):
    return rounded(shares(spark, sf), am_share=6, pm_share=6)


@query("heavy_counts", "A46", f"WITH {FACT}, {_SHARE} SELECT count(*) FILTER (am_share > pm_share) AS morning_heavy, count(*) FILTER (am_share <= pm_share) AS evening_heavy FROM sh")
def _(spark, sf):
    return shape.heavy_counts(shares(spark, sf))


@query(
    "representative_stations",
    "A47 W09",
    f"""WITH {FACT}, {_SHARE}, b AS (SELECT station_complex_id, round(am_share - pm_share, 6) AS d FROM sh ORDER BY total DESC, station_complex_id LIMIT 50)
    SELECT 'morning_heavy' AS profile, (SELECT station_complex_id FROM b ORDER BY d DESC, station_complex_id DESC LIMIT 1) AS station_complex_id
    UNION ALL SELECT 'evening_heavy', (SELECT station_complex_id FROM b ORDER BY d, station_complex_id LIMIT 1)
    UNION ALL SELECT 'balanced', (SELECT station_complex_id FROM b ORDER BY abs(d), station_complex_id LIMIT 1)""",
)
def _(spark, sf):
    return shape.representatives(shares(spark, sf), "station_complex_id")


@query(
    "transition_days",
    "A33 J11",
    f"""WITH {FACT}, x AS (SELECT transit_timestamp AS hour, sum(ridership) AS total FROM fact GROUP BY 1), t(label, day) AS (VALUES ('week before', DATE '2024-03-03'), ('clock change', DATE '2024-03-10'), ('week after', DATE '2024-03-17'))
    SELECT label, day, """ + ", ".join(f"CAST(sum(total) FILTER (hour(hour) = {i}) AS DOUBLE) AS h{i:02d}" for i in range(5)) + """, count(*) AS hours_present FROM x JOIN t ON CAST(hour AS DATE) = day GROUP BY 1, 2""",
)
def _(spark, sf):
    import datetime as dt

    labels = spark.createDataFrame(
        [("week before", dt.date(2024, 3, 3)), ("clock change", dt.date(2024, 3, 10)), ("week after", dt.date(2024, 3, 17))], "label string, day date"
    )
    return shape.transition_days(fact(spark, sf), "transit_timestamp", "ridership", labels)


@query(
    "transition_hour_neighbours",
    "A34",
    f"""WITH {FACT}, x AS (SELECT transit_timestamp, sum(ridership) AS total FROM fact GROUP BY 1), c AS (SELECT * FROM x WHERE {dst_sql('transit_timestamp')})
    SELECT c.transit_timestamp, CAST(c.total AS DOUBLE) AS value, avg(n.total) AS neighbour_mean FROM c LEFT JOIN x n ON n.transit_timestamp IN (c.transit_timestamp - INTERVAL 7 DAY, c.transit_timestamp + INTERVAL 7 DAY) GROUP BY 1, 2""",
)
def _(spark, sf):
    x = fact(spark, sf).groupBy("transit_timestamp").agg(F.sum("ridership").alias("total"))
    return grid.neighbour_mean(x, "transit_timestamp", "total", timefns.is_dst_hour("transit_timestamp"))


# --- dense grid and lags ------------------------------------------------------

_EH = "eh AS (SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1, 2)"
_GRID = f"""{_EH}, g AS (SELECT u.user_id, x.hour, coalesce(eh.n, 0) AS n FROM (SELECT DISTINCT user_id FROM eh) u
  CROSS JOIN (SELECT unnest(generate_series((SELECT min(hour) FROM eh), (SELECT max(hour) FROM eh), INTERVAL 1 HOUR)) AS hour) x LEFT JOIN eh ON eh.user_id = u.user_id AND eh.hour = x.hour)"""


def entity_hours(spark, sf):
    return table(spark, sf, "events").groupBy("user_id", timefns.hour_start("ts").alias("hour")).agg(F.count("*").cast("double").alias("n"))


def event_grid(spark, sf):
    return grid.dense_grid(entity_hours(spark, sf), "user_id", "hour", "n")


@query("dense_grid", "J06 J07 M01 D05", f"WITH {_GRID} SELECT * FROM g")
def _(spark, sf):
    return event_grid(spark, sf)


@query("recent_grid", "M01", f"WITH {_GRID} SELECT * FROM g WHERE hour > (SELECT max(hour) FROM eh) - INTERVAL 7 DAY")
def _(spark, sf):
    return grid.dense_grid(entity_hours(spark, sf), "user_id", "hour", "n", last_days=7)


@query(
    "grid_without_dst",
    "M02 J06 D10",
    f"""WITH {FACT}, sh AS (SELECT station_complex_id, transit_timestamp, sum(ridership) AS riders FROM fact GROUP BY 1, 2),
    h AS (SELECT DISTINCT transit_timestamp FROM sh WHERE NOT {dst_sql('transit_timestamp')}), s AS (SELECT DISTINCT station_complex_id FROM sh)
    SELECT s.station_complex_id, h.transit_timestamp, CAST(coalesce(riders, 0) AS DOUBLE) AS riders FROM h CROSS JOIN s LEFT JOIN sh ON sh.station_complex_id = s.station_complex_id AND sh.transit_timestamp = h.transit_timestamp""",
)
def _(spark, sf):
    per = fact(spark, sf).groupBy("station_complex_id", "transit_timestamp").agg(F.sum("ridership").alias("riders"))
    return grid.dense_grid(per, "station_complex_id", "transit_timestamp", "riders", drop_dst=True)


_LAGS = {"lag_1h": 1, "lag_24h": 24, "lag_7d": 168, "lag_14d": 336, "lag_21d": 504, "lag_28d": 672}


@query(
    "lag_features",
    "J08 M05",
    # One row an hour and user, so a frame of one instant holds that hour's row or none.
    f"WITH {_GRID}, l AS (SELECT user_id, hour, n, "
    + ", ".join(f"max(n) OVER (PARTITION BY user_id ORDER BY hour RANGE BETWEEN INTERVAL {h} HOUR PRECEDING AND INTERVAL {h} HOUR PRECEDING) AS {n}" for n, h in _LAGS.items())
    + " FROM g) SELECT *, round(list_avg([lag_14d, lag_21d, lag_28d]), 9) AS lag_mean FROM l",
)
def _(spark, sf):
    lagged = grid.lag_features(event_grid(spark, sf), "user_id", "hour", "n", _LAGS)
    return lagged.withColumn("lag_mean", F.round(grid.mean_ignoring_null(["lag_14d", "lag_21d", "lag_28d"]), 9))
