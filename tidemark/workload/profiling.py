"""Profiling queries over line items, orders and the fact made from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import model
from tidemark.functions import stats
from tidemark.operators import grid, profile, value_parts
from tidemark.session import scratch
from tidemark.sources.tables import MonthTable
from tidemark.workload.fixtures import DIRTY, FACT, clean_fact, dirty_fact, fact, table
from tidemark.workload.registry import query

_TEXT = ["transit_mode", "station_complex_id", "station_complex", "borough", "payment_method", "fare_class_category", "georeference"]


def _blanks(c):
    return f"count(*) FILTER (trim({c}) = '')" if c in _TEXT else "CAST(NULL AS BIGINT)"


@query(
    "null_counts",
    "A11 F01",
    f"WITH {DIRTY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, {_blanks(c)} AS blanks FROM fact"
        for c in model.SOURCE_COLUMNS
    ),
)
def _(spark, sf):
    return profile.null_counts(dirty_fact(spark, sf), model.SOURCE_COLUMNS)


@query(
    "cardinality",
    "A12",
    "SELECT 'l_returnflag' AS \"column\", count(DISTINCT l_returnflag) AS distinct_values FROM lineitem UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus) FROM lineitem "
    "UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem",
)
def _(spark, sf):
    return profile.cardinality(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_partkey", "l_suppkey"])


@query(
    "category_distribution",
    "A13 N03",
    "SELECT o_orderpriority, count(*) AS rows, round(sum(o_totalprice), 2) AS total, round(100.0 * count(*) / (SELECT count(*) FROM orders), 6) AS pct FROM orders GROUP BY 1",
)
def _(spark, sf):
    d = profile.distribution(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return d.select("o_orderpriority", "rows", F.round("total", 2).alias("total"), F.round("pct", 6).alias("pct"))


@query(
    "category_by_year",
    "A14",
    "WITH n AS (SELECT max(year(o_orderdate)) AS y FROM orders) SELECT o_orderpriority, "
    + ", ".join(
        f"count(*) FILTER (year(o_orderdate) = n.y - {k}) AS rows_{name}, round(sum(o_totalprice) FILTER (year(o_orderdate) = n.y - {k}), 2) AS total_{name}" for k, name in ((1, "previous"), (0, "latest"))
    )
    + ", max(o_orderdate) AS last_seen FROM orders, n GROUP BY 1",
)
def _(spark, sf):
    """The two newest years of the data."""
    orders = table(spark, sf, "orders")
    newest = orders.agg(F.year(F.max("o_orderdate"))).first()[0]
    d = profile.split_by_year(orders, "o_orderpriority", "o_orderdate", "o_totalprice", [newest - 1, newest])
    names = {f"{c}_{y}": f"{c}_{name}" for c in ("rows", "total") for y, name in ((newest - 1, "previous"), (newest, "latest"))}
    return d.select(*[(F.round(c, 2) if c.startswith("total") else F.col(c)).alias(names.get(c, c)) for c in d.columns])


def _summary_sql(t, c):
    return (
        f"SELECT '{c}' AS variable, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"count(*) FILTER ({c} = 0) AS zeros, count(*) FILTER ({c} < 0) AS negatives, count(*) FILTER ({c} <> floor({c})) AS non_integers, round(CAST(sum({c}) AS DOUBLE), 2) AS total, "
        f"round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.95), 4) AS p95, round(quantile_cont({c}, 0.99), 4) AS p99 FROM {t}"
    )


@query("numeric_summary", "A15 U02", " UNION ALL ".join(_summary_sql("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def _(spark, sf):
    s = profile.numeric_summary(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return s.select(*[F.round(c, 2 if c == "total" else 6 if c in ("mean", "std") else 4).alias(c) if c in ("mean", "std", "total", "p50", "p95", "p99") else c for c in s.columns])


# Lines shipped since 2000 are revised after their month was first counted.
_REVISED = "l AS (SELECT * REPLACE (CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM lineitem WHERE l_shipdate IS NOT NULL)"
_PARTED = ["l_returnflag", "l_suppkey", "l_quantity", "l_discount"]


def parts_after_revision(spark, sf):
    """Value counts by month, those of the revised months made again."""
    lines = table(spark, sf, "lineitem").where("l_shipdate IS NOT NULL")
    store = MonthTable(spark, scratch(spark, "parts"), "first_day")
    store.replace_months(value_parts.value_parts(lines, _PARTED, "l_shipdate"))
    revised = lines.where("l_shipdate >= TIMESTAMP_NTZ '2000-01-01'").withColumn("l_quantity", F.col("l_quantity") + 1)
    store.replace_months(value_parts.value_parts(revised, _PARTED, "l_shipdate"))
    return store.read()


@query("parts_cardinality", "A12", f"WITH {_REVISED} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM l" for c in _PARTED))
def _(spark, sf):
    return value_parts.cardinality(parts_after_revision(spark, sf))


@query("parts_numeric_summary", "A15", f"WITH {_REVISED} " + " UNION ALL ".join(_summary_sql("l", c) for c in ("l_quantity", "l_discount")))
def _(spark, sf):
    s = value_parts.numeric_summary(parts_after_revision(spark, sf), ["l_quantity", "l_discount"])
    return s.select(*[F.round(c, 2 if c == "total" else 6 if c in ("mean", "std") else 4).alias(c) if c in ("mean", "std", "total", "p50", "p95", "p99") else c for c in s.columns])


@query(
    "grouped_quantiles",
    "A15 A51",
    "SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY 1",
)
def _(spark, sf):
    q = stats.exact_quantiles(table(spark, sf, "events"), "value", [0.5, 0.9], ["event_type"])
    return q.select("event_type", F.round("q0", 6).alias("median"), F.round("q1", 6).alias("p90"))


@query("negative_value_counts", "A16", f"WITH {FACT} SELECT transfers, count(*) AS rows FROM fact WHERE transfers < 0 GROUP BY 1")
def _(spark, sf):
    return profile.value_counts(fact(spark, sf), "transfers", F.col("transfers") < 0)


_SH = "sh AS (SELECT transit_timestamp, station_complex_id, sum(ridership) AS riders FROM fact GROUP BY 1, 2)"


def station_hours(spark, sf):
    return fact(spark, sf).groupBy("transit_timestamp", "station_complex_id").agg(F.sum("ridership").alias("riders"))


@query("skewness_report", "A17 N02", f"WITH {FACT}, {_SH} SELECT round(skewness(riders), 8) AS skewness, round(skewness(ln(1 + riders)), 8) AS log_skewness FROM sh")
def _(spark, sf):
    s = profile.skew_report(station_hours(spark, sf), "riders")
    return s.select(F.round("skewness", 8).alias("skewness"), F.round("log_skewness", 8).alias("log_skewness"))


@query(
    "clipped_histogram",
    "A18",
    f"""WITH {FACT}, {_SH}, b AS (SELECT min(riders) AS lo, quantile_cont(riders, 0.99) AS hi FROM sh)
    SELECT CAST(least(floor((riders - lo) / ((hi - lo) / 60)), 59) AS INT) AS bin, count(*) AS rows FROM sh, b WHERE riders <= hi GROUP BY 1""",
)
def _(spark, sf):
    hours = station_hours(spark, sf)
    p99 = stats.exact_quantiles(hours, "riders", [0.99]).select("q0").scalar()
    return profile.fixed_histogram(hours, "riders", 60, p99, hours.agg(F.min("riders")).scalar())


@query(
    "log_histogram",
    "A18 N02",
    f"""WITH {FACT}, {_SH} SELECT CAST(CASE WHEN riders < 20 THEN floor(riders) ELSE 20 + floor(log2(riders / CAST(20 AS DOUBLE)) * 4) END AS INT) AS bin, count(*) AS rows,
    CAST(min(riders) AS DOUBLE) AS least, CAST(max(riders) AS DOUBLE) AS most FROM sh GROUP BY 1""",
)
def _(spark, sf):
    return profile.log_histogram(station_hours(spark, sf), "riders")


@query(
    "attribute_consistency",
    "A25",
    f"WITH {FACT}, g AS (SELECT station_complex_id, count(DISTINCT station_complex) AS a, count(DISTINCT borough) AS b, count(DISTINCT (latitude, longitude)) AS c, count(DISTINCT transit_mode) AS d FROM fact GROUP BY 1) "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS attribute, count(*) AS ids, count(*) FILTER ({c} > 1) AS inconsistent FROM g"
        for n, c in (("station_complex", "a"), ("borough", "b"), ("latitude+longitude", "c"), ("transit_mode", "d"))
    ),
)
def _(spark, sf):
    return profile.attribute_consistency(fact(spark, sf), "station_complex_id", [["station_complex"], ["borough"], ["latitude", "longitude"], ["transit_mode"]])


@query(
    "multi_mode_ids",
    "A26 J10",
    f"""WITH {FACT}, m AS (SELECT station_complex_id, string_agg(DISTINCT transit_mode, ', ' ORDER BY transit_mode) AS categories FROM fact GROUP BY 1 HAVING count(DISTINCT transit_mode) > 1)
    SELECT station_complex_id, transit_mode, count(*) AS rows, min(transit_timestamp) AS first_ts, max(transit_timestamp) AS last_ts, any_value(categories) AS categories
    FROM fact JOIN m USING (station_complex_id) GROUP BY 1, 2""",
)
def _(spark, sf):
    return profile.multi_valued(fact(spark, sf), "station_complex_id", "transit_mode", "transit_timestamp")


@query(
    "shared_names",
    "A27",
    f"""WITH {FACT}, t AS (SELECT station_complex, count(DISTINCT station_complex_id) AS ids FROM fact GROUP BY 1 HAVING count(DISTINCT station_complex_id) > 1 ORDER BY 2 DESC, 1 LIMIT 20)
    SELECT DISTINCT station_complex, station_complex_id, ids FROM fact JOIN t USING (station_complex)""",
)
def _(spark, sf):
    return profile.shared_values(fact(spark, sf), ["station_complex"], "station_complex_id")


@query(
    "shared_coordinates",
    "A27",
    f"""WITH {FACT}, t AS (SELECT latitude, borough, count(DISTINCT station_complex_id) AS ids FROM fact GROUP BY 1, 2 HAVING count(DISTINCT station_complex_id) > 1 ORDER BY 3 DESC, 1, 2 LIMIT 20)
    SELECT DISTINCT latitude, borough, station_complex_id, ids FROM fact JOIN t USING (latitude, borough)""",
)
def _(spark, sf):
    return profile.shared_values(fact(spark, sf), ["latitude", "borough"], "station_complex_id")


@query(
    "partial_range_ids",
    "A28 J18",
    """WITH g AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders) SELECT o_custkey, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts, count(*) AS rows FROM orders, g
    GROUP BY o_custkey, a, b HAVING min(o_orderdate) > a + INTERVAL 365 DAY OR max(o_orderdate) < b - INTERVAL 365 DAY""",
)
def _(spark, sf):
    return profile.partial_range(table(spark, sf, "orders"), "o_custkey", "o_orderdate", days=365)


@query(
    "time_coverage",
    "A29",
    "SELECT min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT date_trunc('hour', ts)) AS hours, count(DISTINCT CAST(ts AS DATE)) AS days FROM events",
)
def _(spark, sf):
    return profile.time_coverage(table(spark, sf, "events"), "ts")


@query(
    "month_profile",
    "A30 D06 F10",
    f"""WITH {FACT} SELECT strftime(transit_timestamp, '%Y-%m') AS month, count(*) AS rows, count(*) FILTER (payment_method = 'omny') AS rows_omny, count(*) FILTER (payment_method = 'metrocard') AS rows_metrocard,
    CAST(sum(ridership) AS DOUBLE) AS total, count(DISTINCT transit_timestamp) AS hours, count(DISTINCT station_complex_id) AS ids, CAST(24 * day(last_day(CAST(min(transit_timestamp) AS DATE))) AS INT) AS calendar_hours FROM fact GROUP BY 1""",
)
def _(spark, sf):
    return profile.month_profile(fact(spark, sf), "transit_timestamp", "station_complex_id", "payment_method", model.METHODS, "ridership")


@query(
    "sparse_days",
    "A31",
    """WITH d AS (SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS ids, count(*) AS rows FROM events GROUP BY 1) SELECT * FROM d WHERE ids < 0.99 * (SELECT median(ids) FROM d)""",
)
def _(spark, sf):
    return profile.sparse_days(table(spark, sf, "events"), "ts", "user_id", share=0.99)


@query(
    "grid_density",
    "A32",
    f"""WITH {FACT}, p AS (SELECT count(DISTINCT transit_timestamp) * count(DISTINCT station_complex_id) * count(DISTINCT fare_class_category) AS possible, count(*) AS rows FROM fact)
    SELECT rows, possible, round(100.0 * rows / possible, 6) AS pct_filled FROM p""",
)
def _(spark, sf):
    d = profile.grid_density(fact(spark, sf), ["transit_timestamp", "station_complex_id", "fare_class_category"])
    return d.withColumn("pct_filled", F.round("pct_filled", 6))


@query("coordinate_range", "R14", f"WITH {DIRTY} SELECT min(latitude) AS lat_min, max(latitude) AS lat_max, min(longitude) AS lon_min, max(longitude) AS lon_max, count(*) FILTER (NOT (latitude >= 40.49 AND latitude <= 40.92 AND longitude >= -74.26 AND longitude <= -73.68)) AS outside FROM fact")
def _(spark, sf):
    return profile.box_report(dirty_fact(spark, sf), "latitude", "longitude", model.PROFILE_BOX)


@query("missing_hours", "J09 D05", "SELECT h.hour FROM (SELECT unnest(generate_series(date_trunc('hour', min(o_orderdate)), date_trunc('hour', max(o_orderdate)), INTERVAL 1 HOUR)) AS hour FROM orders) h ANTI JOIN (SELECT DISTINCT date_trunc('hour', o_orderdate) AS hour FROM orders) o USING (hour)")
def _(spark, sf):
    return grid.missing_hours(table(spark, sf, "orders"), "o_orderdate")


@query("missing_days", "J09 D05", "SELECT d.day FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM orders) d ANTI JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) o USING (day)")
def _(spark, sf):
    return grid.missing_days(table(spark, sf, "orders"), "o_orderdate")


@query(
    "fixed_sample",
    "S28 S29",
    "SELECT * FROM orders ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), '42')), o_orderkey, o_custkey LIMIT 1000",
)
def _(spark, sf):
    return profile.fixed_sample(table(spark, sf, "orders"), ["o_orderkey", "o_custkey"], 1000)


@query("preview_rows", "S27", "SELECT * FROM events ORDER BY event_id LIMIT 10")
def _(spark, sf):
    return profile.preview(table(spark, sf, "events"), 10, "event_id")


@query("schema_listing", "S26", "SELECT CAST(row_number() OVER () AS INT) AS position, column_name AS \"column\", CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DOUBLE' THEN 'double' END AS type FROM (DESCRIBE events)")
def _(spark, sf):
    return profile.schema_listing(table(spark, sf, "events"))
