"""Fingerprints, change planning, reconciliation, releases and incremental cycles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import timefns
from tidemark.operators import compare, dedup, incremental, marts, releases
from tidemark.session import scratch
from tidemark.sources.digests import DigestIndex
from tidemark.sources.tables import MonthTable
from tidemark.workload.fixtures import CLEAN, FACT, clean_fact, fact, table
from tidemark.workload.registry import query

# Server side: orders per day. Stored side: the same orders as they stood before
# the pending ones (status P) arrived and before 2-HIGH orders were revised. A
# few thousand days; open orders after 2001-06 are not stored at all.
_STORED_SQL = """(SELECT o_orderkey, o_orderdate, CASE WHEN o_orderpriority = '2-HIGH' THEN floor(o_totalprice) ELSE o_totalprice END AS o_totalprice, o_custkey, o_orderstatus
  FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate < TIMESTAMP '2001-06-01')"""


def _fp_sql(src: str) -> str:
    return f"""SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS rows, CAST(sum(floor(o_totalprice)) AS DOUBLE) AS ridership, CAST(sum(floor(o_totalprice * 100)) AS DOUBLE) AS transfers,
    max(o_orderdate + to_days(CAST(o_custkey % 40 AS INT))) AS source_updated_at FROM {src} GROUP BY 1"""


FPS = f"server AS ({_fp_sql('orders')}), stored AS ({_fp_sql(_STORED_SQL)})"


def _fingerprint(df):
    updated = df.withColumn("_u", F.col("o_orderdate") + F.make_dt_interval(F.pmod("o_custkey", F.lit(40)).cast("int")))
    return incremental.day_fingerprint(
        updated,
        "o_orderdate",
        {"ridership": F.floor("o_totalprice").cast("double"), "transfers": F.floor(F.col("o_totalprice") * 100).cast("double")},
        "_u",
    )


def server(spark, sf):
    return _fingerprint(table(spark, sf, "orders"))


def stored(spark, sf):
    o = table(spark, sf, "orders")
    kept = o.where((F.col("o_orderstatus") != "P") & (F.col("o_orderdate") < F.lit("2001-06-01").cast("timestamp_ntz")))
    revised = F.when(F.col("o_orderpriority") == "2-HIGH", F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice"))
    return _fingerprint(kept.withColumn("o_totalprice", revised))


@query("day_fingerprint", "A02", f"WITH {FPS} SELECT * FROM server")
def _(spark, sf):
    return server(spark, sf)


_CHANGES = """ch AS (SELECT coalesce(c.day, s.day) AS day, CASE WHEN s.day IS NULL THEN 'new' WHEN c.day IS NULL THEN 'removed' ELSE 'changed' END AS change
  FROM server c FULL JOIN stored s ON c.day = s.day WHERE (c.rows, c.ridership, c.transfers, c.source_updated_at) IS DISTINCT FROM (s.rows, s.ridership, s.transfers, s.source_updated_at))"""


@query("changed_days", "I01 J04 P09", f"WITH {FPS}, {_CHANGES} SELECT * FROM ch")
def _(spark, sf):
    return incremental.changed_days(server(spark, sf), stored(spark, sf))


@query(
    "days_to_fetch",
    "I02 J10",
    f"""WITH {FPS}, {_CHANGES}, m AS (SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS month FROM ch)
    SELECT day, CAST(date_trunc('month', day) AS DATE) AS month, rows FROM server WHERE CAST(date_trunc('month', day) AS DATE) IN (SELECT month FROM m)""",
)
def _(spark, sf):
    s = server(spark, sf)
    return incremental.days_to_fetch(s, incremental.changed_days(s, stored(spark, sf)))


@query(
    "months_to_rebuild",
    "I03",
    f"""WITH {FPS}, ch AS (SELECT day FROM server EXCEPT SELECT day FROM stored UNION ALL (SELECT day FROM stored EXCEPT SELECT day FROM server))
    SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS month, CASE WHEN CAST(date_trunc('month', day) AS DATE) IN (SELECT CAST(date_trunc('month', day) AS DATE) FROM stored) THEN 'build' ELSE 'delete' END AS action FROM ch""",
)
def _(spark, sf):
    # The stored side is current here, so months only the other side has are vanished ones.
    now, before = stored(spark, sf), server(spark, sf)
    changes = incremental.changed_days(now, before).where("change <> 'changed'")
    return incremental.months_to_rebuild(changes, now)


@query(
    "day_status",
    "I04",
    f"""WITH {FPS} SELECT c.day, CASE WHEN s.day IS NULL THEN 'missing' WHEN (c.rows, c.ridership, c.transfers) IS DISTINCT FROM (s.rows, s.ridership, s.transfers) THEN 'rows or totals differ'
    WHEN s.source_updated_at < c.source_updated_at THEN 'revised on the server' ELSE 'up to date' END AS status FROM server c LEFT JOIN stored s ON c.day = s.day""",
)
def _(spark, sf):
    return incremental.day_status(server(spark, sf), stored(spark, sf))


@query(
    "day_status_counts",
    "I04",
    f"""WITH {FPS}, x AS (SELECT CASE WHEN s.day IS NULL THEN 'missing' WHEN (c.rows, c.ridership, c.transfers) IS DISTINCT FROM (s.rows, s.ridership, s.transfers) THEN 'rows or totals differ'
    WHEN s.source_updated_at < c.source_updated_at THEN 'revised on the server' ELSE 'up to date' END AS status FROM server c LEFT JOIN stored s ON c.day = s.day)
    SELECT status, count(*) AS days FROM x GROUP BY 1""",
)
def _(spark, sf):
    return incremental.day_status(server(spark, sf), stored(spark, sf)).groupBy("status").agg(F.count("*").alias("days"))


@query("newest_changed_days", "O05", f"WITH {FPS}, {_CHANGES} SELECT * FROM ch ORDER BY day DESC LIMIT 10")
def _(spark, sf):
    return incremental.newest_days(incremental.changed_days(server(spark, sf), stored(spark, sf)), 10)


@query(
    "rows_not_landed",
    "I11",
    f"""WITH {FPS} SELECT c.day, c.rows AS expected_rows, coalesce(s.rows, 0) AS fetched_rows FROM server c LEFT JOIN stored s ON c.day = s.day WHERE c.rows <> coalesce(s.rows, 0)""",
)
def _(spark, sf):
    landed = table(spark, sf, "orders").where((F.col("o_orderstatus") != "P") & (F.col("o_orderdate") < F.lit("2001-06-01").cast("timestamp_ntz")))
    return incremental.expected_rows(server(spark, sf), landed, "o_orderdate")


@query(
    "left_null_safe_diff",
    "J03 I07 P09",
    f"WITH {FPS} SELECT count(*) FILTER (c.ridership IS DISTINCT FROM s.ridership) AS differing FROM server c LEFT JOIN stored s ON c.day = s.day",
)
def _(spark, sf):
    return compare.differing_keys(server(spark, sf), stored(spark, sf), ["day"], "ridership")


@query(
    "full_outer_indicator",
    "J04 I08",
    """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS rows FROM orders GROUP BY 1), l AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS rows FROM lineitem GROUP BY 1)
    SELECT coalesce(o.day, l.day) AS day, CASE WHEN l.day IS NULL THEN 'left_only' WHEN o.day IS NULL THEN 'right_only' ELSE 'both' END AS origin,
    o.rows AS rows_left, l.rows AS rows_right, o.rows IS DISTINCT FROM l.rows AS rows_differs FROM o FULL JOIN l ON o.day = l.day""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("rows"))
    l = table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("rows"))
    return compare.outer_compare(o, l, ["day"], ["rows"])


@query(
    "tolerant_compare",
    "J05 T16",
    f"""WITH {FPS} SELECT coalesce(c.day, s.day) AS day, CASE WHEN s.day IS NULL THEN 'left_only' WHEN c.day IS NULL THEN 'right_only' ELSE 'both' END AS origin,
    c.day IS NULL OR s.day IS NULL OR abs(c.ridership - s.ridership) > 250000 OR c.rows <> s.rows AS different FROM server c FULL JOIN stored s ON c.day = s.day""",
)
def _(spark, sf):
    return compare.tolerant_compare(server(spark, sf), stored(spark, sf), ["day"], {"ridership": 250000.0, "rows": 0})


# The releases meet here.
_SEAM = "1998-06-01"


def _parts(spark, sf):
    l = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate")
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    return l.where(F.col("l_shipdate") < at(_SEAM)), l.where(F.col("l_shipdate") >= at(_SEAM))


_SIDES = f"""o AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '{_SEAM}'), n AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '{_SEAM}')"""


@query(
    "key_compatibility",
    "J19 U06",
    f"""WITH {_SIDES} SELECT (SELECT count(*) FROM o) AS old_keys, (SELECT count(*) FROM n) AS new_keys, (SELECT count(*) FROM (FROM o INTERSECT FROM n)) AS common,
    (SELECT count(*) FROM (FROM o EXCEPT FROM n)) AS only_old, (SELECT count(*) FROM (FROM n EXCEPT FROM o)) AS only_new""",
)
def _(spark, sf):
    return dedup.key_set_sizes(*_parts(spark, sf), "l_partkey")


@query(
    "key_sides",
    "U06 J19",
    f"""WITH {_SIDES} SELECT coalesce(o.l_partkey, n.l_partkey) AS l_partkey, CASE WHEN n.l_partkey IS NULL THEN 'only_old' WHEN o.l_partkey IS NULL THEN 'only_new' ELSE 'common' END AS side
    FROM o FULL JOIN n ON o.l_partkey = n.l_partkey""",
)
def _(spark, sf):
    return compare.set_members(*_parts(spark, sf), "l_partkey")


@query(
    "time_seam",
    "I12",
    f"""WITH o AS (SELECT max(l_shipdate) AS last_old, count(*) AS a FROM lineitem WHERE l_shipdate < TIMESTAMP '{_SEAM}'), n AS (SELECT min(l_shipdate) AS first_new, count(*) AS b FROM lineitem WHERE l_shipdate >= TIMESTAMP '{_SEAM}')
    SELECT last_old, first_new, (epoch(first_new) - epoch(last_old)) / 3600.0 AS gap_hours, a + b AS combined_rows FROM o, n""",
)
def _(spark, sf):
    return compare.time_seam(*_parts(spark, sf), "l_shipdate")


@query(
    "table_totals",
    "J20 A60 U01 I10",
    """SELECT 'orders' AS "table", count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders UNION ALL SELECT 'lineitem', count(*), round(sum(l_quantity), 2) FROM lineitem
    UNION ALL SELECT 'customer', count(*), round(sum(c_acctbal), 2) FROM customer UNION ALL SELECT 'events', count(*), round(sum(value), 2) FROM events""",
)
def _(spark, sf):
    measures = {"orders": "o_totalprice", "lineitem": "l_quantity", "customer": "c_acctbal", "events": "value"}
    totals = compare.table_totals({n: (table(spark, sf, n), m) for n, m in measures.items()})
    return totals.withColumn("total", F.round("total", 2))


@query(
    "period_totals",
    "I09 P04",
    f"""WITH {CLEAN}, d AS (SELECT CAST(transit_timestamp AS DATE) AS day, station_complex_id, sum(ridership) AS ridership FROM clean GROUP BY 1, 2),
    f AS (SELECT CAST(transit_timestamp AS DATE) AS day, fare_class_category, sum(ridership) AS ridership FROM clean GROUP BY 1, 2)
    SELECT a.n AS rows_source, CAST(a.r AS BIGINT) AS ridership_source, b.n AS rows_target, CAST(b.r AS BIGINT) AS ridership_target, a.n = b.n AND a.r = b.r AS "equal"
    FROM (SELECT count(*) AS n, sum(ridership) AS r FROM d WHERE day >= DATE '2024-03-04' AND day < DATE '2024-03-25') a, (SELECT count(*) AS n, sum(ridership) AS r FROM f WHERE day >= DATE '2024-03-04' AND day < DATE '2024-03-25') b""",
)
def _(spark, sf):
    import datetime as dt

    cleaned = clean_fact(spark, sf)
    return compare.period_totals(marts.daily_by_station(cleaned), marts.daily_by_class(cleaned), "day", dt.date(2024, 3, 4), dt.date(2024, 3, 25), ["ridership"])


@query(
    "month_manifest",
    "S24 W07 A30",
    """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(DISTINCT CAST(o_orderdate AS DATE)) AS days, count(*) AS rows, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts FROM orders GROUP BY 1)
    SELECT *, rows AS expected_rows, coalesce(lag(last_ts) OVER (ORDER BY month) >= first_ts, false) AS overlaps FROM m""",
)
def _(spark, sf):
    from tidemark.operators.series import overlaps

    orders = table(spark, sf, "orders")
    expected = orders.groupBy(timefns.month_start("o_orderdate").alias("month")).agg(F.count("*").alias("expected_rows"))
    return overlaps(incremental.month_manifest(orders, expected, "o_orderdate"), "month", "first_ts", "last_ts", F.year("month"))


@query(
    "after_watermark",
    "P05 P06",
    """WITH old AS (SELECT * FROM orders WHERE o_orderstatus = 'F'), w AS (SELECT max(o_orderdate) AS wm FROM old)
    SELECT o_orderkey, o_orderdate FROM orders, w WHERE o_orderdate > wm""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    watermark = orders.where("o_orderstatus = 'F'").agg(F.max("o_orderdate")).scalar()
    return incremental.after_watermark(orders, "o_orderdate", watermark).select("o_orderkey", "o_orderdate")


@query("advanced_watermark", "P06 T18", "SELECT max(o_orderdate) AS watermark FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    watermark = orders.where("o_orderstatus = 'F'").agg(F.max("o_orderdate")).scalar()
    return incremental.advance_watermark(incremental.after_watermark(orders, "o_orderdate", watermark), "o_orderdate", watermark)


# --- batch de-duplication over line items -------------------------------------

# A delivery holds the returned lines twice; the store already has the open accepted ones.
_BATCH = "batch AS (SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_returnflag = 'R')"
_OLD = "old AS (SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'O')"
_LINE = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"]


def _delivery(spark, sf):
    l = table(spark, sf, "lineitem")
    again = l.where("l_returnflag = 'R'").select(*_LINE)
    return l.select(*_LINE).unionByName(again), l.where("l_returnflag = 'A' AND l_linestatus = 'O'").select(*_LINE)


@query("batch_distinct", "U03", f"WITH {_BATCH} SELECT DISTINCT * FROM batch")
def _(spark, sf):
    return dedup.distinct_batch(_delivery(spark, sf)[0])


@query("except_all_new", "U04 P07", f"WITH {_BATCH}, {_OLD} SELECT DISTINCT * FROM batch EXCEPT ALL SELECT * FROM old")
def _(spark, sf):
    return dedup.not_stored(*_delivery(spark, sf), "l_shipdate")


@query("except_all_history", "U04 S25 T18", f"WITH {_BATCH}, {_OLD} SELECT DISTINCT * FROM batch EXCEPT ALL SELECT * FROM old")
def _(spark, sf):
    """A batch against all stored months by way of their digest index: only months with a hit are read."""
    batch, old = _delivery(spark, sf)
    root = scratch(spark, "history")
    stored = MonthTable(spark, f"{root}/rows", "l_shipdate")
    stored.replace_months(old)
    index = DigestIndex(spark, f"{root}/digests", "l_shipdate", _LINE)
    index.replace_months(old)
    return index.not_stored(batch, stored.read_months)


@query(
    "incremental_dedup_report",
    "U03 U04 T18 S25",
    f"""WITH {_BATCH}, {_OLD}, u AS (SELECT DISTINCT * FROM batch), f AS (SELECT * FROM u EXCEPT ALL SELECT * FROM old), c AS (SELECT (SELECT count(*) FROM batch) AS b, (SELECT count(*) FROM u) AS d, (SELECT count(*) FROM f) AS w)
    SELECT b AS rows_fetched, b - d AS dup_in_batch, d - w AS dup_already_stored, w AS rows_written FROM c""",
)
def _(spark, sf):
    return dedup.dedup_report(*_delivery(spark, sf), "l_shipdate")


@query(
    "symmetric_diff",
    "U05",
    f"""WITH {_BATCH}, {_OLD} SELECT (SELECT count(*) FROM (SELECT * FROM batch EXCEPT ALL SELECT * FROM old)) AS only_in_a, (SELECT count(*) FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM batch)) AS only_in_b""",
)
def _(spark, sf):
    return dedup.symmetric_difference(*_delivery(spark, sf))


@query(
    "key_uniqueness",
    "A19",
    """SELECT count(*) AS distinct_keys, count(*) FILTER (n > 1) AS duplicated_keys, CAST(sum(n - 1) AS BIGINT) AS excess_rows, max(n) AS max_per_key
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)""",
)
def _(spark, sf):
    return dedup.key_summary(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "full_row_duplicates",
    "A20",
    f"WITH {_BATCH} SELECT (SELECT count(*) FROM batch) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM batch)) AS distinct_rows, (SELECT count(*) FROM batch) - (SELECT count(*) FROM (SELECT DISTINCT * FROM batch)) AS repeated_rows",
)
def _(spark, sf):
    return dedup.full_row_summary(_delivery(spark, sf)[0])


@query(
    "duplicate_examples",
    "A21",
    """WITH t AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, 1, 2 LIMIT 10)
    SELECT l_orderkey, l_linenumber, n, l_quantity, count(*) AS times FROM lineitem JOIN t USING (l_orderkey, l_linenumber) GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    return dedup.duplicate_examples(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_quantity", 10)


@query(
    "duplicates_by_month",
    "A21 F10",
    f"""WITH {FACT} SELECT strftime(transit_timestamp, '%Y-%m') AS month, count(*) AS duplicated_keys FROM
    (SELECT transit_timestamp, station_complex_id FROM fact GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1""",
)
def _(spark, sf):
    return dedup.duplicates_by_month(fact(spark, sf), ["transit_timestamp", "station_complex_id"], "transit_timestamp")


@query(
    "hashed_duplicates",
    "A22 H01 J10",
    "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS excess_rows FROM lineitem",
)
def _(spark, sf):
    return dedup.hashed_excess_rows(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- releases: a week of events is one release; its rows describe earlier days --

_REL = """rel AS (SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) + INTERVAL 7 DAY AS created_at, ts - to_hours(CAST(floor(value) AS INT)) AS data_ts,
  CAST(date_trunc('week', ts) AS TIMESTAMP) + INTERVAL 7 DAY + to_days(CAST(CASE WHEN event_type = 'error' THEN 7 ELSE 0 END AS INT)) AS updated_at FROM events)"""


def _releases(spark, sf):
    e = table(spark, sf, "events")
    created = F.date_trunc("week", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 7 DAY")
    return e.select(
        created.alias("created_at"),
        (F.col("ts") - F.make_dt_interval(F.lit(0), F.floor("value").cast("int"))).alias("data_ts"),
        (created + F.make_dt_interval(F.when(F.col("event_type") == "error", 7).otherwise(0))).alias("updated_at"),
    )


@query("load_batches", "A54", f"WITH {_REL} SELECT created_at, count(*) AS rows, min(data_ts) AS first_ts, max(data_ts) AS last_ts FROM rel GROUP BY 1")
def _(spark, sf):
    return releases.load_batches(_releases(spark, sf), "created_at", "data_ts")


@query(
    "release_gaps",
    "W05 A54",
    f"""WITH {_REL}, b AS (SELECT created_at, count(*) AS rows FROM rel GROUP BY 1)
    SELECT created_at, rows, (epoch(created_at) - epoch(lag(created_at) OVER (ORDER BY created_at))) / 86400.0 AS gap_days, dayname(created_at) AS weekday FROM b""",
)
def _(spark, sf):
    return releases.release_gaps(releases.load_batches(_releases(spark, sf), "created_at", "data_ts"))


@query(
    "release_summary",
    "A54 F12",
    f"""WITH {_REL}, b AS (SELECT created_at, (epoch(created_at) - epoch(lag(created_at) OVER (ORDER BY created_at))) / 86400.0 AS g, row_number() OVER (ORDER BY created_at) AS i FROM rel GROUP BY created_at)
    SELECT count(*) AS releases, min(g) FILTER (i > 2) AS gap_days_min, max(g) FILTER (i > 2) AS gap_days_max, string_agg(DISTINCT dayname(created_at), ', ') AS weekdays FROM b WHERE i > 1""",
)
def _(spark, sf):
    return releases.release_summary(releases.load_batches(_releases(spark, sf), "created_at", "data_ts"))


_LATE_SQL = """late AS (SELECT created_at, CAST(min(d) AS DATE) AS oldest_day, newest AS newest_day, count(*) AS rows, count(*) FILTER (newest - d > 6) AS late_rows
  FROM (SELECT created_at, CAST(data_ts AS DATE) AS d, max(CAST(data_ts AS DATE)) OVER (PARTITION BY created_at) AS newest FROM rel) GROUP BY created_at, newest)"""


@query("late_arrivals", "A55", f"WITH {_REL}, {_LATE_SQL} SELECT *, round(100.0 * late_rows / rows, 6) AS pct_late FROM late")
def _(spark, sf):
    return releases.late_rows(_releases(spark, sf), "created_at", "data_ts").withColumn("pct_late", F.round("pct_late", 6))


@query(
    "late_summary",
    "A55",
    f"""WITH {_REL}, {_LATE_SQL} SELECT count(*) AS releases, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(late_rows) AS BIGINT) AS late_rows, round(100.0 * sum(late_rows) / sum(rows), 6) AS pct_late,
    count(*) FILTER (100.0 * late_rows / rows > 5) AS releases_over_threshold FROM late""",
)
def _(spark, sf):
    return releases.late_summary(releases.late_rows(_releases(spark, sf), "created_at", "data_ts")).withColumn("pct_late", F.round("pct_late", 6))


@query(
    "revisions",
    "A56",
    f"""WITH {_REL} SELECT updated_at, count(*) AS rows, CAST(min(data_ts) AS DATE) AS first_day, CAST(max(data_ts) AS DATE) AS last_day,
    CAST(CAST(max(data_ts) AS DATE) - CAST(min(data_ts) AS DATE) AS INT) AS span_days, round(100.0 * count(*) / (SELECT count(*) FROM rel), 6) AS pct_of_total FROM rel WHERE updated_at > created_at GROUP BY 1""",
)
def _(spark, sf):
    return releases.revisions(_releases(spark, sf), "created_at", "updated_at", "data_ts").withColumn("pct_of_total", F.round("pct_of_total", 6))


@query(
    "publication_lag",
    "A57",
    f"""WITH {_REL} SELECT created_at, max(data_ts) AS last_ts, round((epoch(created_at) - epoch((max(data_ts) + INTERVAL 1 HOUR) AT TIME ZONE 'America/New_York')) / 3600.0, 3) AS lag_hours FROM rel GROUP BY 1""",
)
def _(spark, sf):
    lag = releases.publication_lag(releases.load_batches(_releases(spark, sf), "created_at", "data_ts"))
    return lag.withColumn("lag_hours", F.round("lag_hours", 3))
