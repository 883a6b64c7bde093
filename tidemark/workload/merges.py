"""Sources, sinks and merges over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark import model
from tidemark.operators import marts, upsert
from tidemark.session import scratch
from tidemark.sources import files
from tidemark.sources.tables import BucketTable, MonthTable, Table
from tidemark.workload.fixtures import CLEAN, FACT, clean_fact, fact, table
from tidemark.workload.registry import query

_DAYS = "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS rows, CAST(sum(floor(o_totalprice)) AS DOUBLE) AS total FROM orders"


def order_days(spark, sf):
    return table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("rows"), F.sum(F.floor("o_totalprice")).cast("double").alias("total")
    )


_REVISED = "day >= DATE '2000-01-01'"


@query(
    "month_replace",
    "S14 S11 I05",
    f"WITH d AS ({_DAYS} GROUP BY 1) SELECT day, rows, CASE WHEN {_REVISED} THEN total + 1 ELSE total END AS total FROM d",
)
def _(spark, sf):
    """Months since 2000 are written again with revised totals; the others stay."""
    days = order_days(spark, sf)
    store = MonthTable(spark, scratch(spark, "months"), "day")
    store.replace_months(days)
    store.replace_months(days.where(_REVISED).withColumn("total", F.col("total") + 1))
    return store.read()


@query("month_replace_plan", "S14", f"WITH d AS ({_DAYS} GROUP BY 1) SELECT day, rows, CASE WHEN {_REVISED} THEN total + 1 ELSE total END AS total FROM d")
def _(spark, sf):
    days = order_days(spark, sf)
    return upsert.replace_months(days, days.where(_REVISED).withColumn("total", F.col("total") + 1), "day")


@query("vanished_month", "I03 S20", f"WITH d AS ({_DAYS} GROUP BY 1) SELECT * FROM d WHERE NOT (day >= DATE '1999-05-01' AND day < DATE '1999-06-01')")
def _(spark, sf):
    store = MonthTable(spark, scratch(spark, "months"), "day")
    store.replace_months(order_days(spark, sf))
    store.delete_month(dt.date(1999, 5, 1))
    return store.read()


@query(
    "clean_month_files",
    "S11 S04 O01 S05",
    f"WITH {CLEAN} SELECT transit_timestamp, station_complex_id, payment_method, fare_class_category, ridership, transfers FROM clean",
)
def _(spark, sf):
    """The clean layer written sorted under year and month and read without the folders."""
    path = scratch(spark, "clean")
    files.write_months(clean_fact(spark, sf), path)
    return files.read_parquet(spark, path, folders_as_columns=False).select(*model.ROW_KEY, "ridership", "transfers")


@query(
    "raw_day_files",
    "S12 S04 U01",
    f"WITH {FACT} SELECT CAST(transit_timestamp AS DATE) AS day, count(*) AS rows, max(source_updated_at) AS source_updated_at, min(TIMESTAMP '2024-04-15 00:00:00') AS fetched_at FROM fact GROUP BY 1",
)
def _(spark, sf):
    path = scratch(spark, "raw")
    stamped = files.with_bookkeeping(fact(spark, sf), F.col("source_updated_at"), F.lit("2024-04-15").cast("timestamp_ntz"))
    files.write_days(stamped, path)
    back = files.read_parquet(spark, path)
    return back.groupBy("day").agg(F.count("*").alias("rows"), F.max("source_updated_at").alias("source_updated_at"), F.min("fetched_at").alias("fetched_at"))


_FACT_COLS = "transit_timestamp, station_complex_id, payment_method, fare_class_category, ridership, transfers, latitude, longitude, georeference"


@query("csv_round_trip", "S01 S02 S13", f"WITH {FACT} SELECT {_FACT_COLS} FROM fact")
def _(spark, sf):
    """Headered CSV in key order, read back with the fixed schema and a header check."""
    path = scratch(spark, "csv")
    files.export_csv(fact(spark, sf).select(*model.SOURCE_COLUMNS), path, model.ROW_KEY)
    files.read_csv_strict(spark, path)
    return files.read_csv(spark, path, columns=[c.strip() for c in _FACT_COLS.split(",")])


@query("json_records", "S03 F02", f"WITH {FACT} SELECT {_FACT_COLS} FROM fact")
def _(spark, sf):
    """Records with numbers as text and the point as an object, typed again."""
    path = scratch(spark, "json")
    f = fact(spark, sf)
    point = F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"))
    text = {c: F.col(c).cast("string") for c in ("ridership", "transfers", "latitude", "longitude")}
    stamp = F.date_format("transit_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    records = f.select(*[{**text, "transit_timestamp": stamp, "georeference": point}.get(c, F.col(c)).alias(c) for c in model.SOURCE_COLUMNS])
    records.write.json(path)
    return files.read_records(spark, path).select(*[c.strip() for c in _FACT_COLS.split(",")])


_BROKEN = "CAST(station_complex_id AS INT) % 50 = 7"


@query("variant_records", "S03 F02", f"WITH {FACT} SELECT " + ", ".join(f"CASE WHEN NOT ({_BROKEN}) THEN {c} END AS {c}" for c in _FACT_COLS.split(", ")) + f", {_BROKEN} AS bad FROM fact")
def _(spark, sf):
    """Records without a fixed schema: the point is an object or text, numbers are numbers or text, some lines are cut short."""
    path = scratch(spark, "variants")
    f = fact(spark, sf)
    stamp = F.date_format("transit_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("transit_timestamp")
    rest = [stamp if c == "transit_timestamp" else F.col(c) for c in model.SOURCE_COLUMNS if c not in ("georeference", "ridership")]
    point = F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"))
    as_object = F.to_json(F.struct(*rest, F.col("ridership").cast("string").alias("ridership"), point.alias("georeference")))
    as_text = F.to_json(F.struct(*rest, "ridership", "georeference"))
    line = F.when(F.col("station_complex_id").cast("int") % 2 == 0, as_object).otherwise(as_text)
    f.select(F.when(F.expr(_BROKEN), F.substring(line, 1, 40)).otherwise(line).alias("value")).write.text(path)
    return files.typed_variants(files.read_variant_records(spark, path)).select(*[c.strip() for c in _FACT_COLS.split(",")], "bad")


@query("variant_props", "S03", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, NOT json_valid(props) AS bad FROM events")
def _(spark, sf):
    record = F.try_parse_json("props")
    return table(spark, sf, "events").select("event_id", F.try_variant_get(record, "$.k", "int").alias("k"), record.isNull().alias("bad"))


@query("json_props_typed", "S03", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query(
    "landed_batches",
    "S10 T18",
    "SELECT CASE WHEN l_returnflag = 'R' THEN DATE '2024-05-02' ELSE DATE '2024-05-01' END AS ingest_date, count(*) AS rows, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    path = scratch(spark, "landing")
    l = table(spark, sf, "lineitem")
    files.land_new_rows(l.where("l_returnflag <> 'R'"), path, "2024-05-01")
    files.land_new_rows(l.where("l_returnflag = 'R'"), path, "2024-05-02")
    return spark.read.parquet(path).groupBy("ingest_date").agg(F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"))


# --- merges: totals per customer, finished orders stored, open ones incoming -------

_TOT = "SELECT o_custkey, count(*) AS orders, CAST(sum(floor(o_totalprice)) AS DOUBLE) AS total, max(o_orderdate) AS last_order FROM orders WHERE o_orderstatus {} GROUP BY 1"
_STORED, _INCOMING = "<> 'P'", "= 'P'"
_PAIR = f"s AS ({_TOT.format(_STORED)}), i AS ({_TOT.format(_INCOMING)})"


def _totals(spark, sf, status):
    o = table(spark, sf, "orders").where(f"o_orderstatus {status}")
    return o.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.sum(F.floor("o_totalprice")).cast("double").alias("total"), F.max("o_orderdate").alias("last_order"))


_TABLE = "o_custkey bigint, orders bigint, total double, last_order timestamp_ntz"


@query("keyed_upsert", "S16", f"WITH {_PAIR} SELECT * FROM i UNION ALL SELECT * FROM s WHERE o_custkey NOT IN (SELECT o_custkey FROM i)")
def _(spark, sf):
    """Through the bucketed table: only buckets with incoming keys are written again."""
    t = BucketTable(spark, scratch(spark, "totals"), _TABLE, ["o_custkey"], buckets=16)
    t.replace(_totals(spark, sf, _STORED))
    t.upsert(_totals(spark, sf, _INCOMING))
    return t.read()


@query(
    "additive_upsert",
    "S18",
    f"WITH {_PAIR} SELECT o_custkey, CAST(sum(orders) AS BIGINT) AS orders, sum(total) AS total, max(last_order) AS last_order FROM (SELECT * FROM s UNION ALL SELECT * FROM i) GROUP BY 1",
)
def _(spark, sf):
    t = BucketTable(spark, scratch(spark, "totals"), _TABLE, ["o_custkey"], buckets=16)
    t.replace(_totals(spark, sf, _STORED))
    t.add(_totals(spark, sf, _INCOMING), ["orders", "total"], ["last_order"])
    return t.read()


@query("full_replace", "S15", f"WITH {_PAIR} SELECT * FROM i")
def _(spark, sf):
    t = Table(spark, scratch(spark, "totals"), _TABLE)
    t.replace(_totals(spark, sf, _STORED))
    t.replace(_totals(spark, sf, _INCOMING))
    return t.read()


@query(
    "document_upsert",
    "S17",
    """WITH s AS (SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders WHERE o_orderstatus <> 'O') WHERE r = 1),
    i AS (SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders WHERE o_orderstatus = 'O') WHERE r = 1)
    SELECT * FROM i UNION ALL SELECT * FROM s WHERE o_custkey NOT IN (SELECT o_custkey FROM i)""",
)
def _(spark, sf):
    from tidemark.operators.dedup import last_per_key

    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    documents = BucketTable(spark, scratch(spark, "documents"), "o_custkey bigint, o_orderkey bigint, o_totalprice double", ["o_custkey"], buckets=16)
    for batch in ("o_orderstatus <> 'O'", "o_orderstatus = 'O'"):
        documents.upsert(last_per_key(o.where(batch).drop("o_orderstatus"), ["o_custkey"], ["o_orderkey"]))
    return documents.read()


@query("insert_if_absent", "S19 J09", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _(spark, sf):
    done = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return upsert.insert_if_absent(done, table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("delete_missing", "S20 J10", "SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')")
def _(spark, sf):
    source = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return upsert.delete_missing(table(spark, sf, "part").select("p_partkey", "p_brand"), source, ["p_partkey"])


@query("retained_days", "S21 D04", "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 14 DAY")
def _(spark, sf):
    return upsert.retain_days(table(spark, sf, "events").select("event_id", "ts"), "ts", 14)


@query(
    "newest_per_group",
    "S22 W02",
    "SELECT event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS r FROM events) WHERE r <= 5",
)
def _(spark, sf):
    return upsert.newest_per_group(table(spark, sf, "events").select("event_type", "event_id", "ts"), "event_type", "ts", 5)


@query(
    "run_log_latest",
    "S23 F09 O04",
    """SELECT o_custkey AS run_id, o_orderdate AS logged_at, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'running' ELSE 'failed' END AS status, "left"(o_orderpriority, 6) AS message
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'running' ELSE 'failed' END DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""",
)
def _(spark, sf):
    """Start and finish rows of each run id; its newest row is its state."""
    from tidemark.functions.textfns import shorten
    from tidemark.operators.dedup import last_per_key

    log = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("run_id"),
        F.col("o_orderdate").alias("logged_at"),
        F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "P", "running").otherwise("failed").alias("status"),
        shorten("o_orderpriority", 6).alias("message"),
        "o_orderkey",
    )
    return last_per_key(log, ["run_id"], ["logged_at", "status", "o_orderkey"]).drop("o_orderkey")


@query("last_runs", "O04 A60 V06", "SELECT o_orderkey AS run_id, o_orderdate AS started_at, o_orderstatus AS status FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5")
def _(spark, sf):
    from tidemark.plans.dashboard import last_runs

    runs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("started_at"), F.col("o_orderstatus").alias("status"))
    return last_runs(runs)


@query("cycle_log", "S25", f"WITH {CLEAN} SELECT CAST(count(*) AS BIGINT) AS rows, max(transit_timestamp) AS watermark FROM clean")
def _(spark, sf):
    """One JSON line per cycle, from a one-row aggregate."""
    path = scratch(spark, "log")
    c = clean_fact(spark, sf)
    c.agg(F.count("*").alias("rows"), F.max("transit_timestamp").alias("watermark")).write.mode("append").json(path)
    return spark.read.schema("rows bigint, watermark timestamp_ntz").json(path)


@query(
    "sorted_mart_export",
    "S13 O02",
    f"WITH {CLEAN} SELECT CAST(transit_timestamp AS DATE) AS day, station_complex_id, CAST(sum(ridership) AS BIGINT) AS ridership FROM clean GROUP BY 1, 2",
)
def _(spark, sf):
    path = scratch(spark, "export")
    daily = marts.daily_by_station(clean_fact(spark, sf)).select("day", "station_complex_id", "ridership")
    files.export_csv(daily, path, ["day", "station_complex_id"])
    return spark.read.schema("day date, station_complex_id string, ridership bigint").option("header", True).csv(path)
