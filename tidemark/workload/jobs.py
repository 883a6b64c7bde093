"""The end-to-end jobs over the fact made from events, each in a fresh folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark import model
from tidemark.operators import marts
from tidemark.plans import batch, poll
from tidemark.session import scratch
from tidemark.sources.tables import MonthTable
from tidemark.workload.fixtures import CLEAN, FACT, fact, table
from tidemark.workload.marts import _DAILY, _PROFILE, _STATION
from tidemark.workload.registry import query


def loaded(spark, sf) -> batch.Lake:
    lake = batch.Lake(spark, scratch(spark, "lake"))
    batch.run_batch(lake, fact(spark, sf))
    return lake


@query("batch_job_daily_station", "I05 I06 I14 S12 S14 R23", f"WITH {CLEAN}, {_DAILY} SELECT * FROM d")
def _(spark, sf):
    return loaded(spark, sf).daily_station.read().select("day", "station_complex_id", "ridership", "transfers", "omny_ridership")


@query("batch_job_stations", "I06 A06 A10", f"WITH {CLEAN}, {_STATION} SELECT * FROM s")
def _(spark, sf):
    return loaded(spark, sf).stations.read()


@query("batch_job_profile", "I06 A09 S15", f"WITH {CLEAN}, {_PROFILE} SELECT station_complex_id, day_type, hour_of_day, round(mean_ridership, 6) AS mean_ridership FROM p")
def _(spark, sf):
    return loaded(spark, sf).profile.read().withColumn("mean_ridership", F.round("mean_ridership", 6))


@query(
    "batch_job_verify",
    "I07 I14",
    "SELECT unnest(['days whose hourly ridership differs', 'days whose station ridership differs', 'months whose clean row count differs']) AS \"check\", CAST(0 AS BIGINT) AS failing",
)
def _(spark, sf):
    return batch.verify(loaded(spark, sf))


_SPLIT = "2024-03-15"


@query(
    "batch_job_revision_log",
    "I01 I02 I03 I14 S23",
    f"""WITH {FACT}, d AS (SELECT CAST(transit_timestamp AS DATE) AS day, count(*) AS n FROM fact GROUP BY 1)
    SELECT 'first' AS run, 'success' AS status, count(*) FILTER (day < DATE '{_SPLIT}') AS days_fetched, CAST(sum(n) FILTER (day < DATE '{_SPLIT}') AS BIGINT) AS rows_fetched FROM d
    UNION ALL SELECT 'grown', 'success', count(*) FILTER (day >= DATE '{_SPLIT}'), CAST(sum(n) FILTER (day >= DATE '{_SPLIT}') AS BIGINT) FROM d
    UNION ALL SELECT 'unchanged', 'success', 0, 0 UNION ALL SELECT 'revised', 'success', count(*) FILTER (isodow(day) >= 6), CAST(sum(n) FILTER (isodow(day) >= 6) AS BIGINT) FROM d""",
)
def _(spark, sf):
    """Four runs: half of the days, all days, the same again, revised weekends."""
    source = fact(spark, sf)
    lake = batch.Lake(spark, scratch(spark, "lake"))
    revised = source.withColumn("ridership", F.col("ridership") + F.when(F.weekday(marts.TS) >= 5, 1.0).otherwise(0.0))
    steps = {"first": source.where(F.col(marts.TS) < F.lit(_SPLIT).cast("timestamp_ntz")), "grown": source, "unchanged": source, "revised": revised}
    ids = {name: batch.run_batch(lake, df).id for name, df in steps.items()}
    label = F.create_map(*[F.lit(x) for name, i in ids.items() for x in (i, name)])
    return lake.runs.read().select(F.element_at(label, F.col("run_id")).alias("run"), "status", "days_fetched", "rows_fetched")


_GRAIN = f"""grain AS (SELECT transit_timestamp, station_complex_id, payment_method, fare_class_category, max(transit_mode) AS transit_mode, max(station_complex) AS station_complex, max(borough) AS borough,
  CAST(sum(ridership) AS DOUBLE) AS ridership, CAST(sum(transfers) AS DOUBLE) AS transfers, max(latitude) AS latitude, max(longitude) AS longitude, max(georeference) AS georeference, max(source_updated_at) AS source_updated_at FROM raw GROUP BY 1, 2, 3, 4)"""


def one_row_per_key(spark, sf):
    rest = [c for c in model.SOURCE_COLUMNS if c not in model.ROW_KEY]
    agg = [F.sum(c).alias(c) if c in ("ridership", "transfers") else F.max(c).alias(c) for c in rest]
    return fact(spark, sf).groupBy(*model.ROW_KEY).agg(*agg, F.max("source_updated_at").alias("source_updated_at"))


@query(
    "etl_job_hourly",
    "I09 I10 I14 R30 A03",
    f"WITH {CLEAN.replace('fact AS (', 'raw AS (', 1).replace('station_mode AS (', _GRAIN + ', fact AS (SELECT * FROM grain), station_mode AS (', 1)} "
    "SELECT transit_timestamp AS hour, payment_method, CAST(sum(ridership) AS BIGINT) AS ridership, CAST(sum(transfers) AS BIGINT) AS transfers, bool_or(is_dst_transition) AS is_dst_transition FROM clean GROUP BY 1, 2",
)
def _(spark, sf):
    """The month-wise job with its ten checks, on one row per key."""
    lake = batch.Lake(spark, scratch(spark, "etl"))
    batch.run_etl(lake, one_row_per_key(spark, sf))
    return lake.hourly.read().select("hour", "payment_method", "ridership", "transfers", "is_dst_transition")


@query("poll_job_rows", "T18 P06 S10 U03 U04", f"WITH {FACT} SELECT DISTINCT * FROM fact")
def _(spark, sf):
    """Three cycles over a growing source; repeats inside a batch are stored once."""
    source = fact(spark, sf)
    store = poll.Store(spark, scratch(spark, "poll"))
    half = source.where(F.col(marts.TS) < F.lit(_SPLIT).cast("timestamp_ntz"))
    for step in (half.unionByName(half), source, source):
        poll.cycle(step, store, marts.TS, dt.datetime(2024, 1, 1))
    return store.rows(source)


@query(
    "snapshot_job_manifest",
    "S11 S24 I11",
    "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(DISTINCT CAST(o_orderdate AS DATE)) AS days, count(*) AS rows, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts, count(*) AS expected_rows, true AS complete FROM orders GROUP BY 1",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    expected = poll.expected_by_month(orders, "o_orderdate")
    return poll.merge_months(orders, scratch(spark, "snapshot"), "o_orderdate", expected, keys=["o_orderdate", "o_orderkey"])


# A source that leaves rows out of its first answer, fewer out of its second, and none after that.
_LEFT_OUT = ["o_orderkey % 400 = 3", "o_orderkey % 2000 = 3"]


@query(
    "refetched_months",
    "I11",
    f"""WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n, count(*) FILTER (NOT ({_LEFT_OUT[0]})) AS a, count(*) FILTER (NOT ({_LEFT_OUT[1]})) AS b FROM orders GROUP BY 1)
    SELECT CAST(1 AS INT) AS attempt, month, n AS expected_rows, a AS fetched_rows FROM m UNION ALL SELECT 2, month, n, b FROM m WHERE a <> n UNION ALL SELECT 3, month, n, n FROM m WHERE a <> n AND b <> n""",
)
def _(spark, sf):
    """Every attempt at every month: those that came short are read again, at most three times in all."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")

    def read(months, attempt):
        rows = orders.where(F.trunc("o_orderdate", "MM").isin(months))
        return rows.where(f"NOT ({_LEFT_OUT[attempt - 1]})") if attempt <= len(_LEFT_OUT) else rows

    store = MonthTable(spark, scratch(spark, "pieces"), "o_orderdate")
    return poll.fetch_pieces(read, poll.expected_by_month(orders, "o_orderdate"), store)
