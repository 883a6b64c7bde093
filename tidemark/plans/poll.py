"""Incremental cycles and the month-wise snapshot of a growing source."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import model
from tidemark.functions import timefns
from tidemark.operators import dedup, incremental
from tidemark.session import scratch, scratch_scope
from tidemark.sources import files
from tidemark.sources.tables import MonthTable, Table, children, written_once

WATERMARK = "watermark timestamp_ntz, updated_at timestamp, last_cycle string"


class Store:
    """Landed rows, the watermark and the cycle log of one poller."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.state = Table(spark, f"{path}/watermark", WATERMARK)

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    def rows(self, like: DataFrame) -> DataFrame:
        if not any(n.startswith("ingest_date=") for n in children(self.spark, self.rows_path)):
            return like.limit(0)
        return self.spark.read.parquet(self.rows_path).drop("ingest_date").select(*like.columns)


def cycle(source: DataFrame, store: Store, ts: str, init: dt.datetime, today: dt.date | None = None) -> dict:
    """Fetch rows after the watermark, land the unseen ones, advance the watermark.

    The watermark advances to the newest fetched time even when every row was a
    duplicate: all of them are stored by then. Rows that arrive late, below the
    watermark, are not seen; the fingerprint plan finds those.
    """
    with scratch_scope(source.sparkSession):
        return _cycle(source, store, ts, init, today)


def _cycle(source: DataFrame, store: Store, ts: str, init: dt.datetime, today: dt.date | None) -> dict:
    spark = source.sparkSession
    kept = store.state.read().first()
    before = kept.watermark if kept else init
    info = {"watermark_before": str(before), "rows_fetched": 0, "rows_written": 0, "watermark_after": str(before)}
    batch = incremental.after_watermark(source, ts, F.lit(before).cast("timestamp_ntz"))
    probe = batch.agg(F.count("*").alias("n"), F.max(ts).alias("newest")).first()
    after = before
    if probe.n:
        landed = store.rows(batch)
        # The new rows are read from `landed` and appended to the same folder, so they are fixed first.
        path = scratch(spark, "cycle")
        dedup.not_stored(batch, landed, ts).write.parquet(path)
        fresh = spark.read.schema(batch.schema).parquet(path)
        report = dedup.dedup_report(batch, landed, ts).first().asDict()
        info.update(report)
        if report["rows_written"]:
            files.land_new_rows(fresh, store.rows_path, str(today or dt.date.today()))
        after = probe.newest
        info["watermark_after"] = str(after)
    now = dt.datetime.now(dt.timezone.utc)
    store.state.replace(spark.createDataFrame([(after, now, json.dumps(info))], WATERMARK))
    files.append_log(spark, f"{store.path}/log", {"at": now, "info": json.dumps(info)}, "at timestamp, info string")
    return info


def merge_months(source: DataFrame, path: str, ts: str, expected: DataFrame, keys: Sequence[str] = model.ROW_KEY) -> DataFrame:
    """Write the months of a snapshot and return their manifest with a completeness flag.

    ``expected`` holds (month, expected_rows) as the source announced them.
    """
    files.write_months(source, path, ts, keys)
    back = source.sparkSession.read.parquet(path).drop("year", "month")
    manifest = incremental.month_manifest(back, expected, ts)
    return manifest.withColumn("complete", F.col("rows").eqNullSafe(F.col("expected_rows")))


def expected_by_month(source: DataFrame, ts: str) -> DataFrame:
    return source.groupBy(timefns.month_start(ts).alias("month")).agg(F.count("*").alias("expected_rows"))


FETCH_LOG = "attempt int, month date, expected_rows bigint, fetched_rows bigint"


def fetch_pieces(read: Callable[[list[dt.date], int], DataFrame], expected: DataFrame, store: MonthTable, attempts: int = 3) -> DataFrame:
    """Land all announced months and read those again that came short, at most ``attempts`` times in all.

    ``read(months, attempt)`` gives the rows of some months, ``expected`` holds (month, expected_rows). A month counts what is in
    its files, not what was sent. Returns one row for each month and attempt; see :func:`short_pieces`.
    """
    spark = expected.sparkSession
    due = written_once(expected.select("month", "expected_rows"), "due")
    log = spark.createDataFrame([], FETCH_LOG)
    for attempt in range(1, attempts + 1):
        # A list of months, which the calendar bounds.
        months = sorted(r.month for r in due.select("month").toLocalIterator())
        if not months:
            break
        store.replace_months(read(months, attempt))
        stored = due.select("month").limit(0) if store.read() is None else store.read_months(months).select(timefns.month_start(store.day).alias("month"))
        landed = stored.groupBy("month").agg(F.count("*").alias("_n"))
        seen = due.join(landed, "month", "left").select(F.lit(attempt).alias("attempt"), "month", "expected_rows", F.coalesce("_n", F.lit(0)).alias("fetched_rows"))
        seen = written_once(seen, "attempt")
        log = log.unionByName(seen)
        due = seen.where("expected_rows <> fetched_rows").select("month", "expected_rows")
    return log


def short_pieces(log: DataFrame) -> DataFrame:
    """Months whose last attempt did not bring what was announced."""
    last = log.groupBy("month").agg(F.max_by(F.struct("expected_rows", "fetched_rows"), "attempt").alias("l"), F.max("attempt").alias("attempts"))
    return last.where("l.expected_rows <> l.fetched_rows").select("month", "attempts", "l.expected_rows", "l.fetched_rows")
