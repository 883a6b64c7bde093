"""When data was published: release batches, late rows, revisions, publication lag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import timefns
from tidemark.functions.stats import percent
from tidemark.model import LOCAL_ZONE
from tidemark.operators.series import gaps


def load_batches(rows: DataFrame, created: str, ts: str) -> DataFrame:
    """Rows and time range of every release."""
    return rows.groupBy(F.col(created).alias("created_at")).agg(
        F.count("*").alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )


def release_gaps(batches: DataFrame) -> DataFrame:
    """Days since the previous release and the weekday of each release."""
    stamped = gaps(batches.select("created_at", "rows"), "created_at")
    return stamped.withColumn("weekday", timefns.weekday_name("created_at"))


def release_summary(batches: DataFrame) -> DataFrame:
    """Range of the gaps after the first bulk load and the weekdays releases fall on."""
    first = batches.agg(F.min("created_at")).scalar()
    g = release_gaps(batches)
    weekly = g.where(F.col("created_at") > first)
    second = weekly.agg(F.min("created_at")).scalar()
    gap = F.when(F.col("created_at") > second, F.col("gap_days"))
    return weekly.agg(
        F.count("*").alias("releases"),
        F.min(gap).alias("gap_days_min"),
        F.max(gap).alias("gap_days_max"),
        # Seven weekdays at most.
        F.array_join(F.array_sort(F.collect_set("weekday")), ", ").alias("weekdays"),
    )


def late_rows(rows: DataFrame, created: str, ts: str, days: int = 6) -> DataFrame:
    """Per release: rows more than ``days`` older than its newest day.

    Counted per (release, day) first, so the join to the newest day sees only
    the calendar and not the rows.
    """
    by_day = rows.groupBy(F.col(created).alias("created_at"), F.to_date(ts).alias("_d")).agg(F.count("*").alias("_n"))
    newest = by_day.groupBy("created_at").agg(F.max("_d").alias("newest_day"), F.min("_d").alias("oldest_day"))
    late = F.when(F.datediff("newest_day", "_d") > days, F.col("_n")).otherwise(0)
    return (
        by_day.join(newest, "created_at")
        .groupBy("created_at", "oldest_day", "newest_day")
        .agg(F.sum("_n").alias("rows"), F.sum(late).alias("late_rows"))
        .withColumn("pct_late", percent(F.col("late_rows"), F.col("rows")))
    )


def late_summary(per_release: DataFrame, threshold: float = 5.0) -> DataFrame:
    return per_release.agg(
        F.count("*").alias("releases"),
        F.sum("rows").alias("rows"),
        F.sum("late_rows").alias("late_rows"),
        percent(F.sum("late_rows"), F.sum("rows")).alias("pct_late"),
        F.count_if(F.col("pct_late") > threshold).alias("releases_over_threshold"),
    )


def revisions(rows: DataFrame, created: str, updated: str, ts: str) -> DataFrame:
    """Rows changed after creation, per change instant, with the width of their time range."""
    total = rows.agg(F.count("*")).scalar()
    return (
        rows.where(F.col(updated) > F.col(created))
        .groupBy(F.col(updated).alias("updated_at"))
        .agg(F.count("*").alias("rows"), F.to_date(F.min(ts)).alias("first_day"), F.to_date(F.max(ts)).alias("last_day"))
        .withColumn("span_days", F.datediff("last_day", "first_day"))
        .withColumn("pct_of_total", percent(F.col("rows"), total))
    )


def publication_lag(batches: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Hours from the end of a release's data (last local hour + 1 h) to the release instant (UTC)."""
    end_local = F.col("last_ts") + F.expr("INTERVAL 1 HOUR")
    end_utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), end_local).cast("timestamp")
    lag = (F.unix_micros(F.col("created_at").cast("timestamp")) - F.unix_micros(end_utc)) / 3.6e9
    return batches.select("created_at", "last_ts", lag.alias("lag_hours"))
