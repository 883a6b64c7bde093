"""Fingerprints, change planning and incremental cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import timefns

STAMPS = ["rows", "ridership", "transfers", "source_updated_at"]


def day_fingerprint(df: DataFrame, ts: str, measures: dict[str, Column], updated: str) -> DataFrame:
    """Per day: rows, one total per measure, newest change."""
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("rows"),
        *[F.sum(c).alias(n) for n, c in measures.items()],
        F.max(updated).alias("source_updated_at"),
    )


def changed_days(current: DataFrame, stored: DataFrame, stamps: list[str] = STAMPS) -> DataFrame:
    """(day, change) with change new, changed or removed; equal days are left out."""
    c = current.select("day", F.struct(*stamps).alias("_c"))
    s = stored.select("day", F.struct(*stamps).alias("_s"))
    change = (
        F.when(F.col("_s").isNull(), "new")
        .when(F.col("_c").isNull(), "removed")
        .when(~F.col("_c").eqNullSafe(F.col("_s")), "changed")
    )
    return c.join(s, "day", "full").select("day", change.alias("change")).where("change IS NOT NULL")


def changed_months(changes: DataFrame) -> DataFrame:
    """Months that hold any changed, new or vanished day."""
    return changes.select(timefns.month_start("day").alias("month")).distinct()


def days_to_fetch(current: DataFrame, changes: DataFrame) -> DataFrame:
    """All current days of the changed months: the month is the unit of reload."""
    months = changed_months(changes)
    return (
        current.select("day", timefns.month_start("day").alias("month"), "rows").join(months, "month", "left_semi")
    )


def months_to_rebuild(changes: DataFrame, current: DataFrame, rebuild: bool = False) -> DataFrame:
    """Months of changed and removed days, or all months; vanished ones are marked for deletion."""
    present = current.select(timefns.month_start("day").alias("month")).distinct().withColumn("_here", F.lit(1))
    wanted = changed_months(changes)
    if rebuild:
        wanted = wanted.union(present.select("month")).distinct()
    action = F.when(F.col("_here").isNull(), "delete").otherwise("build")
    return wanted.join(present, "month", "left").select("month", action.alias("action"))


def newest_days(days: DataFrame, limit: int) -> DataFrame:
    return days.orderBy(F.desc("day")).limit(limit)


def day_status(server: DataFrame, local: DataFrame) -> DataFrame:
    """Why a day must be loaded again, or ``up to date``."""
    l = local.select(
        "day",
        F.struct("rows", "ridership", "transfers").alias("_l"),
        F.col("source_updated_at").alias("_stamp"),
    )
    joined = server.withColumn("_s", F.struct("rows", "ridership", "transfers")).join(l, "day", "left")
    status = (
        F.when(F.col("_l").isNull(), "missing")
        .when(~F.col("_s").eqNullSafe(F.col("_l")), "rows or totals differ")
        .when(F.col("_stamp") < F.col("source_updated_at"), "revised on the server")
        .otherwise("up to date")
    )
    return joined.select("day", status.alias("status"))


def expected_rows(expected: DataFrame, fetched: DataFrame, ts: str) -> DataFrame:
    """Days whose landed row count differs from the announced one."""
    landed = fetched.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("fetched_rows"))
    return (
        expected.select("day", F.col("rows").alias("expected_rows"))
        .join(landed, "day", "left")
        .select("day", "expected_rows", F.coalesce("fetched_rows", F.lit(0)).alias("fetched_rows"))
        .where("expected_rows <> fetched_rows")
    )


def after_watermark(df: DataFrame, ts: str, watermark) -> DataFrame:
    return df.where(F.col(ts) > watermark)


def advance_watermark(fetched: DataFrame, ts: str, watermark) -> DataFrame:
    """New watermark: the newest fetched time even if every row was a duplicate."""
    w = watermark if isinstance(watermark, Column) else F.lit(watermark)
    return fetched.agg(F.coalesce(F.max(ts), w).alias("watermark"))


def month_manifest(df: DataFrame, expected: DataFrame, ts: str) -> DataFrame:
    """Days, rows, expected rows and first/last time per month."""
    days = df.groupBy(F.to_date(ts).alias("_d")).agg(F.count("*").alias("_n"), F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    months = days.groupBy(timefns.month_start("_d").alias("month")).agg(
        F.count("*").alias("days"), F.sum("_n").alias("rows"), F.min("_a").alias("first_ts"), F.max("_b").alias("last_ts")
    )
    return months.join(expected.select("month", "expected_rows"), "month", "left")
