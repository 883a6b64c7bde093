"""Dense entity × hour grids and time-offset features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import timefns


def dense_grid(
    hourly: DataFrame, entity: str, ts: str, value: str, last_days: int | None = None, drop_dst: bool = False, folded: bool = False
) -> DataFrame:
    """One row per entity and hour of the span, absent combinations as zero.

    ``hourly`` must hold one row per (entity, hour) and times on the hour. The hours are generated
    from each entity row, so there is no product join.

    ``folded`` keeps the same grid as one row an entity: the first and last hour of the span and the list of its recorded hours, which the
    calendar bounds; every other hour of the span is zero. :func:`opened` makes the rows of it.
    """
    if folded and drop_dst:
        raise ValueError("a folded grid has all hours of its span")
    span = hourly.agg(F.struct(F.min(ts).alias("first"), F.max(ts).alias("last"))).scalar()
    last = span["last"]
    if last_days is None:
        first: Column = span["first"]
    else:
        first = last - F.expr(f"INTERVAL {int(last_days)} DAY") + F.expr("INTERVAL 1 HOUR")
    if folded:
        # A NULL entity has its hours, but no recorded ones, as in the join of the other form.
        kept = F.col(entity).isNotNull() & (F.col(ts) >= first) & (F.col(ts) <= last) & (F.col(ts) == F.date_trunc("hour", ts).cast("timestamp_ntz"))
        row = F.struct(F.col(ts).alias("at"), F.coalesce(value, F.lit(0)).cast("double").alias("v"))
        lists = hourly.groupBy(entity).agg(F.collect_list(F.when(kept, row)).alias("_found"))
        return lists.select(entity, first.alias("_first"), last.alias("_last"), "_found")
    days = hourly.select(entity).distinct().withColumn("_day", F.explode(F.sequence(F.to_date(first), F.to_date(last))))
    # Recorded values meet the grid by day, as lists of at most 24, and an entity's days go to one task before they get their hours: the
    # hours, the bulk of the grid, are never moved, and a window per entity finds them where they are.
    found = hourly.select(entity, F.to_date(ts).alias("_day"), F.struct(F.col(ts).alias("at"), F.coalesce(value, F.lit(0)).cast("double").alias("v")).alias("_row"))
    found = found.groupBy(entity, "_day").agg(F.collect_list("_row").alias("_found"))
    kept = F.coalesce(F.filter("_found", lambda r: F.array_contains("_opened", r["at"])), F.array().cast("array<struct<at:timestamp_ntz,v:double>>"))
    absent = F.transform(F.array_except("_opened", kept["at"]), lambda h: F.struct(h.alias("at"), F.lit(0.0).alias("v")))
    # The days are small and the hours are not, so the tasks have their own number and aren't merged by the size of the days.
    tasks = 2 * int(hourly.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = days.join(found, [entity, "_day"], "left").repartition(tasks, entity)
    if drop_dst:
        # Hours nobody recorded are not part of this form of the grid. The others are one list of at most 24 for each day of the calendar.
        recorded = hourly.where((F.col(ts) >= first) & (F.col(ts) <= last) & ~timefns.is_dst_hour(ts))
        lists = recorded.groupBy(F.to_date(ts).alias("_day")).agg(F.collect_set(ts).alias("_opened"))
        dealt = dealt.join(F.broadcast(lists), "_day")
    else:
        dealt = dealt.withColumn("_opened", F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.col("_day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), h)))
    hours = dealt.select(entity, F.inline(F.concat(kept, absent)).alias(ts, value))
    return hours.where((F.col(ts) >= first) & (F.col(ts) <= last))


def is_folded(df: DataFrame) -> bool:
    return {"_first", "_last", "_found"} <= set(df.columns)


def _hours() -> Column:
    """The hours of a folded row."""
    return F.when(F.col("_first") <= F.col("_last"), F.sequence("_first", "_last", F.expr("INTERVAL 1 HOUR"))).otherwise(F.array().cast("array<timestamp_ntz>"))


def opened(folded: DataFrame, entity: str, ts: str, value: str) -> DataFrame:
    """The rows of a folded grid: one per entity and hour of its span."""
    absent = F.transform(F.array_except(_hours(), F.col("_found")["at"]), lambda h: F.struct(h.alias("at"), F.lit(0.0).alias("v")))
    return folded.select(entity, F.inline(F.concat("_found", absent)).alias(ts, value))


def span_hours(folded: DataFrame, ts: str) -> DataFrame:
    """One row per hour of a folded grid's span, which all its rows share."""
    return folded.agg(F.min("_first").alias("_first"), F.max("_last").alias("_last")).select(F.explode(_hours()).alias(ts))


def split_folded(folded: DataFrame, days: int) -> tuple[DataFrame, DataFrame]:
    """The grid up to its newest days, and those days, both folded."""
    # One step after the other: within one, a lambda would see the new bound and not the old one.
    at = folded.withColumn("_cut", F.col("_last") - F.expr(f"INTERVAL {int(days)} DAY"))
    old = at.withColumn("_found", F.filter("_found", lambda r: r["at"] <= F.col("_cut"))).withColumn("_last", F.col("_cut"))
    new = at.withColumn("_found", F.filter("_found", lambda r: r["at"] > F.col("_cut"))).withColumn("_first", F.greatest("_first", F.col("_cut") + F.expr("INTERVAL 1 HOUR")))
    return old.drop("_cut"), new.drop("_cut")


# Offsets in hours of the lag features.
LAG_HOURS = {"lag_1h": 1, "lag_2h": 2, "lag_24h": 24, "lag_7d": 168, "lag_14d": 336, "lag_21d": 504, "lag_28d": 672}


def lag_features(grid: DataFrame, entity: str, ts: str, value: str, lags: Mapping[str, int] = LAG_HOURS) -> DataFrame:
    """Value of the same entity a number of hours earlier, by time and not by row.

    Range frames of one single second select exactly the row at ``ts - lag`` or
    nothing, so all lags share one shuffle and one sort. A grid holds one row
    per hour and entity, which bounds every window group by the calendar.
    """
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    w = Window.partitionBy(entity).orderBy("_s")
    return (
        grid.withColumn("_s", seconds)
        .select("*", *[F.max(value).over(w.rangeBetween(-h * 3600, -h * 3600)).alias(n) for n, h in lags.items()])
        .drop("_s")
    )


def mean_ignoring_null(columns: Sequence[str]) -> Column:
    present = F.array_compact(F.array(*columns))
    total = F.aggregate(present, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(present) > 0, total / F.size(present))


def neighbour_mean(hourly: DataFrame, ts: str, value: str, at: Column, days: int = 7) -> DataFrame:
    """Value at chosen hours beside the mean of the same hour ``days`` before and after.

    Only the chosen hours and their neighbours leave the scan.
    """
    chosen = hourly.where(at).select(F.col(ts), F.col(value).alias("value"))
    step = F.expr(f"INTERVAL {int(days)} DAY")
    wanted = chosen.select(F.col(ts), "value", F.explode(F.array(F.col(ts) - step, F.col(ts) + step)).alias("_at"))
    near = hourly.select(F.col(ts).alias("_at"), F.col(value).alias("_v"))
    return wanted.join(near, "_at", "left").groupBy(ts, "value").agg(F.avg("_v").alias("neighbour_mean"))


def missing_hours(df: DataFrame, ts: str) -> DataFrame:
    """Hours of the span without any row."""
    present = df.select(timefns.hour_start(ts).alias("hour")).distinct()
    return timefns.hour_span(df, ts).join(present, "hour", "left_anti")


def missing_days(df: DataFrame, ts: str) -> DataFrame:
    present = df.select(F.to_date(ts).alias("day")).distinct()
    return timefns.day_span(df, ts).join(present, "day", "left_anti")
