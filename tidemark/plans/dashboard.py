"""Result queries over the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import series, shape


def overview(daily_station: DataFrame) -> DataFrame:
    days = daily_station.groupBy("day").agg(F.sum("ridership").alias("total"), F.sum("omny_ridership").alias("omny"))
    return shape.trailing_week(days)


def daily_series(daily_station: DataFrame, first: str, end: str) -> DataFrame:
    """(day, series, value) by method for days in ``[first, end)``."""
    inside = daily_station.where((F.col("day") >= F.lit(first).cast("date")) & (F.col("day") < F.lit(end).cast("date")))
    days = inside.groupBy("day").agg(F.sum("omny_ridership").alias("omny"), F.sum("ridership").alias("_all"))
    wide = days.select("day", "omny", (F.col("_all") - F.col("omny")).alias("metrocard"))
    return shape.melt_methods(wide, "day", ["omny", "metrocard"])


def top_stations(daily_station: DataFrame, stations: DataFrame, days: int = 30, k: int = 15) -> DataFrame:
    """Stations with the largest mean per day over the newest days."""
    last = daily_station.agg(F.max("day")).scalar()
    recent = daily_station.where(F.col("day") > F.date_sub(last, days))
    n = recent.select("day").distinct().agg(F.count("*")).scalar()
    totals = recent.groupBy("station_complex_id").agg(F.sum("ridership").alias("_t"))
    best = series.top_k(totals, k, F.desc("_t"), "station_complex_id").withColumn("mean_daily", F.col("_t") / n)
    return best.join(stations.select("station_complex_id", "station_complex", "borough"), "station_complex_id").select(
        "station_complex_id", "station_complex", "borough", "mean_daily"
    )


def busiest_station(daily_station: DataFrame) -> Column:
    totals = daily_station.groupBy("station_complex_id").agg(F.sum("ridership").alias("_t"))
    return series.top_k(totals, 1, F.desc("_t"), "station_complex_id").select("station_complex_id").scalar()


def station_series(daily_station: DataFrame, station) -> DataFrame:
    return daily_station.where(F.col("station_complex_id") == station).select("day", "ridership", "transfers")


def station_profile(profile: DataFrame, station) -> DataFrame:
    return profile.where(F.col("station_complex_id") == station).drop("station_complex_id")


def week_matrix(hourly: DataFrame, last_weeks: int | None = None) -> DataFrame:
    hours = hourly.groupBy("hour").agg(F.sum("ridership").alias("total"))
    return shape.weekday_hour_matrix(hours, last_weeks)


def quality_pivot(quality_month: DataFrame, tags: list[str]) -> DataFrame:
    found = quality_month.where(F.col("tag").isin(tags))
    return shape.pivot_counts(found, "month", "tag", tags, "rows")


def last_runs(runs: DataFrame, k: int = 5) -> DataFrame:
    return series.top_k(runs, k, F.desc("started_at"), "run_id")


def latest_delays(minutes: DataFrame, last_minutes: int = 30) -> DataFrame:
    """Per route over the newest minutes: observations, mean delay, share late, stopped trains."""
    newest = minutes.agg(F.max("minute")).scalar()
    recent = minutes.where(F.col("minute") > newest - F.expr(f"INTERVAL {int(last_minutes)} MINUTE"))
    n = F.nullif(F.sum("delay_observations"), F.lit(0))
    return recent.groupBy("route_id").agg(
        F.sum("observations").alias("observations"),
        (F.sum("sum_delay_s") / n).alias("avg_delay_s"),
        (100.0 * F.sum("late_observations") / n).alias("late_pct"),
        F.sum("stopped_at").alias("stopped_at"),
    )


def newest_documents(documents: DataFrame, order: str, k: int, key: str) -> DataFrame:
    return series.top_k(documents, k, F.desc(order), key)
