"""Marts and dimensions of the hourly fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import timefns

TS = "transit_timestamp"


def hourly_by_method(clean: DataFrame, dst_flag: bool = False) -> DataFrame:
    extra = [F.bool_or("is_dst_transition").alias("is_dst_transition")] if dst_flag else []
    return clean.groupBy(F.col(TS).alias("hour"), "payment_method").agg(
        F.sum("ridership").alias("ridership"), F.sum("transfers").alias("transfers"), *extra
    )


def daily_by_station(clean: DataFrame) -> DataFrame:
    omny = F.when(F.col("payment_method") == "omny", F.col("ridership"))
    return clean.groupBy(F.to_date(TS).alias("day"), "station_complex_id").agg(
        F.sum("ridership").alias("ridership"),
        F.sum("transfers").alias("transfers"),
        F.coalesce(F.sum(omny), F.lit(0)).alias("omny_ridership"),
    )


def daily_by_class(clean: DataFrame) -> DataFrame:
    return clean.groupBy(F.to_date(TS).alias("day"), "fare_class_category").agg(F.sum("ridership").alias("ridership"))


def latest_attributes(df: DataFrame, key: str, ts: str, attributes: Sequence[str]) -> DataFrame:
    """Latest value of each attribute per key; equal times go to the largest value."""
    return df.groupBy(key).agg(*[F.max_by(a, F.struct(F.col(ts), F.col(a))).alias(a) for a in attributes])


def station_dim(clean: DataFrame) -> DataFrame:
    return latest_attributes(
        clean,
        "station_complex_id",
        TS,
        ["station_complex", "borough", "transit_mode", "latitude", "longitude"],
    )


def date_dim(df: DataFrame, ts: str = TS, observed_only: bool = False) -> DataFrame:
    """One row per day: every day of the span, or only the days that occur."""
    days = df.select(F.to_date(ts).alias("date")).distinct() if observed_only else timefns.day_span(df, ts, "date")
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        timefns.iso_weekday("date").alias("day_of_week"),
        timefns.is_weekend("date").alias("is_weekend"),
    )


def station_hour_profile(clean: DataFrame) -> DataFrame:
    """Mean per station, day type and hour; hours without a row count as zero.

    The divisor is the number of days of the day type over all stations, so it
    comes from a separate, much smaller aggregation over days.
    """
    typed = clean.groupBy(
        "station_complex_id", timefns.day_type(TS).alias("day_type"), F.hour(TS).alias("hour_of_day")
    ).agg(F.sum("ridership").alias("_sum"))
    days = clean.select(F.to_date(TS).alias("_day")).distinct()
    counts = days.groupBy(timefns.day_type("_day").alias("day_type")).agg(F.count("*").alias("_days"))
    return typed.join(F.broadcast(counts), "day_type").select(  # two day types
        "station_complex_id", "day_type", "hour_of_day", (F.col("_sum") / F.col("_days")).alias("mean_ridership")
    )


# --- the same marts from monthly parts ------------------------------------------

STATION_ATTRIBUTES = ["station_complex", "borough", "transit_mode", "latitude", "longitude"]


def station_parts(clean: DataFrame) -> DataFrame:
    """Per month and station: each attribute with the time it was last seen."""
    latest = [F.max(F.struct(F.col(TS).alias("ts"), F.col(a).alias("v"))).alias(a) for a in STATION_ATTRIBUTES]
    return clean.groupBy(timefns.month_start(TS).alias("first_day"), "station_complex_id").agg(*latest)


def station_dim_from_parts(parts: DataFrame) -> DataFrame:
    """Equal to :func:`station_dim` of all rows behind the parts."""
    merged = parts.groupBy("station_complex_id").agg(*[F.max(a).alias(a) for a in STATION_ATTRIBUTES])
    return merged.select("station_complex_id", *[F.col(f"{a}.v").alias(a) for a in STATION_ATTRIBUTES])


def profile_parts(clean: DataFrame) -> DataFrame:
    """Per month: totals by station, day type and hour."""
    return clean.groupBy(
        timefns.month_start(TS).alias("first_day"),
        "station_complex_id",
        timefns.day_type(TS).alias("day_type"),
        F.hour(TS).alias("hour_of_day"),
    ).agg(F.sum("ridership").alias("ridership"))


def profile_from_parts(parts: DataFrame, days: DataFrame) -> DataFrame:
    """Equal to :func:`station_hour_profile`; ``days`` lists every observed day once."""
    counts = days.groupBy(timefns.day_type("day").alias("day_type")).agg(F.count("*").alias("_days"))
    totals = parts.groupBy("station_complex_id", "day_type", "hour_of_day").agg(F.sum("ridership").alias("_sum"))
    return totals.join(F.broadcast(counts), "day_type").select(  # two day types
        "station_complex_id", "day_type", "hour_of_day", (F.col("_sum") / F.col("_days")).alias("mean_ridership")
    )


def fact_with_dimension(fact: DataFrame, dim: DataFrame, key: str, by: Sequence[str], measure: str) -> DataFrame:
    """Fact totals by dimension attributes: aggregate per key first, then look up."""
    per_key = fact.groupBy(key).agg(F.sum(measure).alias("_m"))
    return per_key.join(dim, key).groupBy(*by).agg(F.sum("_m").alias(measure))
