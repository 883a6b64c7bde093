"""Shapes over time and over entities: profiles, shares, concentration, changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import timefns
from tidemark.functions.stats import percent
from tidemark.model import AM_HOURS, PM_HOURS


def system_hours(df: DataFrame, ts: str, measure: str) -> DataFrame:
    """Total over all entities per hour; everything below starts from this small relation."""
    return df.groupBy(timefns.hour_start(ts).alias("hour")).agg(F.sum(measure).alias("total"))


def system_days(df: DataFrame, ts: str, measure: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("day")).agg(F.sum(measure).alias("total"))


def hour_profile(hours: DataFrame) -> DataFrame:
    """Mean system total per hour of day."""
    return hours.groupBy(F.hour("hour").alias("hour_of_day")).agg(F.avg("total").alias("mean_total"), F.count("*").alias("hours"))


def weekday_profile(days: DataFrame) -> DataFrame:
    """Mean system total per ISO weekday."""
    return days.groupBy(
        timefns.iso_weekday("day").alias("iso_weekday"), timefns.weekday_name("day").alias("weekday")
    ).agg(F.avg("total").alias("mean_total"), F.count("*").alias("days"))


def weekday_hour_matrix(hours: DataFrame, last_weeks: int | None = None) -> DataFrame:
    """Weekday rows × 24 hour columns of mean totals, optionally of the newest weeks only."""
    if last_weeks is not None:
        newest = hours.agg(F.max("hour")).scalar()
        hours = hours.where(F.col("hour") > newest - F.expr(f"INTERVAL {7 * int(last_weeks)} DAY"))
    return (
        hours.select(timefns.iso_weekday("hour").alias("iso_weekday"), F.hour("hour").alias("_h"), "total")
        .groupBy("iso_weekday")
        .pivot("_h", list(range(24)))
        .agg(F.avg("total"))
        .select("iso_weekday", *[F.coalesce(F.col(str(h)), F.lit(0.0)).alias(f"h{h:02d}") for h in range(24)])
    )


def busiest_hours(hours: DataFrame, k: int = 4) -> DataFrame:
    """Hours of the weekday profile with the largest mean and their share of the day."""
    weekday = hour_profile(hours.where(~timefns.is_weekend("hour")))
    whole = weekday.agg(F.sum("mean_total")).scalar()
    return weekday.select("hour_of_day", "mean_total", (100.0 * F.col("mean_total") / whole).alias("share_pct")).orderBy(
        F.desc("mean_total"), "hour_of_day"
    ).limit(k)


def headline(df: DataFrame, ts: str, measure: str, transfers: str, omny: Column) -> DataFrame:
    """Days, totals, weekday and weekend mean per day, transfer ratio and method share."""
    days = df.groupBy(F.to_date(ts).alias("day")).agg(
        F.sum(measure).alias("r"), F.sum(transfers).alias("t"), F.sum(F.when(omny, F.col(measure))).alias("o")
    )
    weekend = timefns.is_weekend("day")
    return days.agg(
        F.count("*").alias("days"),
        F.sum("r").alias("total"),
        F.avg("r").alias("mean_day"),
        F.avg(F.when(~weekend, F.col("r"))).alias("mean_weekday"),
        F.avg(F.when(weekend, F.col("r"))).alias("mean_weekend_day"),
        percent(F.sum("t"), F.sum("r")).alias("transfers_pct"),
        percent(F.sum("o"), F.sum("r")).alias("omny_pct"),
    )


def trailing_week(days: DataFrame) -> DataFrame:
    """Newest week against the week before, 30-day mean and 30-day method share.

    ``days`` holds day, total and omny.
    """
    last = days.agg(F.max("day")).scalar()
    age = F.datediff(last, F.col("day"))
    week, before, month = age < 7, (age >= 7) & (age < 14), age < 30
    pick = lambda cond, c: F.sum(F.when(cond, F.col(c)))
    return days.agg(
        F.max("day").alias("last_day"),
        pick(week, "total").alias("week_total"),
        (percent(pick(week, "total"), pick(before, "total")) - 100).alias("week_change_pct"),
        F.avg(F.when(month, F.col("total"))).alias("mean_day_30"),
        percent(pick(month, "omny"), pick(month, "total")).alias("omny_pct_30"),
    )


def monthly_mean(days: DataFrame) -> DataFrame:
    """Mean per day of each month, marked when days are missing."""
    return days.groupBy(timefns.month_start("day").alias("month")).agg(
        F.count("*").alias("days"), F.avg("total").alias("mean_day")
    ).withColumn("complete", F.col("days") >= timefns.days_in_month("month"))


def year_over_year(months: DataFrame, years: Sequence[int]) -> DataFrame:
    """Mean per day of each calendar month in several years and the change of the last two."""
    wide = (
        months.withColumn("_year", F.year("month"))
        .groupBy(F.month("month").alias("calendar_month"))
        .pivot("_year", list(years))
        .agg(F.max("mean_day"))
    )
    named = wide.select("calendar_month", *[F.col(str(y)).alias(f"mean_{y}") for y in years])
    a, b = years[-2], years[-1]
    return named.withColumn("change_pct", 100 * (F.col(f"mean_{b}") / F.col(f"mean_{a}") - 1))


def monthly_share(df: DataFrame, ts: str, measure: str, part: Column) -> DataFrame:
    return df.groupBy(timefns.month_start(ts).alias("month")).agg(
        percent(F.sum(F.when(part, F.col(measure))), F.sum(measure)).alias("share_pct")
    )


def yearly_category_share(df: DataFrame, ts: str, category: str, measure: str) -> DataFrame:
    """Share of each category in its year."""
    from tidemark.operators.series import share_in_group

    per = df.groupBy(F.year(ts).alias("year"), category).agg(F.sum(measure).alias("total"))
    return share_in_group(per, ["year"], "total")


def rollup_share(per_entity: DataFrame, group: str, measure: str, days: Column) -> DataFrame:
    """Entities, total, share and mean per entity-day of each group."""
    whole = per_entity.agg(F.sum(measure)).scalar()
    return per_entity.groupBy(group).agg(F.count("*").alias("entities"), F.sum(measure).alias("total")).select(
        group,
        "entities",
        "total",
        (100.0 * F.col("total") / whole).alias("share_pct"),
        (F.col("total") / F.col("entities") / days).alias("mean_entity_day"),
    )


def hour_shares(df: DataFrame, key: str, ts: str, measure: str) -> DataFrame:
    """Weekday shape per entity: its total and the share of the morning and evening hours."""
    weekday = df.where(~timefns.is_weekend(ts))
    hour = F.hour(ts)
    per = weekday.groupBy(key).agg(
        F.sum(measure).alias("total"),
        F.sum(F.when(hour.isin(AM_HOURS), F.col(measure))).alias("_am"),
        F.sum(F.when(hour.isin(PM_HOURS), F.col(measure))).alias("_pm"),
    )
    return per.select(
        key,
        "total",
        percent(F.coalesce("_am", F.lit(0)), F.col("total")).alias("am_share"),
        percent(F.coalesce("_pm", F.lit(0)), F.col("total")).alias("pm_share"),
    )


def heavy_counts(shares: DataFrame) -> DataFrame:
    morning = F.col("am_share") > F.col("pm_share")
    return shares.agg(F.count_if(morning).alias("morning_heavy"), F.count_if(~morning).alias("evening_heavy"))


def representatives(shares: DataFrame, key: str, among: int = 50) -> DataFrame:
    """Most morning-heavy, most evening-heavy and most balanced of the largest entities."""
    busy = shares.orderBy(F.desc("total"), key).limit(among).withColumn("_d", F.round(F.col("am_share") - F.col("pm_share"), 6))
    picks = busy.agg(
        F.max_by(key, F.struct("_d", key)).alias("morning_heavy"),
        F.min_by(key, F.struct("_d", key)).alias("evening_heavy"),
        F.min_by(key, F.struct(F.abs("_d"), F.col(key))).alias("balanced"),
    )
    return picks.unpivot([], ["morning_heavy", "evening_heavy", "balanced"], "profile", key)


def melt_methods(days: DataFrame, id_column: str, values: Sequence[str]) -> DataFrame:
    """Wide measure columns to (series, value) rows."""
    return days.unpivot([id_column], list(values), "series", "value")


def pivot_counts(long: DataFrame, row: str, column: str, values: Sequence[str], measure: str) -> DataFrame:
    """Long to wide over declared values, missing cells as zero."""
    return long.groupBy(row).pivot(column, list(values)).agg(F.sum(measure)).fillna(0, list(values))


def transition_days(df: DataFrame, ts: str, measure: str, days: DataFrame) -> DataFrame:
    """Totals of hours 0–4 on listed days (label, day), with the hours present.

    ``days`` is a short literal relation.
    """
    hours = system_hours(df, ts, measure)
    at = F.hour("hour")
    return (
        hours.withColumn("day", F.to_date("hour"))
        .join(days, "day")
        .groupBy("label", "day")
        .agg(
            *[F.sum(F.when(at == h, F.col("total"))).alias(f"h{h:02d}") for h in range(5)],
            F.count("*").alias("hours_present"),
        )
    )
