"""Feature tables over the dense entity × hour grid."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.functions import timefns
from tidemark.model import AM_HOURS, PM_HOURS
from tidemark.operators import grid, series

# The feature lists of the two scenarios and of the serving model.
CALENDAR = ["hour", "dow", "is_weekend", "month", "is_holiday", "profile_mean", "profile_log"]
SCENARIO_A = [*CALENDAR, "lag_1h", "lag_2h", "lag_24h", "lag_7d"]
SCENARIO_B = [*CALENDAR, "lag_14d", "lag_21d", "lag_28d", "lag_mean_14_28d"]
SERVING = ["station_mean", "profile_mean", "hour", "dow", "month", "is_holiday"]


def calendar(df: DataFrame, ts: str) -> DataFrame:
    """Hour, ISO weekday, weekend, month, day type and holiday of each row, as expressions."""
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "dow": timefns.iso_weekday(ts),
            "is_weekend": timefns.is_weekend(ts).cast("int"),
            "month": F.month(ts),
            "day_type": timefns.day_type(ts),
            "is_holiday": timefns.is_holiday(ts).cast("int"),
        }
    )


def split_at(df: DataFrame, ts: str, first_test: Column | str) -> tuple[DataFrame, DataFrame]:
    """Rows before a time to learn from and rows from it on to test with."""
    at = F.lit(first_test).cast("timestamp_ntz") if isinstance(first_test, str) else first_test
    return df.where(F.col(ts) < at), df.where(F.col(ts) >= at)


def hold_out(df: DataFrame, ts: str, days: int = 28) -> tuple[DataFrame, DataFrame]:
    """The newest days as the test part; the parts of a folded grid are folded."""
    if grid.is_folded(df):
        return grid.split_folded(df, days)
    cut = df.agg(F.max(ts)).scalar() - F.expr(f"INTERVAL {int(days)} DAY")
    return df.where(F.col(ts) <= cut), df.where(F.col(ts) > cut)


def weekday_lookup(train: DataFrame, entity: str, value: str) -> DataFrame:
    """Mean and log-mean per entity, weekday and hour, from the training part only."""
    return train.groupBy(entity, "dow", "hour").agg(F.avg(value).alias("profile_mean"), F.avg(F.log1p(value)).alias("profile_log"))


def with_weekday_profile(rows: DataFrame, entity: str, value: str, learnt: Column) -> DataFrame:
    """Rows beside ``weekday_lookup`` of those that are ``learnt``; rows it has nothing for are left out.

    The groups lie within an entity, so rows that are together by entity stay where they are.
    """
    w, v = Window.partitionBy(entity, "dow", "hour"), F.when(learnt, F.col(value))
    profiled = rows.withColumns({"_learnt": F.max(learnt).over(w), "profile_mean": F.avg(v).over(w), "profile_log": F.avg(F.log1p(v)).over(w)})
    return profiled.where(F.col("_learnt") & F.col(entity).isNotNull()).drop("_learnt")


def day_type_lookup(train: DataFrame, entity: str, value: str) -> DataFrame:
    return train.groupBy(entity, "day_type", "hour").agg(F.avg(value).alias("profile_mean"))


def entity_lookup(train: DataFrame, entity: str, value: str) -> DataFrame:
    return train.groupBy(entity).agg(F.avg(value).alias("station_mean"))


def feature_table(hourly: DataFrame, entity: str, ts: str, value: str, first_test: Column | str) -> DataFrame:
    """Grid, calendar, lags and training-only profile of every entity and hour."""
    dense = grid.dense_grid(hourly, entity, ts, value, drop_dst=True)
    lagged = grid.lag_features(dense, entity, ts, value).withColumn(
        "lag_mean_14_28d", grid.mean_ignoring_null(["lag_14d", "lag_21d", "lag_28d"])
    )
    at = F.lit(first_test).cast("timestamp_ntz") if isinstance(first_test, str) else first_test
    return with_weekday_profile(calendar(lagged, ts), entity, value, F.col(ts) < at)


def _slot() -> Column:
    """Hour and day type as one number."""
    return F.col("hour") + F.when(F.col("day_type") == "weekend", 24).otherwise(0)


def folded_lookup(train: DataFrame, entity: str) -> DataFrame:
    """(entity, station_mean, _profile) of a folded grid: the means of ``entity_lookup`` and ``day_type_lookup`` over all its hours.

    Hours that aren't recorded are zero, so they count in a mean and add nothing to its sum; how many there are comes from the calendar.
    """
    hours = calendar(grid.span_hours(train, "_at"), "_at").groupBy(_slot().alias("_slot")).agg(F.count("*").alias("n"))
    counts = hours.agg(F.collect_list(F.struct("_slot", "n"))).scalar()
    known = train.where(F.col(entity).isNotNull())
    recorded = calendar(known.select(entity, F.inline("_found").alias("_at", "_v")), "_at")
    sums = recorded.groupBy(entity, _slot().alias("_slot")).agg(F.sum("_v").alias("_sum"))
    sums = sums.groupBy(entity).agg(F.sum("_sum").alias("_total"), F.map_from_entries(F.collect_list(F.struct("_slot", "_sum"))).alias("_sums"))
    rows = known.select(entity).join(sums, entity, "left").withColumn("_counts", counts)
    zero = F.lit(0.0)
    n = F.aggregate("_counts", F.lit(0).cast("long"), lambda a, c: a + c["n"])
    means = F.transform("_counts", lambda c: F.struct(c["_slot"], F.coalesce(F.try_element_at("_sums", c["_slot"]), zero) / c["n"]))
    return rows.select(entity, (F.coalesce("_total", zero) / n).alias("station_mean"), F.map_from_entries(means).alias("_profile"))


@dataclass
class Crossed:
    """Rows of a folded grid beside their features, not opened: every entity at every hour of the calendar.

    What an entity is known by depends on the entity and the slot (hour and day type) alone, what an hour is known by on the hour alone, and the
    value is zero but for the recorded rows. A model that needs sums over groups of rows takes them from the three.
    """

    folded: DataFrame
    entity: str
    value: str

    @contextmanager
    def held(self) -> Iterator[Crossed]:
        """The same with one row an entity persisted, because all parts read it."""
        folded = self.folded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield replace(self, folded=folded)
        finally:
            folded.unpersist()

    @property
    def hours(self) -> DataFrame:
        """The calendar, one row per hour."""
        return calendar(grid.span_hours(self.folded, "_at"), "_at").withColumn("_slot", _slot()).drop("_at")

    @property
    def entities(self) -> DataFrame:
        """One row per entity and slot of the calendar: what holds for each of its hours."""
        slots = self.hours.agg(F.collect_set("_slot")).scalar()
        rows = self.folded.select(self.entity, "station_mean", "_profile", F.explode(slots).alias("_slot"))
        return rows.select(self.entity, "station_mean", F.try_element_at("_profile", "_slot").alias("profile_mean"), "_slot")

    @property
    def recorded(self) -> DataFrame:
        """Rows that may have another value than zero, with all columns."""
        return self._described(self.folded.select(self.entity, "station_mean", "_profile", F.inline("_found").alias("_at", self.value)))

    def sample(self, rows: int, seed: int) -> DataFrame:
        """All rows if there are fewer than twice as many, else about as many random ones; without the value.

        An entity's hours are parted into runs of one length, and a hash takes one hour of each run, so every row has the same chance.
        """
        size = self.folded.agg(F.count("*").alias("n"), F.min("_first").alias("a"), F.max("_last").alias("b")).first()
        hours = (size.b - size.a) // dt.timedelta(hours=1) + 1 if size.n and size.a else 0
        run = max(1, size.n * hours // rows)
        at = F.transform(F.sequence(F.lit(0), F.lit(max(hours - 1, 0) // run)), lambda j: j * F.lit(run) + F.pmod(F.xxhash64(F.col(self.entity), j, F.lit(seed)), F.lit(run)))
        chosen = self.folded.select(self.entity, "station_mean", "_profile", "_first", F.explode(F.filter(at, lambda i: i < hours)).alias("_i"))
        return self._described(chosen.withColumn("_at", F.col("_first") + F.make_dt_interval(F.lit(0), F.col("_i").cast("int"))))

    def _described(self, rows: DataFrame) -> DataFrame:
        return calendar(rows, "_at").withColumn("profile_mean", F.try_element_at("_profile", _slot())).drop("_profile")


def serving_features(rows: DataFrame, train: DataFrame, entity: str, value: str) -> DataFrame | Crossed:
    """Rows with calendar columns beside their entity mean and day-type profile.

    An entity's profile is one small map, so rows meet it by the entity alone. The rows of a folded grid stay folded.
    """
    if grid.is_folded(train):
        lookup = folded_lookup(train, entity)
    else:
        profiles = day_type_lookup(train, entity, value).groupBy(entity).agg(F.map_from_entries(F.collect_list(F.struct(_slot(), "profile_mean"))).alias("_profile"))
        # Both hold one row for each entity of ``train``, so the rows are joined once.
        lookup = entity_lookup(train, entity, value).join(profiles, entity)
    joined = rows.join(lookup, entity, "left")
    if grid.is_folded(rows):
        return Crossed(joined, entity, value)
    return joined.withColumn("profile_mean", F.try_element_at("_profile", _slot())).drop("_profile")


def peak_threshold(train: DataFrame, entity: str, value: str, q: float = 0.8) -> DataFrame:
    """Exact quantile per entity; a grid holds one row per hour, which bounds each group."""
    return train.groupBy(entity).agg(F.percentile(value, q).alias("threshold"))


def with_peak(rows: DataFrame, threshold: DataFrame, entity: str, value: str) -> DataFrame:
    """``is_peak``: at or above the entity's threshold and not zero."""
    peak = (F.col(value) >= F.col("threshold")) & (F.col(value) > 0)
    return rows.join(threshold, entity).withColumn("is_peak", peak.cast("int")).drop("threshold")


def rush_rule() -> Column:
    """Rule baseline: weekday morning and evening hours."""
    return ((F.col("dow") <= 5) & F.col("hour").isin([*AM_HOURS, *PM_HOURS])).cast("int")


def hour_share_vectors(df: DataFrame, entity: str, ts: str, value: str) -> DataFrame:
    """48 columns per entity: the share of each hour in weekdays and in weekends."""
    cells = [(d, h) for d in ("weekday", "weekend") for h in range(24)]
    kind, hour = timefns.day_type(ts), F.hour(ts)
    wide = df.groupBy(entity).agg(
        *[F.sum(F.when((kind == d) & (hour == h), F.col(value))).alias(f"{d}_{h:02d}") for d, h in cells],
        *[F.sum(F.when(kind == d, F.col(value))).alias(f"_{d}") for d in ("weekday", "weekend")],
    )
    return wide.select(entity, *[F.coalesce(F.col(f"{d}_{h:02d}") / F.nullif(F.col(f"_{d}"), F.lit(0)), F.lit(0.0)).alias(f"{d}_{h:02d}") for d, h in cells])


SHARE_COLUMNS = [f"{d}_{h:02d}" for d in ("weekday", "weekend") for h in range(24)]


def cluster_summary(rows: DataFrame, cluster: str, entity: str, borough: str = "Manhattan") -> DataFrame:
    """Size, mean day, morning and evening share, weekend ratio, peak hour, borough share, top names.

    ``rows`` holds one row per entity: cluster, avg_daily, weekday_mean,
    weekend_mean, borough and the 48 shares.
    """
    am = sum((F.col(f"weekday_{h:02d}") for h in AM_HOURS), F.lit(0.0)) * 100
    pm = sum((F.col(f"weekday_{h:02d}") for h in PM_HOURS), F.lit(0.0)) * 100
    base = rows.groupBy(cluster).agg(
        F.count("*").alias("stations"),
        F.avg("avg_daily").alias("avg_daily"),
        F.avg(am).alias("am_share"),
        F.avg(pm).alias("pm_share"),
        F.avg(100 * F.col("weekend_mean") / F.nullif(F.col("weekday_mean"), F.lit(0))).alias("weekend_ratio"),
        F.avg((F.col("borough") == borough).cast("double") * 100).alias("borough_pct"),
        *[F.avg(f"weekday_{h:02d}").alias(f"_h{h}") for h in range(24)],
    )
    hours = F.array(*[F.struct((100 * F.col(f"_h{h}")).alias("share"), F.lit(-h).alias("neg")) for h in range(24)])
    peak = F.array_max(hours)
    described = base.select(
        cluster, "stations", "avg_daily", "am_share", "pm_share", "weekend_ratio", "borough_pct",
        (-peak["neg"]).alias("peak_hour"), peak["share"].alias("peak_share"),
    )
    return described.join(series.top_names(rows, [cluster], entity, "avg_daily"), cluster)
