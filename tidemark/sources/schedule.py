"""The static schedule: landed files, valid services per day, scheduled times."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import textfns, timefns
from tidemark.model import LOCAL_ZONE
from tidemark.sources.tables import written_once

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
# Fixed values of exception_type.
ADDED, REMOVED = 1, 2


@dataclass
class Schedule:
    """Relations of the schedule; ``_order`` is the position of a row in its file."""

    trips: DataFrame  # trip_id, service_id
    stop_times: DataFrame  # trip_id, stop_id, arrival_time, _order
    calendar: DataFrame  # service_id, monday … sunday, start_date, end_date, _order
    calendar_dates: DataFrame  # service_id, date, exception_type, _order
    stops: DataFrame  # stop_id, stop_name
    first: DataFrame | None = None  # first_arrivals, once prepared
    services: DataFrame | None = None  # services_by_day, once prepared


def prepare(schedule: Schedule) -> Schedule:
    """Work out the lookups once and keep them in the shared folder, for use by many batches. A schedule that has them stays as it is."""
    if schedule.first and schedule.services:
        return schedule
    return replace(
        schedule,
        first=written_once(first_arrivals(schedule), "first_arrivals"),
        services=written_once(services_by_day(schedule), "services"),
        stops=written_once(schedule.stops, "stops"),
    )


class DailySchedule:
    """A schedule that is loaded and prepared again when the local date changes."""

    def __init__(self, load: Callable[[], Schedule], zone: str = LOCAL_ZONE):
        self.load, self.zone, self.loaded_on = load, ZoneInfo(zone), None

    def current(self) -> Schedule:
        today = dt.datetime.now(self.zone).date()
        if self.loaded_on != today:
            self.schedule, self.loaded_on = prepare(self.load()), today
        return self.schedule


def _read(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    # A byte-order mark may cling to the first column name.
    return df.select(
        *[F.col(f"`{c}`").alias(c.lstrip("﻿").strip()) for c in df.columns],
        F.struct(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row")
        ).alias("_order"),
    )


def load_schedule(spark: SparkSession, folder: str) -> Schedule:
    names = ["trips", "stop_times", "calendar", "calendar_dates", "stops"]
    t = {n: _read(spark, f"{folder}/{n}.txt") for n in names}
    return Schedule(
        t["trips"].select("trip_id", "service_id"),
        t["stop_times"].select("trip_id", "stop_id", "arrival_time", "_order"),
        t["calendar"].select("service_id", *WEEKDAYS, "start_date", "end_date", "_order"),
        t["calendar_dates"].select("service_id", "date", "exception_type", "_order"),
        t["stops"].select("stop_id", "stop_name"),
    )


def first_arrivals(schedule: Schedule) -> DataFrame:
    """Earliest-listed arrival per (service, trip key, stop) in seconds after midnight."""
    # Stored, so that the key is made once and not again in every filter on it.
    keyed = schedule.trips.select("trip_id", "service_id", textfns.static_trip_key("trip_id").alias("trip_key"))
    trips = written_once(keyed, "trip-keys").where("trip_key IS NOT NULL")
    times = schedule.stop_times.where(F.col("arrival_time").isNotNull() & (F.col("arrival_time") != ""))
    return (
        times.join(trips, "trip_id")
        .groupBy("service_id", "trip_key", "stop_id")
        .agg(F.min_by(timefns.clock_seconds("arrival_time"), "_order").alias("seconds"))
    )


def services_by_day(schedule: Schedule) -> DataFrame:
    """(service_id, day, _late, _order): calendar rows by weekday and span, minus removed, plus added.

    Each calendar row is opened into its days, so the range condition becomes
    equality on the day.
    """
    cal = schedule.calendar
    flags = F.array(*[F.col(d).cast("string") for d in WEEKDAYS])
    opened = cal.select(
        "service_id",
        flags.alias("_flags"),
        F.explode(F.sequence(F.to_date("start_date", "yyyyMMdd"), F.to_date("end_date", "yyyyMMdd"))).alias("day"),
        F.col("_order"),
    ).where(F.get("_flags", F.weekday("day")) == "1")
    exceptions = (
        schedule.calendar_dates.groupBy("service_id", F.to_date("date", "yyyyMMdd").alias("day"))
        .agg(F.max_by(F.col("exception_type").cast("int"), "_order").alias("_kind"), F.max("_order").alias("_order"))
    )
    regular = opened.join(exceptions.where(F.col("_kind") == REMOVED), ["service_id", "day"], "left_anti")
    regular = regular.groupBy("service_id", "day").agg(F.min("_order").alias("_order"))
    added = exceptions.where(F.col("_kind") == ADDED).join(regular, ["service_id", "day"], "left_anti")
    return regular.select("service_id", "day", F.lit(0).alias("_late"), "_order").unionByName(
        added.select("service_id", "day", F.lit(1).alias("_late"), "_order")
    )


def scheduled_seconds(keys: DataFrame, schedule: Schedule) -> DataFrame:
    """Seconds of the first valid service that has each (service_day, trip_key, stop_id).

    Only the distinct keys meet the schedule; observations join the result.
    """
    wanted = keys.where("trip_key IS NOT NULL").select("service_day", "trip_key", "stop_id").distinct()
    services = (schedule.services or services_by_day(schedule)).withColumnRenamed("day", "service_day")
    first = schedule.first or first_arrivals(schedule)
    return (
        wanted.join(services, "service_day")
        .join(first, ["service_id", "trip_key", "stop_id"])
        .groupBy("service_day", "trip_key", "stop_id")
        .agg(F.min_by("seconds", F.struct("_late", "_order")).alias("seconds"))
    )
