"""One decoded snapshot to typed records, as column expressions.

Order of processing is the message offset; ``pos`` is the place of an entity in
its message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nested, textfns, timefns
from tidemark.operators.dedup import last_per_key
from tidemark.operators.series import number_slices, previous_row, repeated_flag
from tidemark.sources.schedule import Schedule, scheduled_seconds

# Fixed values of the delay and arrival rules, in seconds.
LATE_SECONDS = 300
MAX_DELAY_SECONDS = 3 * 3600
ARRIVED_WITHIN = 60
STATE_SECONDS = 2 * 3600


def mark_repeated(messages: DataFrame, last_seen: DataFrame | None = None) -> DataFrame:
    """(feed, offset, feed_time, repeated): not newer than any earlier snapshot of the feed.

    Works on three narrow columns. ``last_seen`` (feed, feed_time) is the state
    of earlier batches and enters as one row before the first message.
    """
    slim = messages.select("feed", "offset", "feed_time")
    if last_seen is not None:
        slim = slim.unionByName(last_seen.select("feed", F.lit(-1).cast("bigint").alias("offset"), "feed_time"))
    flagged = repeated_flag(slim, "feed", "feed_time", ["offset"], number_slices("offset"))
    return flagged.where("offset >= 0")


def fresh(messages: DataFrame, marks: DataFrame) -> DataFrame:
    """Messages that are not repeated; joined on the offset, which no feed can skew."""
    return messages.join(marks.where("NOT repeated").select("feed", "offset"), ["feed", "offset"], "left_semi")


def entities(messages: DataFrame) -> DataFrame:
    """One row per entity with its kind: a vehicle first, then a trip update, then an alert."""
    kind = (
        F.when(F.col("entity.vehicle").isNotNull(), "vehicle")
        .when(F.col("entity.trip_update").isNotNull(), "trip_update")
        .when(F.col("entity.alert").isNotNull(), "alert")
    )
    return (
        # Outer, because for the plain form the optimiser puts a test of the array's size, with all that builds it, into the scan.
        messages.select("feed", "feed_time", "offset", F.posexplode_outer("entities").alias("pos", "entity"))
        .where("entity IS NOT NULL")
        .withColumn("kind", kind)
        .withColumn("minute", timefns.minute_floor("feed_time"))
    )


def direction(trip: Column) -> Column:
    """Extension value, else from the trip id, else north."""
    given = trip["direction"]
    from_id = F.when(trip["trip_id"].contains("..S"), "S").otherwise("N")
    return F.when(given.isNotNull(), F.when(given == "SOUTH", "S").otherwise("N")).otherwise(from_id)


def observations(rows: DataFrame) -> DataFrame:
    """Each running trip at its next stop; trips whose predictions are all past are left out."""
    trip = F.col("entity.trip_update.trip")
    upcoming = nested.upcoming(F.col("entity.trip_update.stop_time_update"), F.col("feed_time"))
    next_stop = rows.where("kind = 'trip_update'").withColumn("_next", nested.first_or_null(upcoming)).where("_next IS NOT NULL")
    return next_stop.select(
        "feed",
        "feed_time",
        "offset",
        "pos",
        "minute",
        F.coalesce(trip["trip_id"], F.lit("")).alias("trip_id"),
        trip["route_id"].alias("route_id"),
        trip["start_date"].alias("start_date"),
        direction(trip).alias("direction"),
        F.col("_next.stop_id").alias("stop_id"),
        textfns.stop_code("_next.stop_id").alias("stop"),
        nested.predicted_time(F.col("_next")).alias("predicted"),
        textfns.trip_key(trip["trip_id"]).alias("trip_key"),
        timefns.service_day(F.when(trip["start_date"] != "", trip["start_date"]), F.col("feed_time")).alias("service_day"),
    )


def with_delay(obs: DataFrame, schedule: Schedule) -> DataFrame:
    """``delay_s`` = prediction − schedule; NULL when unknown or beyond three hours."""
    times = scheduled_seconds(obs, schedule)
    joined = obs.join(times, ["service_day", "trip_key", "stop_id"], "left")
    delay = (F.col("predicted") - timefns.service_instant("service_day", "seconds")).cast("double")
    return joined.withColumn("delay_s", F.when(F.abs(delay) <= MAX_DELAY_SECONDS, delay)).drop("seconds")


def stopped(rows: DataFrame) -> DataFrame:
    """Trains standing at a station per minute, route and direction."""
    trip = F.col("entity.vehicle.trip")
    return (
        rows.where((F.col("kind") == "vehicle") & (F.col("entity.vehicle.current_status") == "STOPPED_AT"))
        .groupBy("minute", trip["route_id"].alias("route_id"), direction(trip).alias("direction"))
        .agg(F.count("*").alias("stopped_at"))
    )


def alerts(rows: DataFrame) -> DataFrame:
    """Latest document per alert id."""
    alert = F.col("entity.alert")
    route = lambda i: F.when(F.coalesce(i["route_id"], F.lit("")) != "", i["route_id"]).otherwise(i["trip_route_id"])
    documents = rows.where("kind = 'alert'").select(
        F.col("entity.id").alias("alert_id"),
        nested.first_in_language(alert["header"]).alias("header"),
        nested.sorted_ids(F.transform(alert["informed"], route)).alias("routes"),
        nested.sorted_ids(F.transform(alert["informed"], lambda i: i["trip_id"])).alias("trips"),
        "feed",
        timefns.instant("feed_time").alias("last_seen"),
        "offset",
        "pos",
    )
    return last_per_key(documents, ["alert_id"], ["offset", "pos"]).drop("offset", "pos")


TRIP_STATE = ["trip_id", "stop_id", "predicted", "delay_s", "seen"]


def arrivals(obs: DataFrame, stops: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """A trip reached its previous next stop: the stop changed and its time has come.

    ``obs`` carries ``delay_s``. ``state`` holds the last next stop of each trip
    from earlier batches and stands before the first observation of its trip.
    """
    columns = [c for c in obs.columns]
    rows = obs
    if state is not None:
        before = state.select(
            *[
                F.col(c).alias(c)
                if c in ("trip_id", "stop_id", "predicted", "delay_s")
                else (F.lit(-1) if c in ("offset", "pos") else F.lit(None)).cast(obs.schema[c].dataType).alias(c)
                for c in columns
            ]
        )
        rows = obs.unionByName(before)
    stepped = previous_row(rows, ["trip_id"], ["offset", "pos"], number_slices("offset"), ["stop_id", "predicted", "delay_s"])
    reached = stepped.where(
        (F.col("offset") >= 0) & (F.col("prev.stop_id") != F.col("stop_id")) & (F.col("prev.predicted") <= F.col("feed_time") + ARRIVED_WITHIN)
    )
    documents = reached.select(
        textfns.document_key("start_date", "trip_id", "prev.stop_id").alias("arrival_id"),
        "start_date",
        "trip_id",
        "route_id",
        "direction",
        F.col("prev.stop_id").alias("stop_id"),
        timefns.instant("prev.predicted").alias("arrived_at"),
        F.col("prev.delay_s").alias("delay_s"),
        "feed",
        timefns.instant("feed_time").alias("observed_at"),
        "offset",
        "pos",
    )
    latest = last_per_key(documents, ["arrival_id"], ["offset", "pos"]).drop("offset", "pos")
    return latest.join(stops.select("stop_id", "stop_name"), "stop_id", "left")


def next_trip_state(obs: DataFrame, state: DataFrame | None) -> DataFrame:
    """Last next stop of every trip, trips idle for two hours dropped."""
    now = obs.select("trip_id", "stop_id", "predicted", "delay_s", F.col("feed_time").alias("seen"), "offset", "pos")
    rows = now
    if state is not None:
        rows = now.unionByName(state.select(*TRIP_STATE, F.lit(-1).cast("bigint").alias("offset"), F.lit(-1).alias("pos")))
    latest = last_per_key(rows, ["trip_id"], ["offset", "pos"]).drop("offset", "pos")
    newest = latest.agg(F.max("seen")).scalar()
    return latest.where(F.col("seen") >= newest - STATE_SECONDS).select(*TRIP_STATE)


def next_last_seen(messages: DataFrame, last_seen: DataFrame | None) -> DataFrame:
    rows = messages.select("feed", "feed_time")
    if last_seen is not None:
        rows = rows.unionByName(last_seen.select("feed", "feed_time"))
    return rows.groupBy("feed").agg(F.max("feed_time").alias("feed_time"))


# --- aggregates ---------------------------------------------------------------

MINUTE_KEYS = ["minute", "route_id", "direction"]
MINUTE_SUMS = ["observations", "delay_observations", "late_observations", "sum_delay_s", "stopped_at"]
HOUR_KEYS = ["hour", "stop", "route_id"]
HOUR_SUMS = ["observations", "delay_observations", "sum_delay_s"]


def delay_minute(obs: DataFrame, standing: DataFrame) -> DataFrame:
    """Per minute, route and direction; standing trains alone also make a row."""
    seen = obs.groupBy(*MINUTE_KEYS).agg(
        F.count("*").alias("observations"),
        F.count("delay_s").alias("delay_observations"),
        F.count_if(F.col("delay_s") > LATE_SECONDS).alias("late_observations"),
        F.coalesce(F.sum("delay_s"), F.lit(0.0)).alias("sum_delay_s"),
        F.max("delay_s").alias("max_delay_s"),
    )
    both = seen.join(standing, MINUTE_KEYS, "full")
    return both.select(*MINUTE_KEYS, *[F.coalesce(c, F.lit(0)).alias(c) for c in MINUTE_SUMS], "max_delay_s")


def delay_hourly(obs: DataFrame) -> DataFrame:
    return obs.groupBy(timefns.hour_floor("feed_time").alias("hour"), "stop", "route_id").agg(
        F.count("*").alias("observations"),
        F.count("delay_s").alias("delay_observations"),
        F.coalesce(F.sum("delay_s"), F.lit(0.0)).alias("sum_delay_s"),
    )


def average_delay(minutes: DataFrame) -> DataFrame:
    """Ready-to-read form: the mean from the additive parts, NULL without delays."""
    return minutes.withColumn("avg_delay_s", F.when(F.col("delay_observations") > 0, F.col("sum_delay_s") / F.col("delay_observations")))


def route_delays(obs: DataFrame) -> DataFrame:
    """Median and 90th percentile per route.

    Delays are whole seconds within ±3 h, so a group has at most 21 601
    distinct values and the exact percentile stays small.
    """
    return obs.groupBy("route_id").agg(F.percentile("delay_s", 0.5).alias("median_s"), F.percentile("delay_s", 0.9).alias("p90_s"))


def message_profile(messages: DataFrame) -> DataFrame:
    """One row per message: entities by kind and the irregularities inside."""
    e = F.col("entities")
    trips = F.filter(e, lambda x: x["trip_update"].isNotNull())
    vehicles = F.filter(e, lambda x: x["vehicle"].isNotNull())
    updates = F.flatten(F.transform(trips, lambda x: x["trip_update"]["stop_time_update"]))
    past = lambda u: nested.predicted_time(u) < F.col("feed_time") - nested.PAST_SECONDS
    return messages.select(
        "offset",
        "feed",
        "feed_time",
        F.size(e).alias("entities"),
        F.size(trips).alias("trip_updates"),
        F.size(vehicles).alias("vehicles"),
        F.size(F.filter(e, lambda x: x["alert"].isNotNull())).alias("alerts"),
        F.size(updates).alias("stop_time_updates"),
        F.size(F.filter(trips, lambda x: x["trip_update"]["trip"]["direction"].isNull())).alias("missing_direction"),
        F.size(F.filter(vehicles, lambda x: x["vehicle"]["current_status"].isNull())).alias("missing_status"),
        F.size(F.filter(updates, past)).alias("past_predictions"),
        F.size(F.filter(trips, lambda x: F.forall(x["trip_update"]["stop_time_update"], past))).alias("trips_all_past"),
        F.size(F.filter(trips, lambda x: textfns.trip_key(x["trip_update"]["trip"]["trip_id"]).isNull())).alias("non_standard_ids"),
    )


PROFILE_COUNTS = [
    "entities", "trip_updates", "vehicles", "alerts", "stop_time_updates", "missing_direction",
    "missing_status", "past_predictions", "trips_all_past", "non_standard_ids",
]


def profile_totals(profile: DataFrame) -> DataFrame:
    return profile.groupBy("feed").agg(F.count("*").alias("messages"), *[F.sum(c).alias(c) for c in PROFILE_COUNTS])
