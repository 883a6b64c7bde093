"""Feed messages, schedule, delays, arrivals and streams made from events.

Each event is one snapshot of the feed named by its type, half an hour wide, so
that a feed repeats a time stamp now and then. It carries one trip update with
three predictions, one vehicle and, for errors, one alert. The schedule is made
of the same predictions, so part of the trips meet their planned time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import LOCAL_ZONE
from tidemark.operators import dedup, series
from tidemark.plans import dashboard
from tidemark.session import scratch
from tidemark.sources import feeds
from tidemark.sources.schedule import DailySchedule, Schedule, first_arrivals, services_by_day
from tidemark.sources.tables import exists, rename, set_age, written_once
from tidemark.streaming import keyed, microbatch, records, replay
from tidemark.workload.fixtures import table
from tidemark.workload.registry import query

# Expressions valid in both engines, over user_id, event_type, k, value, feed_time.
_TRIP_ID = (
    "CASE WHEN k < 5 THEN concat('extra-', CAST(user_id AS {text})) ELSE concat(lpad(CAST(user_id AS {text}), 6, '0'), '_', "
    "upper(substr(event_type, 1, 1)), '..', CASE WHEN user_id % 2 = 0 THEN 'N' ELSE 'S' END, CASE WHEN user_id % 3 = 0 THEN '05R' ELSE '' END) END"
)
_ROUTE = "upper(substr(event_type, 1, 1))"
_DIRECTION = "CASE k % 3 WHEN 1 THEN 'NORTH' WHEN 2 THEN 'SOUTH' END"
_STATUS = "CASE k % 4 WHEN 0 THEN 'STOPPED_AT' WHEN 1 THEN 'IN_TRANSIT_TO' WHEN 3 THEN 'INCOMING_AT' END"


def _stop(i) -> str:
    return f"concat(lpad(CAST(CAST(floor(k / 10) AS INT) + {i} AS {{text}}), 3, '0'), 'N')"


def _predicted(i) -> str:
    return f"feed_time + CAST(floor(value) AS BIGINT) - 120 + 40 * {i} + CASE WHEN k % 6 = 0 THEN 200000 ELSE 0 END"


def _planned(i) -> str:
    """Seconds after local midnight; some trips run past it."""
    return f"second_of_day + 40 * {i} + CASE WHEN k % 6 = 0 THEN 100000 ELSE 0 END - CASE WHEN k % 2 = 0 THEN 5 * k ELSE 0 END"


_TEXTS = {"es": "concat('Aviso ', CAST(k AS {text}))", "other": "concat('Notice ', CAST(k AS {text}))"}


def _s(sql: str) -> str:
    return sql.replace("{text}", "STRING")


def _d(sql: str) -> str:
    return sql.replace("{text}", "VARCHAR")


def _base(events: DataFrame) -> DataFrame:
    shifted = F.col("ts") + F.expr("INTERVAL 60 DAY")
    seconds = F.unix_seconds(shifted.cast("timestamp"))
    rows = events.select(
        "event_id", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (seconds - F.pmod(seconds, F.lit(1800))).alias("feed_time"),
    )
    wall = F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), F.timestamp_seconds("feed_time").cast("timestamp_ntz"))
    return rows.withColumn("wall", wall).select(
        "*",
        F.to_date("wall").alias("service_day"),
        (F.hour("wall") * 3600 + F.minute("wall") * 60).alias("second_of_day"),
        F.expr(_s(_TRIP_ID)).alias("trip_id"),
    )


def messages_of(events: DataFrame) -> DataFrame:
    """One message per event, row by row; works on a stream as well."""
    b = _base(events)
    start = F.when(F.col("k") % 4 != 0, F.date_format("service_day", "yyyyMMdd"))
    trip = F.struct(
        F.col("trip_id"), F.expr(_ROUTE).alias("route_id"), start.alias("start_date"), F.expr(_DIRECTION).alias("direction")
    )
    no_arrival = F.col("k") % 10 == 7
    updates = F.array(
        *[
            F.struct(
                F.expr(_s(_stop(i))).alias("stop_id"),
                F.when(~no_arrival, F.expr(_predicted(i))).alias("arrival"),
                F.when(no_arrival, F.expr(_predicted(i))).alias("departure"),
            )
            for i in range(3)
        ]
    )
    none = lambda name: F.lit(None).cast(feeds.ENTITY[name].dataType).alias(name)
    update = F.struct(F.lit("t").alias("id"), none("vehicle"), F.struct(trip.alias("trip"), updates.alias("stop_time_update")).alias("trip_update"), none("alert"))
    vehicle = F.struct(F.lit("v").alias("id"), F.struct(trip.alias("trip"), F.expr(_STATUS).alias("current_status")).alias("vehicle"), none("trip_update"), none("alert"))
    spanish = F.struct(F.expr(_s(_TEXTS["es"])).alias("text"), F.lit("es").alias("language"))
    other = F.struct(F.expr(_s(_TEXTS["other"])).alias("text"), F.when(F.col("k") % 9 == 0, "fr").when(F.col("k") % 2 == 0, "en").otherwise("").alias("language"))
    informed = F.array(
        F.struct(F.when(F.col("k") % 2 == 0, F.expr(_ROUTE)).otherwise("").alias("route_id"), F.lit("X").alias("trip_route_id"), F.col("trip_id").alias("trip_id")),
        F.struct(F.lit("B").alias("route_id"), F.lit("").alias("trip_route_id"), F.lit("").alias("trip_id")),
    )
    alert = F.struct(
        F.concat(F.lit("alert-"), F.col("user_id").cast("string")).alias("id"), none("vehicle"), none("trip_update"),
        F.struct(F.array(spanish, other).alias("header"), informed.alias("informed")).alias("alert"),
    )
    entities = F.when(F.col("event_type") == "error", F.array(update, vehicle, alert)).otherwise(F.array(update, vehicle))
    return b.select(F.col("event_type").alias("feed"), "feed_time", F.col("event_id").alias("offset"), entities.cast(feeds.MESSAGE["entities"].dataType).alias("entities"))


def messages(spark, sf):
    return messages_of(table(spark, sf, "events"))


_SERVICE = "CASE WHEN isodow(service_day) < 6 THEN 'WKD' WHEN isodow(service_day) = 6 THEN 'SAT' ELSE 'SUN' END"


def schedule(spark, sf) -> Schedule:
    """A schedule of three services out of the same events."""
    weekday = F.weekday("service_day")
    service = F.when(weekday < 5, "WKD").when(weekday == 5, "SAT").otherwise("SUN")
    b = _base(table(spark, sf, "events")).withColumn("service_id", service).withColumn("trip_id", F.concat_ws("_", "service_id", "trip_id"))
    # Every relation below reads these columns; making them takes most of a pass over the events.
    b = written_once(b.select("event_id", "k", "second_of_day", "service_day", "service_id", "trip_id"), "planned")
    trips = b.select("trip_id", "service_id").distinct()
    planned = b.select(
        "event_id",
        "trip_id",
        F.posexplode(F.array(*[F.struct(F.expr(_s(_stop(i))).alias("stop_id"), F.expr(_planned(i)).cast("int").alias("t")) for i in range(3)])).alias("i", "p"),
    )
    t = F.greatest(F.col("p.t"), F.lit(0))
    two = lambda c: F.concat(F.when(c < 10, "0").otherwise(""), c.cast("string"))
    clock = F.concat_ws(":", two(F.floor(t / 3600).cast("int")), two(F.floor(F.pmod(t, F.lit(3600)) / 60).cast("int")), two(F.pmod(t, F.lit(60))))
    # One number, events in order and a missing id first: the least one of a group is kept in place, that of a struct only by sorting all rows.
    order = F.coalesce(F.col("event_id").cast("decimal(20,0)"), F.expr("-10000000000000000000")) * 3 + F.col("i")
    stop_times = planned.select("trip_id", F.col("p.stop_id").alias("stop_id"), clock.alias("arrival_time"), order.alias("_order"))
    days = b.groupBy("service_id", "service_day").agg(F.count("*").alias("n"))
    text = lambda c: F.date_format(c, "yyyyMMdd")
    calendar = days.groupBy("service_id").agg(F.min("service_day").alias("a"), F.max("service_day").alias("b")).select(
        "service_id",
        *[F.when(F.col("service_id") == "WKD", "1").otherwise("0").alias(d) for d in ("monday", "tuesday", "wednesday", "thursday", "friday")],
        F.when(F.col("service_id") == "SAT", "1").otherwise("0").alias("saturday"),
        F.when(F.col("service_id") == "SUN", "1").otherwise("0").alias("sunday"),
        text("a").alias("start_date"),
        text("b").alias("end_date"),
        F.struct(F.lit(0).alias("event_id"), F.col("service_id").alias("i")).alias("_order"),
    )
    # The busiest weekday runs the Sunday service instead.
    busiest = days.where("service_id = 'WKD'").agg(F.max_by("service_day", F.struct("n", "service_day")).alias("d"))
    exceptions = busiest.select(text("d").alias("date"), F.explode(F.array(F.struct(F.lit("WKD").alias("service_id"), F.lit(2).alias("kind")), F.struct(F.lit("SUN").alias("service_id"), F.lit(1).alias("kind")))).alias("x"))
    calendar_dates = exceptions.select("x.service_id", "date", F.col("x.kind").alias("exception_type"), F.struct(F.lit(1).alias("event_id"), F.col("x.service_id").alias("i")).alias("_order"))
    stops = planned.select(F.col("p.stop_id").alias("stop_id")).distinct().where("stop_id <> '000N'").select("stop_id", F.concat(F.lit("Stop "), F.substring("stop_id", 1, 3)).alias("stop_name"))
    return Schedule(trips, stop_times, calendar, calendar_dates, stops)


# --- SQL twins ------------------------------------------------------------------

_BASE = f"""base0 AS (SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k,
  CAST(floor(epoch(ts + INTERVAL 60 DAY) / 1800) AS BIGINT) * 1800 AS feed_time FROM events),
base1 AS (SELECT *, to_timestamp(feed_time) AT TIME ZONE '{LOCAL_ZONE}' AS wall FROM base0),
base AS (SELECT *, CAST(wall AS DATE) AS service_day, hour(wall) * 3600 + minute(wall) * 60 AS second_of_day, {_d(_TRIP_ID)} AS trip_id, {_ROUTE} AS route_id,
  CASE WHEN k % 4 <> 0 THEN strftime(wall, '%Y%m%d') END AS start_date, {_DIRECTION} AS dir, {_STATUS} AS status FROM base1),
marks AS (SELECT *, feed_time <= coalesce(max(feed_time) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS repeated FROM base),
fresh AS (SELECT *, CASE WHEN dir IS NOT NULL THEN CASE WHEN dir = 'SOUTH' THEN 'S' ELSE 'N' END WHEN contains(trip_id, '..S') THEN 'S' ELSE 'N' END AS direction,
  nullif(regexp_extract(trip_id, '^(\\d{{6}}_[^.]+\\.\\.[NS])', 1), '') AS trip_key FROM marks WHERE NOT repeated),
steps(i) AS (VALUES (0), (1), (2)),
pred AS (SELECT fresh.*, i, {_d(_stop('i'))} AS stop_id, {_predicted('i')} AS predicted FROM fresh, steps),
obs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY i) AS rn FROM pred WHERE predicted >= feed_time - 30) WHERE rn = 1)"""

_SCHEDULE = f"""srv AS (SELECT *, {_SERVICE} AS service_id FROM base),
times AS (SELECT service_id, nullif(regexp_extract(trip_id, '^(\\d{{6}}_[^.]+\\.\\.[NS])', 1), '') AS trip_key, {_d(_stop('i'))} AS stop_id,
  greatest({_planned('i')}, 0) AS t, event_id, i FROM srv, steps),
first_times AS (SELECT service_id, trip_key, stop_id, CAST(arg_min(t, (event_id, i)) AS INT) AS seconds FROM times WHERE trip_key IS NOT NULL GROUP BY 1, 2, 3),
srv_days AS (SELECT service_id, service_day, count(*) AS n FROM srv GROUP BY 1, 2),
spans AS (SELECT service_id, min(service_day) AS a, max(service_day) AS b FROM srv_days GROUP BY 1),
busiest AS (SELECT service_day AS d FROM srv_days WHERE service_id = 'WKD' ORDER BY n DESC, service_day DESC LIMIT 1),
cal AS (SELECT service_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS service_day FROM spans),
valid AS (SELECT service_id, service_day, 0 AS late FROM cal WHERE {_SERVICE} = service_id AND NOT (service_id = 'WKD' AND service_day = (SELECT d FROM busiest))
  UNION ALL SELECT 'SUN', d, 1 FROM busiest),
planned AS (SELECT valid.service_day, trip_key, stop_id, arg_min(seconds, (late, service_id)) AS seconds FROM first_times JOIN valid USING (service_id) GROUP BY 1, 2, 3),
delayed0 AS (SELECT obs.*, predicted - epoch((CAST(service_day AS TIMESTAMP) + to_seconds(seconds)) AT TIME ZONE '{LOCAL_ZONE}') AS d FROM obs LEFT JOIN planned USING (service_day, trip_key, stop_id)),
delayed AS (SELECT *, to_timestamp(feed_time - feed_time % 60) AT TIME ZONE 'UTC' AS minute, CASE WHEN abs(d) <= 10800 THEN CAST(d AS DOUBLE) END AS delay_s FROM delayed0)"""

_ARRIVALS = """steps2 AS (SELECT *, lag(stop_id) OVER w AS prev_stop, lag(predicted) OVER w AS prev_pred, lag(delay_s) OVER w AS prev_delay FROM delayed WINDOW w AS (PARTITION BY trip_id ORDER BY event_id)),
reached AS (SELECT *, coalesce(start_date, '') || '|' || trip_id || '|' || prev_stop AS arrival_id FROM steps2 WHERE prev_stop <> stop_id AND prev_pred <= feed_time + 60),
arrivals AS (SELECT arrival_id, trip_id, route_id, direction, prev_stop AS stop_id, CASE WHEN prev_stop <> '000N' THEN 'Stop ' || substr(prev_stop, 1, 3) END AS stop_name,
  to_timestamp(prev_pred) AT TIME ZONE 'UTC' AS arrived_at, prev_delay AS delay_s, event_type AS feed, to_timestamp(feed_time) AT TIME ZONE 'UTC' AS observed_at
  FROM (SELECT *, row_number() OVER (PARTITION BY arrival_id ORDER BY event_id DESC) AS last FROM reached) WHERE last = 1)"""

_ALERTS = f"""alerts AS (SELECT 'alert-' || CAST(user_id AS VARCHAR) AS alert_id, CASE WHEN k % 9 = 0 THEN '' ELSE {_d(_TEXTS['other'])} END AS header,
  array_to_string(list_sort(list_distinct([CASE WHEN k % 2 = 0 THEN route_id ELSE 'X' END, 'B'])), ',') AS routes, trip_id AS trips, event_type AS feed, to_timestamp(feed_time) AT TIME ZONE 'UTC' AS last_seen
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS last FROM fresh WHERE event_type = 'error') WHERE last = 1)"""

_MINUTE = """standing AS (SELECT to_timestamp(feed_time - feed_time % 60) AT TIME ZONE 'UTC' AS minute, route_id, direction, count(*) AS stopped_at FROM fresh WHERE status = 'STOPPED_AT' GROUP BY 1, 2, 3),
seen AS (SELECT minute, route_id, direction, count(*) AS observations, count(delay_s) AS delay_observations, count(*) FILTER (delay_s > 300) AS late_observations, coalesce(sum(delay_s), 0) AS sum_delay_s, max(delay_s) AS max_delay_s FROM delayed GROUP BY 1, 2, 3),
minutes AS (SELECT minute, route_id, direction, coalesce(observations, 0) AS observations, coalesce(delay_observations, 0) AS delay_observations, coalesce(late_observations, 0) AS late_observations,
  coalesce(sum_delay_s, 0) AS sum_delay_s, coalesce(stopped_at, 0) AS stopped_at, max_delay_s FROM seen FULL JOIN standing USING (minute, route_id, direction))"""

_HOURS = """hours AS (SELECT to_timestamp(feed_time - feed_time % 3600) AT TIME ZONE 'UTC' AS hour, substr(stop_id, 1, 3) AS stop, route_id, count(*) AS observations, count(delay_s) AS delay_observations, coalesce(sum(delay_s), 0) AS sum_delay_s FROM delayed GROUP BY 1, 2, 3)"""

OBS = f"WITH {_BASE}"
DELAYED = f"{OBS}, {_SCHEDULE}"


def local(df: DataFrame) -> DataFrame:
    """Instants as UTC wall clock, the form the twins return."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else c for c, t in df.dtypes])


def results(spark, sf):
    return replay.run(messages(spark, sf), schedule(spark, sf))


# --- batch forms ------------------------------------------------------------------


@query("repeated_snapshots", "T03 W04", f"{OBS} SELECT event_type AS feed, event_id AS \"offset\", feed_time, repeated FROM marks")
def _(spark, sf):
    return records.mark_repeated(messages(spark, sf))


@query(
    "next_stops",
    "T02 T04 T05 L02 D07 D12 F04 F05 F07",
    f"{OBS} SELECT event_id AS \"offset\", trip_id, route_id, direction, stop_id, substr(stop_id, 1, 3) AS stop, predicted, trip_key, service_day, to_timestamp(feed_time - feed_time % 60) AT TIME ZONE 'UTC' AS minute FROM obs",
)
def _(spark, sf):
    m = messages(spark, sf)
    obs = records.observations(records.entities(records.fresh(m, records.mark_repeated(m))))
    return local(obs.select("offset", "trip_id", "route_id", "direction", "stop_id", "stop", "predicted", "trip_key", "service_day", "minute"))


@query("schedule_first_arrivals", "S06 J13 D08", f"WITH {_BASE}, {_SCHEDULE} SELECT * FROM first_times")
def _(spark, sf):
    return first_arrivals(schedule(spark, sf))


@query("services_by_day", "J12", f"WITH {_BASE}, {_SCHEDULE} SELECT service_id, service_day AS day, late FROM valid")
def _(spark, sf):
    return services_by_day(schedule(spark, sf)).select("service_id", "day", F.col("_late").alias("late"))


@query("trip_delays", "T07 J12 D09 N01", f"{DELAYED} SELECT event_id AS \"offset\", trip_id, stop_id, predicted, delay_s FROM delayed")
def _(spark, sf):
    return results(spark, sf)["observations"].select("offset", "trip_id", "stop_id", "predicted", "delay_s")


@query("trip_arrivals", "T08 F08 J14", f"{DELAYED}, {_ARRIVALS} SELECT * FROM arrivals")
def _(spark, sf):
    return local(results(spark, sf)["arrivals"].drop("start_date"))


@query("alert_documents", "T09 L03 L04", f"{OBS}, {_ALERTS} SELECT * FROM alerts")
def _(spark, sf):
    a = results(spark, sf)["alerts"]
    return local(a.withColumn("routes", F.array_join("routes", ",")).withColumn("trips", F.array_join("trips", ",")))


@query("stopped_trains", "T06", f"{DELAYED}, {_MINUTE} SELECT * FROM standing")
def _(spark, sf):
    return local(records.stopped(results(spark, sf)["rows"]))


@query("delay_by_minute", "A48 T10", f"{DELAYED}, {_MINUTE} SELECT * FROM minutes")
def _(spark, sf):
    return local(results(spark, sf)["minute"])


@query("delay_by_hour", "A49 T11", f"{DELAYED}, {_HOURS} SELECT * FROM hours")
def _(spark, sf):
    return local(results(spark, sf)["hour"])


@query(
    "average_delay",
    "A50 N03",
    f"{DELAYED}, {_MINUTE} SELECT minute, route_id, direction, observations, CASE WHEN delay_observations > 0 THEN round(sum_delay_s / delay_observations, 6) END AS avg_delay_s FROM minutes",
)
def _(spark, sf):
    a = records.average_delay(results(spark, sf)["minute"])
    return local(a.select("minute", "route_id", "direction", "observations", F.round("avg_delay_s", 6).alias("avg_delay_s")))


@query(
    "latest_delays",
    "V07 A50 O04",
    f"""{DELAYED}, {_MINUTE} SELECT route_id, CAST(sum(observations) AS BIGINT) AS observations, round(sum(sum_delay_s) / nullif(sum(delay_observations), 0), 6) AS avg_delay_s,
    round(100.0 * sum(late_observations) / nullif(sum(delay_observations), 0), 6) AS late_pct, CAST(sum(stopped_at) AS BIGINT) AS stopped_at FROM minutes WHERE minute > (SELECT max(minute) FROM minutes) - INTERVAL 1440 MINUTE GROUP BY 1""",
)
def _(spark, sf):
    d = dashboard.latest_delays(results(spark, sf)["minute"], last_minutes=1440)
    return d.select("route_id", "observations", F.round("avg_delay_s", 6).alias("avg_delay_s"), F.round("late_pct", 6).alias("late_pct"), "stopped_at")


@query("route_delay_quantiles", "A51", f"{DELAYED} SELECT route_id, round(quantile_cont(delay_s, 0.5), 6) AS median_s, round(quantile_cont(delay_s, 0.9), 6) AS p90_s FROM delayed GROUP BY 1")
def _(spark, sf):
    d = records.route_delays(results(spark, sf)["observations"])
    return d.select("route_id", F.round("median_s", 6).alias("median_s"), F.round("p90_s", 6).alias("p90_s"))


@query("latest_arrivals", "V08 O04", f"{DELAYED}, {_ARRIVALS} SELECT arrival_id, stop_id, observed_at FROM arrivals ORDER BY observed_at DESC, arrival_id LIMIT 20")
def _(spark, sf):
    a = results(spark, sf)["arrivals"].select("arrival_id", "stop_id", "observed_at")
    return local(dashboard.newest_documents(a, "observed_at", 20, "arrival_id"))


@query(
    "message_profile",
    "A52 L02",
    f"""{OBS}, p AS (SELECT base.*, i, {_predicted('i')} < feed_time - 30 AS past FROM base, steps), m AS (SELECT event_id, count(*) FILTER (past) AS past, bool_and(past) AS all_past FROM p GROUP BY 1)
    SELECT event_type AS feed, count(*) AS messages, CAST(sum(CASE WHEN event_type = 'error' THEN 3 ELSE 2 END) AS BIGINT) AS entities, count(*) AS trip_updates, count(*) AS vehicles, count(*) FILTER (event_type = 'error') AS alerts,
    3 * count(*) AS stop_time_updates, count(*) FILTER (dir IS NULL) AS missing_direction, count(*) FILTER (status IS NULL) AS missing_status, CAST(sum(past) AS BIGINT) AS past_predictions,
    count(*) FILTER (all_past) AS trips_all_past, count(*) FILTER (NOT regexp_matches(trip_id, '^(\\d{{6}}_[^.]+\\.\\.[NS])')) AS non_standard_ids FROM base JOIN m USING (event_id) GROUP BY 1""",
)
def _(spark, sf):
    return records.profile_totals(records.message_profile(messages(spark, sf)))


@query(
    "stream_checks",
    "T17",
    f"""{DELAYED}, {_MINUTE}, {_ARRIVALS}, o AS (SELECT count(*) AS n, count(DISTINCT event_id) AS messages, bool_and(direction IN ('N', 'S')) AS directions,
    bool_and(coalesce(route_id, '') <> '' AND coalesce(substr(stop_id, 1, 3), '') <> '') AS labels, coalesce(max(abs(delay_s)) <= 10800, true) AS bounds FROM delayed),
    running AS (SELECT count(DISTINCT event_id) AS n FROM pred WHERE predicted >= feed_time - 30)
    SELECT 'one observation per running trip' AS "check", o.n = running.n AND o.n = o.messages AS passed FROM o, running UNION ALL SELECT 'directions are N or S', directions FROM o
    UNION ALL SELECT 'route and stop present', labels FROM o UNION ALL SELECT 'delays within three hours', bounds FROM o
    UNION ALL SELECT 'late <= with delay <= observed', bool_and(late_observations <= delay_observations AND delay_observations <= observations) FROM minutes
    UNION ALL SELECT 'arrival ids unique', count(*) = count(DISTINCT arrival_id) FROM arrivals""",
)
def _(spark, sf):
    return replay.stream_checks(results(spark, sf), records.message_profile(messages(spark, sf)))


@query("offset_window", "S08", "SELECT event_type AS feed, event_id AS \"offset\" FROM events WHERE event_id >= (SELECT CAST(max(event_id) / 4 AS BIGINT) FROM events) AND event_id < (SELECT CAST(max(event_id) / 2 AS BIGINT) FROM events)")
def _(spark, sf):
    m = messages(spark, sf)
    quarter, half = (m.agg(F.round(F.max("offset") / n).cast("bigint")).scalar() for n in (4, 2))
    return feeds.offset_range(m, quarter, half).select("feed", "offset")


@query(
    "encoded_round_trip",
    "S09 T02",
    f"{OBS} SELECT event_type AS feed, feed_time, CAST(CASE WHEN event_type = 'error' THEN 3 ELSE 2 END AS INT) AS entities, trip_id FROM base",
)
def _(spark, sf):
    """Messages written as keyed records with a header, landed and decoded again."""
    path = scratch(spark, "records")
    feeds.write_records(feeds.encode(messages(spark, sf)), "parquet", path=path)
    back = feeds.decode(spark.read.parquet(path).withColumn("offset", F.lit(0).cast("bigint")))
    return back.select("feed", "feed_time", F.size("entities").alias("entities"), F.get("entities", F.lit(0))["trip_update"]["trip"]["trip_id"].alias("trip_id"))


# --- streams ------------------------------------------------------------------------

#: Files the events are landed in, files of one micro-batch, and files that are there before the queries stop and start again.
FILES, PER_BATCH, BEFORE_RESTART = 20, 5, 10
#: Bytes of a row group of a landed file.
ROW_GROUP = 4 << 20
#: Least partitions of the state, and events for each further one.
STATE_PARTITIONS, STATE_EVENTS = 4, 500_000
_FILE = f"event_id * {FILES} // ((SELECT max(event_id) FROM events) + 1)"


def landed_files(spark, sf, path: str) -> list[str]:
    """The events as one file for each of ``FILES`` ranges of ids, beside the folder that the stream reads."""
    events = table(spark, sf, "events")
    end = events.agg(F.max("event_id") + 1).scalar()
    parts = events.withColumn("part", F.floor(F.col("event_id") * FILES / end).cast("int"))
    # Small row groups, so that a batch's few files are read by more tasks than there are files.
    parts.repartition("part").write.option("parquet.block.size", ROW_GROUP).partitionBy("part").parquet(f"{path}/aside")
    return [f"part={k}" for k in range(FILES) if exists(spark, f"{path}/aside/part={k}")]


def land_files(spark, path: str, names: list[str]) -> None:
    """Let files appear in the stream's folder one after another; each is younger than the one before."""
    for name in names:
        rename(spark, f"{path}/aside/{name}", f"{path}/in/{name}")
        set_age(spark, f"{path}/in/{name}", int(name.partition("=")[2]))


def state_partitions(events: int) -> int:
    """Trips grow with the events, and all facts pass the tasks that hold the state."""
    return max(STATE_PARTITIONS, -(-events // STATE_EVENTS))


def prepared(spark, sf) -> Schedule:
    """The schedule with its lookups made, for all starts of the landing query."""
    return DailySchedule(lambda: schedule(spark, sf)).current()


def run_stream(spark, sf, *queries: str, plan: Schedule | None = None) -> microbatch.BatchStore:
    """The whole events table through the landing query and the named others, with a restart of all of them in between."""
    root = scratch(spark, "delays")
    partitions = state_partitions(table(spark, sf, "events").count())
    names = landed_files(spark, sf, root)
    store = microbatch.BatchStore(spark, f"{root}/store")
    plan = plan or prepared(spark, sf)
    events = feeds.file_stream(spark, f"{root}/in/part=*", table(spark, sf, "events").schema, PER_BATCH)
    with keyed.logged(spark, f"{root}/progress"):
        for step in (names[:BEFORE_RESTART], names[BEFORE_RESTART:]):
            land_files(spark, root, step)
            keyed.start_landing(events, store, lambda: plan, f"{root}/landing", every=None, read=messages_of).awaitTermination()
            for name in queries:
                facts = keyed.fact_stream(spark, store.path)
                if name == "arrivals":
                    query = keyed.start_arrivals(facts, store, plan.stops, f"{root}/{name}", every=None, live_seconds=None, partitions=partitions)
                else:
                    query = keyed.start_totals(name, facts, store, f"{root}/{name}", every=None, partitions=partitions)
                query.awaitTermination()
    return store


@query("stream_minute_totals", "T01 T10 T12 S07 S18 S19", f"{DELAYED}, {_MINUTE} SELECT * FROM minutes")
def _(spark, sf):
    return local(keyed.newest(run_stream(spark, sf, "minutes"), "minutes"))


@query("stream_hour_totals", "T11 S18", f"{DELAYED}, {_HOURS} SELECT * FROM hours")
def _(spark, sf):
    return local(keyed.newest(run_stream(spark, sf, "hours"), "hours"))


@query("stream_arrivals", "T08 T14 S17", f"{DELAYED}, {_ARRIVALS} SELECT * FROM arrivals")
def _(spark, sf):
    return local(keyed.newest(run_stream(spark, sf, "arrivals"), "arrivals").drop("start_date"))


_BATCHED = f"""batched AS (SELECT *, CAST({_FILE} // {PER_BATCH} AS INT) AS batch_id FROM marks)"""


@query(
    "stream_batch_log",
    "T13 S23",
    f"""{OBS}, {_BATCHED} SELECT batch_id, count(*) AS messages, count(*) FILTER (repeated) AS skipped, min(event_id) AS offset_from, max(event_id) AS offset_to,
    min(feed_time) FILTER (NOT repeated) AS feed_time_from, max(feed_time) FILTER (NOT repeated) AS feed_time_to FROM batched GROUP BY 1""",
)
def _(spark, sf):
    return run_stream(spark, sf).batch_log().drop("processed_at", "seconds").withColumn("batch_id", F.col("batch_id").cast("int"))


@query("stream_progress", "T13", f"""{OBS}, {_BATCHED} SELECT 'landing' AS "query", batch_id, count(*) AS input_rows FROM batched GROUP BY 2""")
def _(spark, sf):
    """What the engine itself reported about each batch, from its listener."""
    store = run_stream(spark, sf)
    rows = keyed.progress(spark, f"{store.path.removesuffix('/store')}/progress").where("input_rows > 0")
    return rows.select("query", F.col("batch_id").cast("int").alias("batch_id"), "input_rows")


@query("replay_parity", "T15 T16 J05", f"{DELAYED}, {_MINUTE}, f AS (SELECT DISTINCT minute FROM minutes), e AS (SELECT * FROM minutes WHERE minute > (SELECT max(minute) FROM (SELECT minute FROM f ORDER BY minute LIMIT 2)) AND minute < (SELECT min(minute) FROM (SELECT minute FROM f ORDER BY minute DESC LIMIT 2))) SELECT minute, count(*) AS keys, CAST(0 AS BIGINT) AS different, true AS \"equal\" FROM e GROUP BY 1")
def _(spark, sf):
    """Batch replay against the stored stream on complete minutes."""
    plan = prepared(spark, sf)
    # The edges of the window and both sides of the comparison read the replayed totals.
    replayed = written_once(replay.run(messages(spark, sf), plan)["minute"], "minutes")
    compared = replay.compare_minutes(replayed, keyed.newest(run_stream(spark, sf, "minutes", plan=plan), "minutes"))
    return local(replay.minute_summary(compared))
