"""Replay of recorded messages through the batch form, and its parity with the stream."""

from __future__ import annotations

from functools import cached_property, reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.compare import tolerant_compare
from tidemark.sources.feeds import offset_range
from tidemark.sources.schedule import Schedule
from tidemark.sources.tables import written_once
from tidemark.streaming import records


def replay(messages: DataFrame, schedule: Schedule, prime: tuple[int, int], window: tuple[int, int]) -> Results:
    """Process a window of offsets after priming the state with earlier ones."""
    earlier = offset_range(messages, *prime)
    obs0 = records.with_delay(records.observations(records.entities(records.fresh(earlier, records.mark_repeated(earlier)))), schedule)
    return run(offset_range(messages, *window), schedule, records.next_last_seen(earlier, None), records.next_trip_state(obs0, None))


class Results:
    """All results of a set of messages as relations, each made when it is asked for.

    Messages are taken apart once, and observations meet the schedule once: both
    are written to the shared folder, and every result starts from there.
    """

    def __init__(self, messages: DataFrame, schedule: Schedule, last_seen: DataFrame | None, trips: DataFrame | None):
        self._messages, self._schedule, self._last_seen, self._trips = messages, schedule, last_seen, trips

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def marks(self) -> DataFrame:
        return records.mark_repeated(self._messages, self._last_seen)

    @cached_property
    def rows(self) -> DataFrame:
        return written_once(records.entities(records.fresh(self._messages, self.marks)), "entities")

    @cached_property
    def observations(self) -> DataFrame:
        return written_once(records.with_delay(records.observations(self.rows), self._schedule), "observations")

    @cached_property
    def minute(self) -> DataFrame:
        return records.delay_minute(self.observations, records.stopped(self.rows))

    @cached_property
    def hour(self) -> DataFrame:
        return records.delay_hourly(self.observations)

    @cached_property
    def arrivals(self) -> DataFrame:
        return records.arrivals(self.observations, self._schedule.stops, self._trips)

    @cached_property
    def alerts(self) -> DataFrame:
        return records.alerts(self.rows)


def run(messages: DataFrame, schedule: Schedule, last_seen: DataFrame | None = None, trips: DataFrame | None = None) -> Results:
    return Results(messages, schedule, last_seen, trips)


def full_minutes(minutes: DataFrame, edge: int = 2) -> DataFrame:
    """Distinct minutes without the first and last ``edge``, which a cut window holds in part.

    The edges are found with two short top-k scans instead of ranking all minutes.
    """
    distinct = minutes.select("minute").distinct()
    first = distinct.orderBy("minute").limit(edge).agg(F.max("minute")).scalar()
    last = distinct.orderBy(F.desc("minute")).limit(edge).agg(F.min("minute")).scalar()
    return distinct.where((F.col("minute") > first) & (F.col("minute") < last))


def compare_minutes(replayed: DataFrame, stored: DataFrame) -> DataFrame:
    """Keys of complete minutes with a difference flag; sums may differ by rounding."""
    minutes = full_minutes(replayed)
    tolerances = {c: 1e-6 if c == "sum_delay_s" else 0 for c in records.MINUTE_SUMS}
    a, b = (df.join(minutes, "minute", "left_semi") for df in (replayed, stored))
    return tolerant_compare(a, b, records.MINUTE_KEYS, tolerances)


def minute_summary(compared: DataFrame) -> DataFrame:
    return compared.groupBy("minute").agg(
        F.count("*").alias("keys"), F.count_if("different").alias("different"), (F.count_if("different") == 0).alias("equal")
    )


def arrivals_found(replayed: DataFrame, stored: DataFrame, minutes: DataFrame) -> DataFrame:
    """How many replayed arrivals of complete minutes the store holds."""
    wanted = replayed.withColumn("minute", F.date_trunc("minute", "observed_at")).join(minutes, "minute", "left_semi")
    hit = wanted.join(stored.select("arrival_id", F.lit(1).alias("_hit")), "arrival_id", "left")
    return hit.agg(F.count("*").alias("expected"), F.count("_hit").alias("found"))


def stream_checks(results: Results, profile: DataFrame) -> DataFrame:
    """(check, passed) before aggregated results may be compared with the store."""
    obs, minute, arrivals, marks = results["observations"], results["minute"], results["arrivals"], results["marks"]
    used = profile.join(marks.where("NOT repeated").select("feed", "offset"), ["feed", "offset"], "left_semi")
    running = used.agg(F.sum(F.col("trip_updates") - F.col("trips_all_past"))).scalar()
    o = obs.agg(
        F.count("*").alias("n"),
        F.bool_and(F.col("direction").isin("N", "S")).alias("directions"),
        F.bool_and((F.coalesce("route_id", F.lit("")) != "") & (F.coalesce("stop", F.lit("")) != "")).alias("labels"),
        F.coalesce(F.max(F.abs("delay_s")) <= records.MAX_DELAY_SECONDS, F.lit(True)).alias("bounds"),
    )
    ordered = reduce(
        and_, [F.col("late_observations") <= F.col("delay_observations"), F.col("delay_observations") <= F.col("observations")]
    )
    checks = {
        "one observation per running trip": F.col("n") == running,
        "directions are N or S": F.col("directions"),
        "route and stop present": F.col("labels"),
        "delays within three hours": F.col("bounds"),
        "late <= with delay <= observed": minute.agg(F.bool_and(ordered)).scalar(),
        "arrival ids unique": arrivals.agg(F.count("*") == F.count_distinct("arrival_id")).scalar(),
    }
    wide = o.select(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()])
    return wide.unpivot([], list(checks), "check", "passed")
