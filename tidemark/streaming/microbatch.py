"""The micro-batch job: messages to delay aggregates, arrivals and alerts.

Every output of a batch goes to its own folder ``batch_id=N``, and the state a
batch starts from is the one written by the batch before it. Running a batch
again therefore rewrites the same folders with the same rows: additive results
count each batch exactly once without a transaction, and the state survives a
restart. Readers take only batches whose log row, the last output, is there, so
they see all of a batch or nothing. Nothing is collected to the driver.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.operators.dedup import last_per_key
from tidemark.operators.upsert import retain_days
from tidemark.sources.schedule import DailySchedule, Schedule
from tidemark.sources.tables import committed, remove
from tidemark.streaming import records

STATE_SCHEMAS = {
    "feeds": "feed string, feed_time bigint",
    "trips": "trip_id string, stop_id string, predicted bigint, delay_s double, seen bigint",
}

#: Batches between two upkeep runs; it bounds the folders that a batch or a reader lists.
UPKEEP_EVERY = 20
#: Days that minute totals and the batch log are kept. Hour totals stay.
KEPT_DAYS = 14

# By table: keys, sums and maxima of additive totals; keys of documents; the time that retention goes by.
TOTALS = {
    "minute": (records.MINUTE_KEYS, records.MINUTE_SUMS, ["max_delay_s"]),
    "hour": (records.HOUR_KEYS, records.HOUR_SUMS, []),
}
DOCUMENTS = {"arrivals": ["arrival_id"], "alerts": ["alert_id"]}
RETAINED = {"minute": "minute", "log": "processed_at"}


class BatchStore:
    """Folders ``<table>/batch_id=N`` below one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, table: str, batch_id: int, df: DataFrame) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{table}/batch_id={batch_id}")

    def _folders(self, table: str) -> list[int]:
        return committed(self.spark, f"{self.path}/{table}", "batch_id")

    def _base(self, table: str) -> int | None:
        """Number of the last batch the folded rows of a table contain."""
        found = committed(self.spark, f"{self.path}/{table}_base", "upto")
        return found[-1] if found else None

    def batches(self, table: str) -> list[int]:
        """Batches of a table whose log row is committed; it is written last, so all their outputs are there."""
        logged, folded = set(self._folders("log")), self._base("log")
        return [n for n in self._folders(table) if n in logged or (folded is not None and n <= folded)]

    def state(self, table: str, batch_id: int) -> DataFrame:
        """State as the newest batch before ``batch_id`` left it."""
        earlier = [n for n in self.batches(table) if n < batch_id]
        if not earlier:
            return self.spark.createDataFrame([], STATE_SCHEMAS[table])
        return self.spark.read.schema(STATE_SCHEMAS[table]).parquet(f"{self.path}/{table}/batch_id={earlier[-1]}")

    def read(self, table: str, upto: int | None = None) -> DataFrame:
        """Folded rows and those of every later committed batch, with ``batch_id``."""
        base = self._base(table)
        later = [n for n in self.batches(table) if (base is None or n > base) and (upto is None or n <= upto)]
        parts = []
        if base is not None:
            parts.append(self.spark.read.parquet(f"{self.path}/{table}_base/upto={base}"))
        if later:
            paths = [f"{self.path}/{table}/batch_id={n}" for n in later]
            parts.append(self.spark.read.option("basePath", f"{self.path}/{table}").parquet(*paths))
        if not parts:
            raise ValueError(f"no batch of {table} is committed yet")
        return reduce(DataFrame.unionByName, parts)

    # --- results over all batches ---

    def _added(self, table: str, upto: int | None = None) -> DataFrame:
        keys, sums, maxima = TOTALS[table]
        return self.read(table, upto).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxima])

    def minutes(self) -> DataFrame:
        return self._added("minute")

    def hours(self) -> DataFrame:
        return self._added("hour")

    def arrivals(self) -> DataFrame:
        return last_per_key(self.read("arrivals"), DOCUMENTS["arrivals"], ["batch_id"]).drop("batch_id")

    def alerts(self) -> DataFrame:
        return last_per_key(self.read("alerts"), DOCUMENTS["alerts"], ["batch_id"]).drop("batch_id")

    def batch_log(self) -> DataFrame:
        return self.read("log")

    # --- upkeep ---

    def fold(self, keep: int = 1, days: int = KEPT_DAYS) -> None:
        """Fold all but the newest ``keep`` batches of every output into one relation.

        Only the newest batch can run again, so older ones are final. The
        folded relation counts once its commit marker is written; from then on
        readers skip the folded batches, which are removed afterwards. Minute
        totals and log rows past ``days`` are dropped on the way. The log is
        folded last, since it says which batches count.
        """
        for table in [*TOTALS, *DOCUMENTS, "log"]:
            base = self._base(table)
            old = self.batches(table)[:-keep] if keep else self.batches(table)
            fresh = [n for n in old if base is None or n > base]
            if fresh:
                if table in TOTALS:
                    rows = self._added(table, fresh[-1]).withColumn("batch_id", F.lit(fresh[-1]))
                elif table in DOCUMENTS:
                    rows = last_per_key(self.read(table, fresh[-1]), DOCUMENTS[table], ["batch_id"])
                else:
                    rows = self.read(table, fresh[-1])
                if table in RETAINED:
                    rows = retain_days(rows, RETAINED[table], days)
                rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{table}_base/upto={fresh[-1]}")
                if base is not None:
                    remove(self.spark, f"{self.path}/{table}_base/upto={base}")
            for n in old:
                remove(self.spark, f"{self.path}/{table}/batch_id={n}")

    def drop_old_state(self, keep: int = 3) -> None:
        """Remove all but the newest states; a batch that runs again needs the one before it."""
        for table in STATE_SCHEMAS:
            for n in self.batches(table)[:-keep]:
                remove(self.spark, f"{self.path}/{table}/batch_id={n}")

    def upkeep(self, batch_id: int, every: int = UPKEEP_EVERY) -> None:
        """After every so many batches: state first, since folding the log hides nothing from it."""
        if (batch_id + 1) % every == 0:
            self.drop_old_state()
            self.fold()


def process(messages: DataFrame, batch_id: int, store: BatchStore, schedule: Schedule) -> None:
    """One micro-batch; safe to run again with the same id."""
    started = time.time()
    seen_before = store.state("feeds", batch_id)
    trips_before = store.state("trips", batch_id)

    held = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    try:
        kept = hold(messages)
        marks = hold(records.mark_repeated(kept, seen_before))
        rows = hold(records.entities(records.fresh(kept, marks)))
        obs = hold(records.with_delay(records.observations(rows), schedule))
        outputs = {
            "arrivals": records.arrivals(obs, schedule.stops, trips_before),
            "alerts": records.alerts(rows),
            "minute": records.delay_minute(obs, records.stopped(rows)),
            "hour": records.delay_hourly(obs),
            "trips": records.next_trip_state(obs, trips_before),
            "feeds": records.next_last_seen(kept, seen_before),
        }
        # The folders do not depend on each other, so their jobs may overlap.
        with ThreadPoolExecutor(len(outputs)) as pool:
            for done in [pool.submit(store.write, table, batch_id, df) for table, df in outputs.items()]:
                done.result()
        store.write("log", batch_id, batch_row(marks, started))
        store.upkeep(batch_id)
    finally:
        for df in held:
            df.unpersist()


def batch_row(marks: DataFrame, started: float) -> DataFrame:
    """Log row of a batch: messages, repeats, offset and feed-time range, duration."""
    used = F.when(~F.col("repeated"), F.col("feed_time"))
    return marks.agg(
        F.count("*").alias("messages"),
        F.count_if("repeated").alias("skipped"),
        F.min("offset").alias("offset_from"),
        F.max("offset").alias("offset_to"),
        F.min(used).alias("feed_time_from"),
        F.max(used).alias("feed_time_to"),
    ).withColumns({"processed_at": F.current_timestamp(), "seconds": F.lit(time.time() - started)})


def start(messages: DataFrame, store: BatchStore, load_schedule: Callable[[], Schedule], checkpoint: str, every: str | None = "30 seconds"):
    """Start the query; ``every=None`` processes what is there and stops.

    The schedule is loaded at the first batch of each local day.
    """
    daily = DailySchedule(load_schedule)
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: process(df, batch_id, store, daily.current())
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def batch_metrics(log: DataFrame) -> DataFrame:
    """Integration metrics of the batch log: ids, contiguity, durations, latency."""
    from tidemark.operators.series import number_slices, previous_row

    steps = previous_row(log, [], ["batch_id"], number_slices("batch_id"), ["offset_to"])
    gap = F.col("prev").isNotNull() & (F.col("offset_from") != F.col("prev.offset_to") + 1)
    latency = F.unix_seconds("processed_at") - F.col("feed_time_to")
    return steps.agg(
        F.count("*").alias("batches"),
        (F.count("*") == F.count_distinct("batch_id")).alias("unique_ids"),
        (F.count_if(gap) == 0).alias("contiguous"),
        F.sum("messages").alias("messages"),
        F.sum("skipped").alias("skipped"),
        F.avg("seconds").alias("mean_seconds"),
        F.max("seconds").alias("max_seconds"),
        # One row per batch, a number the trigger interval bounds.
        F.percentile(latency, 0.5).alias("median_latency_s"),
        F.max("offset_to").alias("last_offset"),
    )


def lag_behind(log: DataFrame, high_offset) -> DataFrame:
    return log.agg((F.lit(high_offset) - (F.max("offset_to") + 1)).alias("lag"))
