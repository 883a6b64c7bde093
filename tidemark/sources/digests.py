"""A stored index of row digests by month, asked before a batch is compared with all history.

For every month the index holds the distinct 64-bit digests of its rows, sorted, so that the minima and maxima of its row groups bound
narrow ranges. A batch meets the digests first; only months with a hit are read, only rows with a hit digest are compared, and
they are compared as whole rows, so digests of different rows that happen to be equal change nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timefns
from tidemark.operators.dedup import distinct_batch
from tidemark.sources.files import balanced
from tidemark.sources.tables import children, remove, written_once

#: Digests of a batch that are handed to the scan as a list, which prunes row groups; more of them meet the index by a join.
LISTED = 1000


class DigestIndex:
    """Digests of the rows of a relation, by the month of ``ts``."""

    def __init__(self, spark: SparkSession, path: str, ts: str, columns: Sequence[str]):
        self.spark, self.path, self.ts, self.columns = spark, path, ts, list(columns)

    def digest(self) -> Column:
        return F.xxhash64(*self.columns)

    def replace_months(self, rows: DataFrame) -> None:
        """Index the months that occur in ``rows`` anew; rows without a time are in no month and not indexed."""
        slim = rows.where(F.col(self.ts).isNotNull()).select(timefns.month_start(self.ts).alias("month"), self.digest().alias("digest")).distinct()
        (
            balanced(slim, "month")
            .sortWithinPartitions("month", "digest")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy("month")
            .parquet(self.path)
        )

    def delete_month(self, month: dt.date) -> None:
        remove(self.spark, f"{self.path}/month={month:%Y-%m}-01")

    def read(self) -> DataFrame:
        schema = "digest bigint, month date"
        if not any(n.startswith("month=") for n in children(self.spark, self.path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def hits(self, digests: DataFrame) -> DataFrame:
        """(digest, month) of the index for a relation of ``digest``."""
        few = [r.digest for r in digests.select("digest").distinct().limit(LISTED + 1).collect()]
        if len(few) <= LISTED:
            return self.read().where(F.col("digest").isin(few)) if few else self.read().limit(0)
        return self.read().join(digests.select("digest").distinct(), "digest", "left_semi")

    def not_stored(self, batch: DataFrame, history: Callable[[list[dt.date]], DataFrame]) -> DataFrame:
        """Distinct batch rows that no month holds. ``history`` gives the stored rows of some months.

        The same as ``distinct_batch(batch).exceptAll(all history)``.
        """
        unique = written_once(distinct_batch(batch).withColumn("_digest", self.digest()), "batch")
        hits = written_once(self.hits(unique.select(F.col("_digest").alias("digest"))), "hits")
        months = sorted(r.month for r in hits.select("month").distinct().collect())
        if not months:
            return unique.drop("_digest")
        found = hits.select(F.col("digest").alias("_digest")).distinct()
        stored = history(months).select(*batch.columns).withColumn("_digest", self.digest()).join(found, "_digest", "left_semi")
        known = unique.join(found, "_digest", "left_semi")
        fresh = unique.join(found, "_digest", "left_anti")
        return fresh.select(*batch.columns).unionByName(known.select(*batch.columns).exceptAll(stored.select(*batch.columns)))
