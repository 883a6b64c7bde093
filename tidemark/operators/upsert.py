"""Merges of a stored relation with an incoming one, as pure relations.

Plain Parquet has no row-level update, so a merge is a new relation that a
sink writes as the next version of the table (see ``sources.tables``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.series import first_rows


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows win; stored rows of other keys stay."""
    kept = stored.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.unionByName(incoming)


def document_upsert(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole-document replace where the last document of a key in the batch wins."""
    from tidemark.operators.dedup import last_per_key

    return upsert(stored, last_per_key(batch, keys, order), keys)


def additive_upsert(
    stored: DataFrame, delta: DataFrame, keys: Sequence[str], sums: Sequence[str], maxima: Sequence[str] = ()
) -> DataFrame:
    """Counts and sums are added, maxima merged; NULL maxima do not win."""
    columns = [*keys, *sums, *maxima]
    return (
        stored.select(*columns)
        .unionByName(delta.select(*columns))
        .groupBy(*keys)
        .agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxima])
    )


def insert_if_absent(log: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is not in the log yet."""
    return incoming.join(log.select(key), key, "left_anti").select(*incoming.columns)


def delete_missing(stored: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose key the source still has."""
    return stored.join(source.select(*keys).distinct(), list(keys), "left_semi")


def retain_days(df: DataFrame, ts: str, days: int, now: Column | None = None) -> DataFrame:
    """Rows not older than ``days`` before ``now`` (by default the newest time stored)."""
    newest = df.agg(F.max(ts)).scalar() if now is None else now
    return df.where(F.col(ts) >= newest - F.expr(f"INTERVAL {int(days)} DAY"))


def newest_per_group(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The newest ``n`` rows of every group."""
    return first_rows(df, [group], [F.desc(order)], n).drop("rank")


def replace_months(stored: DataFrame, incoming: DataFrame, day: str) -> DataFrame:
    """Stored rows outside the incoming months plus the incoming rows."""
    month = F.trunc(day, "MM")
    months = incoming.select(month.alias("_m")).distinct()
    kept = stored.withColumn("_m", month).join(months, "_m", "left_anti").drop("_m")
    return kept.unionByName(incoming)


def finished_runs(log: DataFrame) -> DataFrame:
    """Latest state of every run from its start and finish rows."""
    from tidemark.operators.dedup import last_per_key

    return last_per_key(log, ["run_id"], ["logged_at", "status"])


def month_list(months: Mapping | Sequence) -> str:
    return ", ".join(f"{m:%Y-%m}" for m in sorted(months))
