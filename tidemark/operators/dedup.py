"""Key uniqueness, duplicate rows and multiset differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefns import month_key
from tidemark.sources.tables import written_once


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def key_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys, duplicated keys, rows in excess of one per key, most rows of a key."""
    return key_counts(df, keys).agg(
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess_rows"),
        F.max("n").alias("max_per_key"),
    )


def hash_repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n) of the keys that occur more than once, for wide keys.

    The first pass groups eight-byte hashes instead of whole keys. Hashes that
    repeat are stored, so their size is known, and only rows that carry one are
    compared by their whole key: hash collisions change nothing.
    """
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    repeated = written_once(hashed.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1").select("_h"), "hashes")
    return key_counts(hashed.join(repeated, "_h", "left_semi"), keys).where("n > 1")


def hashed_excess_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in excess of one per key, by way of the hashes."""
    return hash_repeated(df, keys).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess_rows"))


def full_row_summary(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and rows that repeat another one in every column."""
    rows = df.agg(F.count("*")).scalar()
    return hashed_excess_rows(df, df.columns).select(
        rows.alias("rows"), (rows - F.col("excess_rows")).alias("distinct_rows"), F.col("excess_rows").alias("repeated_rows")
    )


def duplicate_examples(df: DataFrame, keys: Sequence[str], value: str, limit: int) -> DataFrame:
    """The ``limit`` most repeated keys with all their values in order.

    Long form (key, n, value, times): a key that repeats without bound is
    counted per value instead of being gathered into one list.
    """
    top = key_counts(df, keys).where("n > 1").orderBy(F.desc("n"), *keys).limit(limit)
    # `limit` rows at most, so they travel to the table and not the table to them.
    rows = df.select(*keys, value).join(F.broadcast(top), list(keys))
    return rows.groupBy(*keys, "n", value).agg(F.count("*").alias("times"))


def duplicates_by_month(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Duplicated keys per month of their time column."""
    months = key_counts(df, keys).where("n > 1").groupBy(F.trunc(ts, "MM").alias("_m")).agg(F.count("*").alias("duplicated_keys"))
    return months.select(month_key("_m").alias("month"), "duplicated_keys")


def distinct_batch(batch: DataFrame) -> DataFrame:
    """Full-row distinct inside one batch."""
    return batch.dropDuplicates()


def not_stored(batch: DataFrame, stored: DataFrame, ts: str) -> DataFrame:
    """Distinct batch rows that are not stored yet (multiset difference).

    The stored side is cut to the batch's time range first; the range is a
    scalar subquery, so it reaches the scan as a filter.
    """
    unique = distinct_batch(batch)
    lo, hi = batch.agg(F.min(ts)).scalar(), batch.agg(F.max(ts)).scalar()
    window = stored.where((F.col(ts) >= lo) & (F.col(ts) <= hi)).select(*batch.columns)
    return unique.exceptAll(window)


def dedup_report(batch: DataFrame, stored: DataFrame, ts: str) -> DataFrame:
    """Rows fetched, repeats inside the batch, rows already stored, rows to write."""
    fetched = batch.agg(F.count("*").alias("v")).scalar()
    unique = distinct_batch(batch).agg(F.count("*").alias("v")).scalar()
    fresh = not_stored(batch, stored, ts).agg(F.count("*").alias("rows_written"))
    return fresh.select(
        fetched.alias("rows_fetched"),
        (fetched - unique).alias("dup_in_batch"),
        (unique - F.col("rows_written")).alias("dup_already_stored"),
        "rows_written",
    )


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Counts of both multiset differences; 0/0 proves equality row for row.

    One grouping of both sides instead of two set operations.
    """
    b = b.select(*a.columns)
    both = a.withColumn("_d", F.lit(1)).unionByName(b.withColumn("_d", F.lit(-1)))
    net = both.groupBy(*a.columns).agg(F.sum("_d").alias("_d"))
    return net.agg(
        F.coalesce(F.sum(F.greatest("_d", F.lit(0))), F.lit(0)).alias("only_in_a"),
        F.coalesce(F.sum(F.greatest(-F.col("_d"), F.lit(0))), F.lit(0)).alias("only_in_b"),
    )


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Whole rows, the last one per key; aggregation, so repeats combine before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def key_set_sizes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Distinct keys of two relations: in both, only old, only new."""
    o = old.select(key).distinct()
    n = new.select(key).distinct()
    sides = o.withColumn("_o", F.lit(1)).join(n.withColumn("_n", F.lit(1)), key, "full")
    return sides.agg(
        F.count("_o").alias("old_keys"),
        F.count("_n").alias("new_keys"),
        F.count_if(F.col("_o").isNotNull() & F.col("_n").isNotNull()).alias("common"),
        F.count_if(F.col("_n").isNull()).alias("only_old"),
        F.count_if(F.col("_o").isNull()).alias("only_new"),
    )
