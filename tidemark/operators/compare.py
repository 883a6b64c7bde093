"""Null-safe comparison of keyed relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differing_keys(expected: DataFrame, actual: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Number of expected keys whose actual value differs or is missing."""
    a = actual.select(*keys, F.col(value).alias("_actual"))
    joined = expected.select(*keys, value).join(a, list(keys), "left")
    return joined.agg(F.count_if(~F.col(value).eqNullSafe(F.col("_actual"))).alias("differing"))


def outer_compare(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Full outer compare: where each key occurs and which values differ."""
    l = left.select(*keys, *[F.col(v).alias(f"{v}_left") for v in values], F.lit(True).alias("_l"))
    r = right.select(*keys, *[F.col(v).alias(f"{v}_right") for v in values], F.lit(True).alias("_r"))
    joined = l.join(r, list(keys), "full")
    origin = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    return joined.select(
        *keys,
        origin.alias("origin"),
        *[f"{v}_{s}" for v in values for s in ("left", "right")],
        *[(~F.col(f"{v}_left").eqNullSafe(F.col(f"{v}_right"))).alias(f"{v}_differs") for v in values],
    )


def tolerant_compare(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerances: Mapping[str, float]) -> DataFrame:
    """Full outer compare with an absolute tolerance per value; a missing side differs."""
    both = outer_compare(left, right, keys, list(tolerances))

    def off(v: str, tolerance: float) -> Column:
        gap = F.abs(F.col(f"{v}_left") - F.col(f"{v}_right"))
        return F.coalesce(gap > tolerance, F.lit(True))

    different = reduce(or_, [off(v, t) for v, t in tolerances.items()]) | (F.col("origin") != "both")
    return both.select(*keys, "origin", different.alias("different"))


def table_totals(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table, rows, total) of several relations, each as one partial aggregation."""
    parts = [
        df.agg(F.count("*").alias("rows"), F.sum(measure).cast("double").alias("total")).select(
            F.lit(name).alias("table"), "rows", "total"
        )
        for name, (df, measure) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def period_totals(source: DataFrame, target: DataFrame, ts: str, start, end, measures: Sequence[str]) -> DataFrame:
    """Rows and totals of two relations in ``[start, end)`` with an equality flag."""
    def totals(df: DataFrame, tag: str) -> DataFrame:
        inside = df.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))
        return inside.agg(F.count("*").alias(f"rows_{tag}"), *[F.sum(m).alias(f"{m}_{tag}") for m in measures])

    s, t = totals(source, "source"), totals(target, "target")
    target_row = t.select(F.struct(*t.columns)).scalar()
    both = s.select("*", *[target_row[c].alias(c) for c in t.columns])
    same = F.col("rows_source") == F.col("rows_target")
    for m in measures:
        same = same & F.col(f"{m}_source").eqNullSafe(F.col(f"{m}_target"))
    return both.withColumn("equal", same)


def time_seam(old: DataFrame, new: DataFrame, ts: str) -> DataFrame:
    """Where two stores of one history meet."""
    o = old.agg(F.max(ts).alias("last_old"), F.count("*").alias("n"))
    n = new.agg(F.min(ts).alias("first_new"), F.count("*").alias("n"))
    new_row = n.select(F.struct("first_new", "n")).scalar()
    row = o.select("last_old", F.col("n").alias("_o"), new_row["first_new"].alias("first_new"), new_row["n"].alias("_n"))
    hours = (F.unix_micros(F.col("first_new").cast("timestamp")) - F.unix_micros(F.col("last_old").cast("timestamp"))) / 3.6e9
    return row.select("last_old", "first_new", hours.alias("gap_hours"), (F.col("_o") + F.col("_n")).alias("combined_rows"))


def set_members(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Every key with the side it occurs on."""
    o = old.select(key).distinct().withColumn("_o", F.lit(1))
    n = new.select(key).distinct().withColumn("_n", F.lit(1))
    side = F.when(F.col("_n").isNull(), "only_old").when(F.col("_o").isNull(), "only_new").otherwise("common")
    return o.join(n, key, "full").select(key, side.alias("side"))
