"""Exact statistics kept by month: how often each value of each column occurs.

Counts of values add up over months, so distinct counts, moments and exact quantiles of any months come from the stored parts
and never from the fact. When a month changes, only its part is made again. Values are kept as text, which gives
numbers back exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import stats, timefns


def value_parts(df: DataFrame, columns: Sequence[str], day: str) -> DataFrame:
    """(first_day, variable, value, n) of every month; rows combine in the task that read them."""
    wide = df.select(timefns.month_start(day).alias("first_day"), *[F.col(c).cast("string").alias(c) for c in columns])
    long = wide.unpivot(["first_day"], list(columns), "variable", "value").where("value IS NOT NULL")
    return long.groupBy("first_day", "variable", "value").agg(F.count("*").alias("n"))


def cardinality(parts: DataFrame) -> DataFrame:
    """(column, distinct_values) over all months; as ``profile.cardinality``, but columns without a value have no row."""
    return parts.select("variable", "value").distinct().groupBy(F.col("variable").alias("column")).agg(F.count("*").alias("distinct_values"))


def numeric_summary(parts: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """As ``profile.numeric_summary``: range, moments, exact quantiles, zeros, negatives, fractions, total."""
    counts = parts.where(F.col("variable").isin(list(columns))).groupBy("variable", F.col("value").cast("double").alias("_v")).agg(F.sum("n").alias("_n"))
    v, n = F.col("_v"), F.col("_n")

    def times(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    moments = counts.groupBy("variable").agg(
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
        times(v == 0).alias("zeros"),
        times(v < 0).alias("negatives"),
        times(v != F.floor(v)).alias("non_integers"),
        F.sum(v * n).alias("total"),
    )
    # Squares of differences from the mean, since the difference of large squares loses digits.
    spread = counts.join(moments.select("variable", "mean"), "variable").groupBy("variable").agg(
        F.sqrt(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))) / F.nullif(F.sum(n) - 1, F.lit(0))).alias("std")
    )
    names = {f"q{i}": f"p{round(100 * p)}" for i, p in enumerate(probabilities)}
    quantiles = stats.quantiles_of_counts(counts, probabilities, ["variable"]).withColumnsRenamed(names)
    out = moments.join(spread, "variable").join(quantiles, "variable", "left")
    return out.select("variable", "min", "max", "mean", "std", "zeros", "negatives", "non_integers", "total", *names.values())
