"""Exact statistics that hold at any scale and under any skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_skewness(c) -> Column:
    """Skewness with the sample correction; Spark's own is the population form."""
    x = F.col(c) if isinstance(c, str) else c
    n = F.count(x).cast("double")
    return F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2)


def percent(part: Column, whole: Column) -> Column:
    """100·part/whole, NULL for an empty whole."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), fan: int = 16
) -> DataFrame:
    """Interpolated quantiles per group, one column ``q0, q1, …`` per probability.

    ``percentile`` keeps all distinct values of a group in one task. Here values
    are first counted (which spreads a hot group over all tasks), cut into
    ``fan``² slices of about equal size at approximate quantiles, and only the
    slices that hold a wanted rank are ordered, each as a group of its own.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    return quantiles_of_counts(counts, probabilities, by, fan)


def quantiles_of_counts(counts: DataFrame, probabilities: Sequence[float], by: Sequence[str] = (), fan: int = 16) -> DataFrame:
    """As :func:`exact_quantiles` for values ``_v`` that occur ``_n`` times each, one row a group and value."""
    by = list(by)
    cuts = [i / (fan * fan) for i in range(1, fan * fan)]
    edges = counts.groupBy(*by).agg(
        F.percentile_approx("_v", cuts, 1000).alias("_edges"), F.sum("_n").alias("_total")
    )
    if by:
        joined = counts.join(edges.select(*by, "_edges"), by)
    else:
        joined = counts.withColumn("_edges", edges.select("_edges").scalar())

    def above(edge) -> Column:
        return F.coalesce((F.get("_edges", edge) < F.col("_v")).cast("int"), F.lit(0))

    # Edges below the value, found in two steps of `fan` plain comparisons.
    coarse = sum((above(F.lit(fan * i - 1)) for i in range(1, fan)), F.lit(0))
    fine = sum((above(F.col("_coarse") * fan + i) for i in range(fan - 1)), F.lit(0))
    sliced = joined.withColumn("_coarse", coarse).withColumn("_slice", F.col("_coarse") * fan + fine).drop("_edges", "_coarse")

    # At most `fan`² rows per group from here to `wanted`.
    per_slice = sliced.groupBy(*by, "_slice").agg(F.sum("_n").alias("_rows"))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ranks = F.array_distinct(
        F.concat(*[F.array(f(F.lit(p) * (F.col("_total") - 1)).cast("long")) for p in probabilities for f in (F.floor, F.ceil)])
    )
    wanted = (
        per_slice.withColumn("_total", F.sum("_rows").over(whole))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn(
            "_ranks", F.filter(ranks, lambda r: (r >= F.col("_offset")) & (r < F.col("_offset") + F.col("_rows")))
        )
        .where(F.size("_ranks") > 0)
        .drop("_rows")
    )
    ordered = Window.partitionBy(*by, "_slice").orderBy("_v")
    placed = (
        sliced.join(wanted, [*by, "_slice"])
        .withColumn("_end", F.col("_offset") + F.sum("_n").over(ordered))
        .select(*by, "_v", "_total", F.explode(F.filter("_ranks", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_n")))).alias("_rank"))
    )

    def quantile(p: float) -> Column:
        position = F.lit(p) * (F.max("_total") - 1)
        low = F.max(F.when(F.col("_rank") == F.floor(F.lit(p) * (F.col("_total") - 1)), F.col("_v")))
        high = F.max(F.when(F.col("_rank") == F.ceil(F.lit(p) * (F.col("_total") - 1)), F.col("_v")))
        return low + (high - low) * (position - F.floor(position))

    return placed.groupBy(*by).agg(*[quantile(p).alias(f"q{i}") for i, p in enumerate(probabilities)])
