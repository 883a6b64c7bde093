"""Profiling of a wide fact: completeness, cardinality, distributions, coverage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import stats, textfns, timefns


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls, blanks): one scan; blanks only for text columns."""
    columns = list(columns or df.columns)
    text = {n for n, t in df.dtypes if t == "string"}
    one = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__null") for c in columns],
        *[F.count_if(textfns.is_blank(c)).alias(f"{c}__blank") for c in columns if c in text],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}__null").alias("nulls"),
                (F.col(f"{c}__blank") if c in text else F.lit(None).cast("bigint")).alias("blanks"),
            )
            for c in columns
        ]
    )
    return one.select(F.inline(rows))


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct_values).

    Each column is de-duplicated by its own aggregation; only distinct values
    are shuffled, and no row is copied once per column.
    """
    parts = [
        df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count("*").alias("distinct_values")).select(F.lit(c).alias("column"), "distinct_values")
        for c in columns
    ]
    return reduce(DataFrame.unionByName, parts)


def distribution(df: DataFrame, category: str, measure: str) -> DataFrame:
    """Rows, share of all rows and measure total per category."""
    per = df.groupBy(category).agg(F.count("*").alias("rows"), F.sum(measure).alias("total"))
    all_rows = per.agg(F.sum("rows")).scalar()
    return per.withColumn("pct", 100.0 * F.col("rows") / all_rows)


def split_by_year(df: DataFrame, category: str, ts: str, measure: str, years: Sequence[int]) -> DataFrame:
    """Rows and totals of each category in each year, and when it was last seen."""
    cells = []
    for y in years:
        hit = F.year(ts) == y
        cells += [F.count_if(hit).alias(f"rows_{y}"), F.sum(F.when(hit, F.col(measure))).alias(f"total_{y}")]
    return df.groupBy(category).agg(*cells, F.max(ts).alias("last_seen"))


def numeric_summary(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """One row per variable: range, moments, exact quantiles, zeros, negatives, fractions, total.

    Two scans for all variables: one for the moments, one for the quantiles.
    """

    def moments(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("variable"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.count_if(x == 0).alias("zeros"),
            F.count_if(x < 0).alias("negatives"),
            F.count_if(x != F.floor(x)).alias("non_integers"),
            F.sum(x).alias("total"),
        )

    summary = df.agg(F.array(*[moments(c) for c in columns]).alias("_rows")).select(F.inline("_rows"))
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "variable", "_value")
    quantiles = stats.exact_quantiles(long, "_value", probabilities, ["variable"])
    names = {f"q{i}": f"p{round(100 * p)}" for i, p in enumerate(probabilities)}
    return summary.join(quantiles.withColumnsRenamed(names), "variable", "left")


def value_counts(df: DataFrame, value: str, where: Column) -> DataFrame:
    return df.where(where).groupBy(value).agg(F.count("*").alias("rows"))


def skew_report(df: DataFrame, value: str) -> DataFrame:
    """Sample skewness of a value and of ln(1 + value)."""
    return df.agg(
        stats.sample_skewness(value).alias("skewness"), stats.sample_skewness(F.log1p(value)).alias("log_skewness")
    )


def fixed_histogram(df: DataFrame, value: str, bins: int, upper: Column | float, lower: Column | float) -> DataFrame:
    """Equal-width bins between two bounds; rows above ``upper`` are left out, the top edge is included."""
    lo = lower if isinstance(lower, Column) else F.lit(float(lower))
    hi = upper if isinstance(upper, Column) else F.lit(float(upper))
    inside = df.where((F.col(value) >= lo) & (F.col(value) <= hi))
    bucket = F.least(F.floor((F.col(value) - lo) / ((hi - lo) / F.lit(bins))), F.lit(bins - 1))
    return inside.groupBy(bucket.cast("int").alias("bin")).agg(F.count("*").alias("rows"))


def log_histogram(df: DataFrame, value: str, linear_to: int = 20, per_doubling: int = 4) -> DataFrame:
    """Log-spaced bins of whole numbers: one bin per number up to ``linear_to``, geometric beyond."""
    geometric = linear_to + F.floor(F.log2(F.col(value) / F.lit(float(linear_to))) * per_doubling)
    label = F.when(F.col(value) < linear_to, F.floor(value)).otherwise(geometric)
    return df.groupBy(label.cast("int").alias("bin")).agg(
        F.count("*").alias("rows"), F.min(value).alias("least"), F.max(value).alias("most")
    )


def attribute_consistency(df: DataFrame, key: str, attributes: Sequence[Sequence[str]]) -> DataFrame:
    """Ids with more than one value of an attribute (or attribute tuple).

    One scan reduces the rows to distinct combinations, few per id; the
    attributes are counted on those.
    """
    columns = list(dict.fromkeys(c for group in attributes for c in group))
    combinations = df.select(key, *columns).distinct()
    values = [F.col(c[0]) if len(c) == 1 else F.struct(*c) for c in attributes]
    per = combinations.groupBy(key).agg(*[F.count_distinct(v).alias(f"_{i}") for i, v in enumerate(values)])
    rows = [
        F.struct(F.lit("+".join(c)).alias("attribute"), F.count("*").alias("ids"), F.count_if(F.col(f"_{i}") > 1).alias("inconsistent"))
        for i, c in enumerate(attributes)
    ]
    return per.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def multi_valued(df: DataFrame, key: str, category: str, ts: str) -> DataFrame:
    """Ids seen in several categories: one row per (id, category) with first and last time."""
    per = df.groupBy(key, category).agg(F.count("*").alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    several = per.groupBy(key).agg(
        F.count(category).alias("_n"),
        # The categories come from a fixed list.
        F.array_join(F.array_sort(F.collect_set(category)), ", ").alias("categories"),
    ).where("_n > 1")
    return per.join(several.drop("_n"), key)


def shared_values(df: DataFrame, value: Sequence[str], key: str, limit: int = 20) -> DataFrame:
    """Values used by several ids, the most shared first, one row per (value, id).

    The ids stay rows; a value shared by very many ids is not gathered.
    """
    pairs = df.select(*value, key).distinct()
    top = (
        pairs.groupBy(*value).agg(F.count("*").alias("ids")).where("ids > 1").orderBy(F.desc("ids"), *value).limit(limit)
    )
    return pairs.join(F.broadcast(top), list(value))  # at most `limit` rows


def partial_range(df: DataFrame, key: str, ts: str, days: int = 1) -> DataFrame:
    """Ids that start late or end early by more than ``days`` against the whole span."""
    per = df.groupBy(key).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count("*").alias("rows"))
    first, last = per.agg(F.min("first_ts")).scalar(), per.agg(F.max("last_ts")).scalar()
    step = F.expr(f"INTERVAL {int(days)} DAY")
    return per.where((F.col("first_ts") > first + step) | (F.col("last_ts") < last - step))


def time_coverage(df: DataFrame, ts: str) -> DataFrame:
    """First and last time, distinct hours and distinct days, via one row per hour."""
    hours = df.groupBy(timefns.hour_start(ts).alias("_h")).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    days = hours.groupBy(F.to_date("_h").alias("_d")).agg(F.count("*").alias("_n"), F.min("_a").alias("_a"), F.max("_b").alias("_b"))
    return days.agg(
        F.min("_a").alias("first_ts"), F.max("_b").alias("last_ts"), F.sum("_n").alias("hours"), F.count("*").alias("days")
    )


def month_profile(df: DataFrame, ts: str, key: str, method: str, methods: Sequence[str], measure: str) -> DataFrame:
    """Per month: rows, present and calendar hours, ids, rows per method, total."""
    month = F.trunc(ts, "MM").alias("_start")
    base = df.groupBy(month).agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(method) == m).alias(f"rows_{m}") for m in methods],
        F.sum(measure).alias("total"),
    )
    present = df.select(timefns.hour_start(ts).alias("_h")).distinct()
    hours = present.groupBy(F.trunc("_h", "MM").alias("_start")).agg(F.count("*").alias("hours"))
    ids = df.select(month, key).distinct().groupBy("_start").agg(F.count(key).alias("ids"))
    return (
        base.join(hours, "_start", "left")
        .join(ids, "_start", "left")
        .withColumns({"month": timefns.month_key("_start"), "calendar_hours": timefns.hours_in_month("_start")})
        .drop("_start")
    )


def sparse_days(df: DataFrame, ts: str, key: str, share: float = 0.95) -> DataFrame:
    """Days whose distinct ids fall below a share of the median day."""
    days = (
        df.groupBy(F.to_date(ts).alias("day"), key)
        .agg(F.count("*").alias("_n"))
        .groupBy("day")
        .agg(F.count(key).alias("ids"), F.sum("_n").alias("rows"))
    )
    # The exact median runs over days only, a number the calendar bounds.
    return days.where(F.col("ids") < share * days.agg(F.percentile("ids", 0.5)).scalar())


def grid_density(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows against the product of the distinct counts of some columns."""
    sizes = [df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count("*")).scalar() for c in columns]
    possible = reduce(lambda a, b: a * b, sizes)
    return df.agg(F.count("*").alias("rows")).select(
        "rows", possible.alias("possible"), (100.0 * F.col("rows") / possible).alias("pct_filled")
    )


def box_report(df: DataFrame, lat: str, lon: str, box: dict) -> DataFrame:
    outside = ~(F.col(lat).between(*box["lat"]) & F.col(lon).between(*box["lon"]))
    return df.agg(
        F.min(lat).alias("lat_min"),
        F.max(lat).alias("lat_max"),
        F.min(lon).alias("lon_min"),
        F.max(lon).alias("lon_max"),
        F.count_if(outside).alias("outside"),
    )


def schema_listing(df: DataFrame) -> DataFrame:
    """(position, column, type) of a relation."""
    return df.sparkSession.createDataFrame(
        [(i + 1, n, t) for i, (n, t) in enumerate(df.dtypes)], "position int, column string, type string"
    )


def preview(df: DataFrame, k: int, *order) -> DataFrame:
    """First ``k`` rows, of an order if one is given."""
    return df.orderBy(*order).limit(k) if order else df.limit(k)


def fixed_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Reproducible sample of fixed size: the rows with the smallest seeded key digest.

    The digest is the same in every engine and on every partitioning. Each task
    keeps ``n`` rows, so only candidates are shuffled.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.orderBy(digest, *keys).limit(n)
