"""Ordered operators: neighbours, running values, rolling means, top rows.

A window over a hot key would put all of its rows into one task. The ordered
helpers below therefore work per (key, slice), where a slice is a piece of
the order column such as a minute, and carry one row per slice to the next;
slices may be nested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, group: Sequence[str], order: Sequence, n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per group.

    Spark limits each group inside every task before the shuffle when a row
    number is compared with a literal, so a hot group sends ``n`` rows per task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def _along(df: DataFrame, key: list[str], order: Sequence, levels: list[str], value: Column, fold: str, name: str) -> DataFrame:
    """Value of the rows before each row of its key: the last one or the largest.

    Rows are ordered inside (key, first level) only; what comes in from earlier
    slices is the same question asked of one summary row per slice, ordered
    inside the next coarser level, and so on.
    """
    inside = Window.partitionBy(*key, *levels[:1]).orderBy(*order)
    if fold == "last":
        local, summary, combine = F.lag(value).over(inside), F.max_by(value, F.struct(*order)), F.coalesce
    else:
        earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
        local, summary, combine = F.max(value).over(earlier), F.max(value), F.greatest
    rows = df.withColumn(name, local)
    if not levels:
        return rows
    # Names by depth, since the levels are joined back one into the other.
    own, before = f"_summary{len(levels)}", f"_before{len(levels)}"
    slices = df.groupBy(*key, *levels).agg(summary.alias(own))
    incoming = _along(slices, key, levels[:1], levels[1:], F.col(own), fold, before).select(*key, levels[0], before)
    # Same partitioning as the window above, so the rows are not shuffled again.
    return rows.join(incoming, [*key, levels[0]], "left").withColumn(name, combine(F.col(name), F.col(before))).drop(before)


def _sliced(df: DataFrame, slices: Column | Sequence[Column]) -> tuple[DataFrame, list[str]]:
    columns = [slices] if isinstance(slices, Column) else list(slices)
    names = [f"_slice{i}" for i in range(len(columns))]
    return df.withColumns(dict(zip(names, columns))), names


def previous_row(
    df: DataFrame, key: Sequence[str], order: Sequence[str], slices: Column | Sequence[Column], values: Sequence[str], name: str = "prev"
) -> DataFrame:
    """Struct ``name`` with ``values`` of the preceding row of the same key.

    ``order`` must be a total order within a key, ``slices`` are columns, fine
    to coarse, that do not decrease along it, and keys are not NULL. Without
    slices a key is ordered in one task; that is for rows of a checked number.
    """
    rows, levels = _sliced(df, slices)
    return _along(rows, list(key), order, levels, F.struct(*values), "last", name).drop(*levels)


def running_max_before(
    df: DataFrame, key: Sequence[str], order: Sequence[str], slices: Column | Sequence[Column], value: str, name: str
) -> DataFrame:
    """Largest ``value`` among all earlier rows of the key; NULL on the first row."""
    rows, levels = _sliced(df, slices)
    return _along(rows, list(key), order, levels, F.col(value), "max", name).drop(*levels)


def number_slices(c: str, width: int = 4096) -> list[Column]:
    """Two levels of equal slices of a whole-number column."""
    return [F.floor(F.col(c) / width), F.floor(F.col(c) / (width * width))]


def time_slices(c: str) -> list[Column]:
    """Minutes and days of a time column."""
    return [F.date_trunc("minute", c), F.to_date(c)]


def repeated_flag(df: DataFrame, feed: str, time: str, order: Sequence[str], slices: Column | Sequence[Column], name: str = "repeated") -> DataFrame:
    """True where a snapshot is not newer than every earlier one of its feed."""
    seen = running_max_before(df, [feed], order, slices, time, "_seen")
    return seen.withColumn(name, F.col(time) <= F.coalesce("_seen", F.lit(0))).drop("_seen")


def order_check(df: DataFrame, key: Sequence[str], order: Sequence[str], slices: Column | Sequence[Column]) -> DataFrame:
    """Rows that equal or precede the row before them in a given row order.

    ``key`` is the tuple that should increase strictly along ``order``.
    """
    checked = previous_row(df, [], order, slices, list(key))
    now, before = F.struct(*key), F.col("prev")
    return checked.agg(
        F.count("*").alias("rows"),
        F.count_if(before.isNotNull() & (now == before)).alias("adjacent_duplicates"),
        F.count_if(before.isNotNull() & (now < before)).alias("out_of_order"),
    )


def centered_mean(daily: DataFrame, day: str, value: str, width: int = 7, name: str = "rolling_mean") -> DataFrame:
    """Mean over ``width`` days around each day, NULL unless all of them are present.

    Every day is handed to its neighbours and grouped, so no task holds the
    whole series.
    """
    half = width // 2
    offsets = F.sequence(F.lit(-half), F.lit(half))
    spread = daily.select(F.col(day), F.col(value), F.explode(offsets).alias("_o")).select(
        F.date_add(day, F.col("_o")).alias(day),
        F.col(value).alias("_v"),
        F.when(F.col("_o") == 0, F.col(value)).alias("_own"),
    )
    return (
        spread.groupBy(day)
        .agg(
            F.max("_own").alias(value),
            F.when(F.count("_v") == width, F.avg("_v")).alias(name),
            F.count("_own").alias("_here"),
        )
        .where("_here = 1")
        .drop("_here")
    )


def gaps(df: DataFrame, time: str, key: Sequence[str] = (), name: str = "gap_days") -> DataFrame:
    """Days between consecutive instants, ordered per key and year with carry-over."""
    with_prev = previous_row(df, key, [time], F.year(time), [time])
    micros = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col(f"prev.{time}").cast("timestamp"))
    return with_prev.withColumn(name, micros / 8.64e10).drop("prev")


def contiguous(log: DataFrame, start: str, end: str, order: str, slices: Column | Sequence[Column]) -> DataFrame:
    """One row: does every range begin right after the one before?"""
    steps = previous_row(log, [], [order], slices, [end])
    broken = F.count_if(F.col("prev").isNotNull() & (F.col(start) != F.col(f"prev.{end}") + 1))
    return steps.agg(F.count("*").alias("ranges"), broken.alias("breaks"), (broken == 0).alias("contiguous"))


def overlaps(spans: DataFrame, order: str, first: str, last: str, slices: Column | Sequence[Column]) -> DataFrame:
    """Spans that begin at or before the end of the previous one."""
    steps = previous_row(spans, [], [order], slices, [last])
    return steps.withColumn("overlaps", F.coalesce(F.col(f"prev.{last}") >= F.col(first), F.lit(False))).drop("prev")


def share_in_group(df: DataFrame, group: Sequence[str], value: str, name: str = "share") -> DataFrame:
    """Value over the sum of its group; the group total is joined, not windowed."""
    totals = df.groupBy(*group).agg(F.sum(value).alias("_total"))
    return df.join(totals, list(group)).withColumn(name, F.col(value) / F.col("_total")).drop("_total")


def peak_label(df: DataFrame, group: Sequence[str], label: str, value: str, name: str) -> DataFrame:
    """Label with the largest value per group; ties go to the smallest label."""
    return df.groupBy(*group).agg(F.max_by(label, F.struct(F.col(value), -F.col(label))).alias(name), F.max(value).alias(f"{name}_value"))


def renumber(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Number few groups 0, 1, … by ascending mean of ``value`` and relabel the rows."""
    means = df.groupBy(group).agg(F.avg(value).alias("_m"))
    numbered = means.select(group, (F.row_number().over(Window.orderBy("_m", group)) - 1).alias(name))
    return df.join(numbered, group)


def top_names(df: DataFrame, group: Sequence[str], name: str, value: str, n: int = 3, out: str = "top_names") -> DataFrame:
    """The ``n`` names with the largest value per group, joined to one text."""
    best = first_rows(df, group, [F.desc(value), F.asc(name)], n)
    listed = F.array_sort(F.collect_list(F.struct("rank", name)))
    return best.groupBy(*group).agg(F.array_join(F.transform(listed, lambda s: s[name]), "; ").alias(out))


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """The first ``k`` rows of an order; each task keeps ``k`` rows."""
    return df.orderBy(*order).limit(k)


def cumulative_share(df: DataFrame, value: str, ranks: Sequence[int], order: Sequence) -> DataFrame:
    """Share of the total carried by the largest k rows, for several k."""
    top = max(ranks)
    best = df.orderBy(*order).limit(top)
    # At most `top` rows are numbered in one task.
    numbered = best.withColumn("_rank", F.row_number().over(Window.orderBy(*order)))
    total = df.agg(F.sum(value)).scalar()
    sums = numbered.agg(*[F.sum(F.when(F.col("_rank") <= k, F.col(value))).alias(str(k)) for k in ranks])
    long = sums.unpivot([], [str(k) for k in ranks], "k", "part")
    return long.select(F.col("k").cast("int").alias("k"), (100.0 * F.col("part") / total).alias("share_pct"))
