"""Mix sources to target weights along a curriculum, with DataFrame functions only.

A source's schedule is a list of knots ``(time, weight)``, time from 0 to 1 and weight linear between
knots. Its integral is the source's weight in the whole run, and its integral up to a time says how much
of the source's demand is due by then. Sources in code point order, null last, take the schedules in
turn. Together they are to get as many words as there are; no source gets more than ``repeats`` times its
own size, and what is over is shared out again by weight.

The words of a source form a line, its documents in the order of a hash of their ids, passed through again
for every repeat. A source takes its target from the start of that line, so the last document may be
taken in part. A copy of a document is due at the time when the source's demand reaches the words before
it (the inverse of the integral), and documents are range-sorted by that position.

Sums are taken within hash slices of a source first, so that a source with a third of all rows is spread
over many tasks. Null texts and empty texts have size 0 and take nothing; null sources are one source;
null ids come first in a source. Repeated rows are rows of their own. An empty table gives an empty
result. Columns that the operator makes start with ``_mix_`` until they are named in the result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, written

Knots = list[tuple[float, float]]

#: Weights 5, 2 and 1 in the whole run: the first kind fades, the third grows.
SCHEDULES: list[Knots] = [[(0.0, 7.5), (1.0, 2.5)], [(0.0, 2.0), (1.0, 2.0)], [(0.0, 0.5), (0.5, 1.0), (1.0, 1.5)]]
REPEATS = 3


def size_of(text: Column) -> Column:
    """Words of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _areas(knots: Knots) -> list[float]:
    return [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]


def total(knots: Knots) -> float:
    """The integral of a schedule."""
    return sum(_areas(knots))


def due(knots: Knots, share: Column) -> Column:
    """The time when the part ``share`` of the schedule's integral is reached."""
    whole, before = total(knots), 0.0
    out = F.lit(knots[-1][0])
    steps = []
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], _areas(knots), strict=False):
        rest = share * F.lit(whole) - F.lit(before)
        slope = (w1 - w0) / (t1 - t0)
        # The root of slope / 2 * x ** 2 + w0 * x = rest, in the form that needs no division by the slope.
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        steps.append((share * F.lit(whole) <= F.lit(before + area), F.lit(t0) + F.when(rest > 0, F.lit(2.0) * rest / (F.lit(w0) + root)).otherwise(0.0)))
        before += area
    for reached, time in reversed(steps):
        out = F.when(reached, time).otherwise(out)
    return out


def targets(sources: DataFrame, schedules: list[Knots] = SCHEDULES, repeats: int = REPEATS) -> DataFrame:
    """``_mix_kind`` (from 0) and ``_mix_target`` for each row of ``_mix_source, _mix_source_size``.

    The level up to which weights are filled is the largest of those that hold if the sources with the
    smallest caps for their weight are full.
    """
    ranked = sources.withColumn("_mix_kind", (F.row_number().over(Window.orderBy(F.col("_mix_source").asc_nulls_last())) - 1) % len(schedules))
    weight = F.element_at(F.array(*[F.lit(float(total(k))) for k in schedules]), F.col("_mix_kind") + 1)
    weighed = ranked.withColumn("w", weight).withColumn("cap", F.col("_mix_source_size") * repeats)
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("w"), F.col("_mix_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("_mix_source_size").over(everything) - F.coalesce(F.sum("cap").over(filled), F.lit(0))
    rest = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(filled), F.lit(0.0))
    level = weighed.withColumn("l", left.cast("double") / rest)
    filled_to = level.withColumn("l", F.max("l").over(everything))
    return filled_to.select("_mix_source", "_mix_source_size", "_mix_kind", F.least(F.col("cap").cast("double"), F.col("w") * F.col("l")).alias("_mix_target"))


def assign(docs: DataFrame, *, schedules: list[Knots] = SCHEDULES, repeats: int = REPEATS, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size") -> DataFrame:
    """The rows of ``docs`` with a struct ``_mix`` of ``source_size, target, taken, copies``.

    ``size_col`` holds the words of a row. ``copies`` is an array of ``(copy, words, position)``, empty if
    nothing is taken. ``docs`` should be cheap to read twice.
    """
    order = F.coalesce(F.md5(F.col(id_col).cast("string").cast("binary")), F.lit(""))
    rows = docs.withColumn("_mix_order", order).withColumn("_mix_source", F.col(source_col)).withColumn("_mix_size", F.col(size_col))
    # As many slices of a source as rows in a slice, roughly.
    digits = max(1, round(math.log(max(docs.count(), 1), 16) / 2))
    rows = rows.withColumn("_mix_slice", F.substring("_mix_order", 1, digits))
    slices = written(rows.groupBy("_mix_source", "_mix_slice").agg(F.sum("_mix_size").alias("n")), "mix-slices")
    wanted = targets(slices.groupBy("_mix_source").agg(F.sum("n").alias("_mix_source_size")), schedules, repeats)
    before = Window.partitionBy("_mix_source").orderBy("_mix_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("_mix_source", "_mix_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_mix_before"))
    named = offsets.alias("o").join(wanted.alias("t"), F.col("o._mix_source").eqNullSafe(F.col("t._mix_source"))).select("o.*", "t._mix_source_size", "t._mix_kind", "t._mix_target")
    # Two joins by the source's name and its nullness, so that the join key is also the window's.
    both = written(named.withColumn("_mix_null", F.col("_mix_source").isNull()).withColumn("_mix_source", F.coalesce("_mix_source", F.lit(""))), "mix-offsets")
    keyed = rows.withColumn("_mix_null", F.col("_mix_source").isNull()).withColumn("_mix_source", F.coalesce("_mix_source", F.lit("")))
    key = ["_mix_source", "_mix_null", "_mix_slice"]
    joined = keyed.join(both, key)
    inside = Window.partitionBy(*key).orderBy("_mix_order", id_col, "_mix_size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_mix_before") + F.coalesce(F.sum("_mix_size").over(inside), F.lit(0))
    placed = joined.withColumn("_mix_start", start).withColumn("_mix_words", F.floor("_mix_target"))
    copies = []
    for n in range(repeats):
        at = F.col("_mix_start") + F.col("_mix_source_size") * n
        words = F.greatest(F.least(F.col("_mix_words") - at, F.col("_mix_size")), F.lit(0)).cast("long")
        share = at.cast("double") / F.nullif(F.col("_mix_target"), F.lit(0.0))
        when = F.lit(None).cast("double")
        for kind, knots in enumerate(schedules):
            when = F.when(F.col("_mix_kind") == kind, due(knots, share)).otherwise(when)
        copies.append(F.when(words > 0, F.struct(F.lit(n).alias("copy"), words.alias("words"), when.alias("position"))))
    out = placed.withColumn("_mix_copies", F.filter(F.array(*copies), lambda c: c.isNotNull()))
    taken = F.aggregate("_mix_copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    mix = F.struct(F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"), taken.alias("taken"), F.col("_mix_copies").alias("copies"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], mix.alias("_mix"))


def scheduled(assigned: DataFrame, position: str = "position", id_col: str = "doc_id") -> DataFrame:
    """Rows range-sorted by position, ties by a hash of the id; rows that are never due come last.

    The hash also spreads the rows that are never due, which have no position, over many tasks.
    """
    by = [F.col(position).asc_nulls_last(), F.xxhash64(id_col)]
    return assigned.repartitionByRange(*by).sortWithinPartitions(*by)
