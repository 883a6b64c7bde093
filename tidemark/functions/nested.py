"""Expressions over the arrays of decoded feed messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: predictions older than this many seconds before the snapshot are past.
PAST_SECONDS = 30


def predicted_time(update: Column) -> Column:
    """Arrival time, or departure time when the arrival is missing or zero."""
    return F.coalesce(F.nullif(update["arrival"], F.lit(0)), update["departure"], F.lit(0))


def upcoming(updates: Column, feed_time: Column) -> Column:
    return F.filter(updates, lambda u: predicted_time(u) >= feed_time - PAST_SECONDS)


def first_or_null(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def sorted_ids(items: Column) -> Column:
    """Distinct non-blank ids in order."""
    return F.array_sort(F.array_distinct(F.filter(items, lambda x: x.isNotNull() & (x != ""))))


def first_in_language(translations: Column, languages=("", "en")) -> Column:
    """Text of the first translation in one of the languages, else an empty text."""
    match = F.filter(translations, lambda t: F.coalesce(t["language"], F.lit("")).isin(*languages))
    return F.coalesce(first_or_null(match)["text"], F.lit(""))
