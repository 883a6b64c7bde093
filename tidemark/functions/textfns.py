"""Text, point and identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: departure time, route and direction at the front of a trip id.
TRIP_KEY_PATTERN = r"^(\d{6}_[^.]+\.\.[NS])"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    return F.trim(_c(c)) == ""


def point_text(lon, lat) -> Column:
    """Well-known text of a point."""
    return F.format_string("POINT (%s %s)", _c(lon).cast("string"), _c(lat).cast("string"))


def point_lon(c) -> Column:
    return F.split(F.btrim(_c(c), F.lit("POINT ()")), " ")[0].try_cast("double")


def point_lat(c) -> Column:
    return F.get(F.split(F.btrim(_c(c), F.lit("POINT ()")), " "), F.lit(1)).try_cast("double")


def text_before(c, separator: str) -> Column:
    return F.substring_index(_c(c), separator, 1)


def trip_key(c) -> Column:
    """Key shared by realtime and scheduled trips; NULL for non-standard ids."""
    found = F.regexp_extract(_c(c), TRIP_KEY_PATTERN, 1)
    return F.when(found != "", found)


def static_trip_key(c) -> Column:
    """Key of a scheduled trip id, which carries a prefix up to its first underscore."""
    return trip_key(F.regexp_replace(_c(c), r"^[^_]*_", ""))


def stop_code(c) -> Column:
    """Stop id without its direction suffix."""
    return F.substring(_c(c), 1, 3)


def document_key(*parts) -> Column:
    """Parts joined with ``|``; a NULL part counts as empty text."""
    return F.concat_ws("|", *[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts])


def shorten(c, length: int) -> Column:
    return F.left(_c(c), F.lit(length))


def month_range_label(c) -> Column:
    """A comma-separated month list as ``first–last``; a single month stays as it is."""
    return F.regexp_replace(_c(c), r"^([^,]+),.*?([^, ]+)$", "$1–$2")
