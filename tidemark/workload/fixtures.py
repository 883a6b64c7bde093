"""The given tables seen as the relations the operators work on.

``events`` plays the hourly fact: a station is a user, the hour is the event
hour moved 60 days on so that the span holds a clock change, the counts come
from ``value`` and the attributes from ``event_type`` and the ``k`` of
``props``. Every relation here is a row-wise projection of a whole table, and
its SQL twin is the text beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import SOURCE_COLUMNS
from tidemark.operators.quality import clean, station_mode, with_station_mode


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Expressions valid in both engines, over events columns plus k and hour.
_SHARED = {
    "station_complex": "concat('Station ', CAST(CAST(floor(user_id / 2) AS BIGINT) AS {text}), "
    "CASE WHEN event_type = 'purchase' THEN ' Annex' ELSE '' END)",
    "transit_mode": "CASE event_type WHEN 'error' THEN 'tram' WHEN 'signup' THEN 'staten_island_railway' ELSE 'subway' END",
    "borough": "CASE user_id % 5 WHEN 0 THEN 'Bronx' WHEN 1 THEN 'Brooklyn' WHEN 2 THEN 'Manhattan' WHEN 3 THEN 'Queens' "
    "ELSE 'Staten Island' END",
    "payment_method": "CASE WHEN k < 60 THEN 'omny' ELSE 'metrocard' END",
    "fare_class_category": "CASE WHEN k < 40 THEN 'OMNY - Full Fare' WHEN k < 60 THEN 'OMNY - Other' "
    "WHEN k < 80 THEN 'Metrocard - Full Fare' ELSE 'Metrocard - Other' END",
    "latitude": "CAST(40.50 + (user_id % 40) * 0.01 AS DOUBLE)",
    "longitude": "CAST(-74.20 + (user_id % 45) * 0.01 AS DOUBLE)",
}
_CLEAN = {
    "transit_timestamp": "hour",
    "station_complex_id": "CAST(user_id AS {text})",
    "ridership": "floor(value) + CAST(1 AS DOUBLE)",
    "transfers": "CAST(floor(value / 4) - 2 AS DOUBLE)",
    "georeference": "concat('POINT (', CAST(longitude AS {text}), ' ', CAST(latitude AS {text}), ')')",
}
# The same rows with one kind of damage per value of k.
_DIRTY = {
    **_CLEAN,
    "transit_timestamp": "CASE WHEN k = 9 THEN shifted ELSE hour END",
    "station_complex_id": "CASE WHEN k <> 6 THEN CAST(user_id AS {text}) END",
    "ridership": "CASE WHEN k = 1 THEN value WHEN k = 2 THEN CAST(0 AS DOUBLE) ELSE floor(value) + CAST(1 AS DOUBLE) END",
    "transfers": "CAST(floor(k / 2) - 3 AS DOUBLE)",
    "payment_method": "CASE WHEN k < 61 THEN 'omny' ELSE 'metrocard' END",
    "borough": "CASE k WHEN 4 THEN NULL WHEN 5 THEN 'Hoboken' ELSE {borough} END",
    "latitude": "CASE WHEN k = 7 THEN CAST(0 AS DOUBLE) ELSE {latitude} END",
    "georeference": "CASE WHEN k = 8 THEN 'POINT (0.0 0.0)' ELSE {point} END",
}


def _expressions(dirty: bool, text: str) -> dict[str, str]:
    out = {**_SHARED, **_CLEAN}
    if dirty:
        fill = {"borough": _SHARED["borough"], "latitude": _SHARED["latitude"], "point": _CLEAN["georeference"]}
        damaged = {k: v.replace("{borough}", fill["borough"]).replace("{latitude}", fill["latitude"]).replace("{point}", fill["point"]) for k, v in _DIRTY.items()}
        out.update(damaged)
    return {c: out[c].replace("{text}", text) for c in SOURCE_COLUMNS}


def _fact(spark: SparkSession, sf_dir: str, dirty: bool) -> DataFrame:
    e = table(spark, sf_dir, "events")
    shifted = F.col("ts") + F.expr("INTERVAL 60 DAY")
    base = e.select(
        "*",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        shifted.alias("shifted"),
        F.date_trunc("hour", shifted).cast("timestamp_ntz").alias("hour"),
    )
    ex = _expressions(dirty, "STRING")
    points = ["latitude", "longitude"]
    rows = base.select("*", *[F.expr(ex[c]).alias(c) for c in points])
    return rows.select(
        *[F.col(c) if c in points else F.expr(ex[c]).alias(c) for c in SOURCE_COLUMNS],
        (F.col("hour") + F.expr("INTERVAL 7 DAY")).alias("source_updated_at"),
    )


def _fact_sql(dirty: bool) -> str:
    ex = _expressions(dirty, "VARCHAR")
    cols = ", ".join(f"{ex[c]} AS {c}" if c not in ("latitude", "longitude") else c for c in SOURCE_COLUMNS)
    return (
        f"SELECT {cols}, hour + INTERVAL 7 DAY AS source_updated_at FROM (SELECT *, {ex['latitude']} AS latitude, {ex['longitude']} AS longitude FROM ("
        "SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, ts + INTERVAL 60 DAY AS shifted, "
        "CAST(date_trunc('hour', ts + INTERVAL 60 DAY) AS TIMESTAMP) AS hour FROM events))"
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly fact with repairable faults only."""
    return _fact(spark, sf_dir, dirty=False)


def dirty_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly fact with at least one fault of every kind."""
    return _fact(spark, sf_dir, dirty=True)


def moded(df: DataFrame) -> DataFrame:
    """Rows with the dominant mode of their station."""
    return with_station_mode(df, station_mode(df))


def clean_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(moded(fact(spark, sf_dir)))


FACT = f"fact AS ({_fact_sql(False)})"
DIRTY = f"fact AS ({_fact_sql(True)})"

# Rows with station_mode, over the CTE fact.
MODED = """station_mode AS (
  SELECT station_complex_id, transit_mode AS station_mode FROM (
    SELECT station_complex_id, transit_mode, row_number() OVER (PARTITION BY station_complex_id ORDER BY count(*) DESC, transit_mode DESC) AS rn
    FROM fact WHERE station_complex_id IS NOT NULL GROUP BY station_complex_id, transit_mode) WHERE rn = 1),
moded AS (SELECT fact.*, station_mode FROM fact LEFT JOIN station_mode USING (station_complex_id))"""

_LOCAL = "AT TIME ZONE 'America/New_York'"


def dst_sql(c: str) -> str:
    """Clock-change test of a wall-clock hour."""
    u = f"({c} {_LOCAL})"
    return (
        f"({u} {_LOCAL} <> {c} OR ({u} + INTERVAL 1 HOUR) {_LOCAL} = {c} OR ({u} - INTERVAL 1 HOUR) {_LOCAL} = {c})"
    )


CLEAN = f"""{FACT}, {MODED}, clean AS (
  SELECT transit_timestamp, coalesce(station_mode, transit_mode) AS transit_mode, station_complex_id, station_complex, borough,
         payment_method, fare_class_category, CAST(ridership AS INT) AS ridership, CAST(greatest(transfers, 0) AS INT) AS transfers,
         latitude, longitude, georeference, {dst_sql('transit_timestamp')} AS is_dst_transition
  FROM moded)"""
