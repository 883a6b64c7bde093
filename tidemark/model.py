"""The hourly fact: schema, row identity and the fixed values its rules use."""

from __future__ import annotations

from pyspark.sql import types as T

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("transit_timestamp", T.TimestampNTZType()),
        T.StructField("transit_mode", T.StringType()),
        T.StructField("station_complex_id", T.StringType()),
        T.StructField("station_complex", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("fare_class_category", T.StringType()),
        T.StructField("ridership", T.DoubleType()),
        T.StructField("transfers", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("georeference", T.StringType()),
    ]
)
SOURCE_COLUMNS = SOURCE_SCHEMA.fieldNames()

# Row identity, also the sort order of stored files.
ROW_KEY = ["transit_timestamp", "station_complex_id", "payment_method", "fare_class_category"]

# Category lists and the two bounding boxes of the city.
MODES = ["subway", "staten_island_railway", "tram"]
METHODS = ["omny", "metrocard"]
BOROUGHS = ["Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island"]
CITY_BOX = {"lat": (40.47, 40.92), "lon": (-74.26, -73.70)}
PROFILE_BOX = {"lat": (40.49, 40.92), "lon": (-74.26, -73.68)}
LOCAL_ZONE = "America/New_York"
AM_HOURS = [6, 7, 8, 9]
PM_HOURS = [16, 17, 18, 19]
