"""Stream sources and sinks of feed messages.

``format`` names the connector. The Kafka connector is an extra package of the
cluster; the file form has the same row shape and needs nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_OFFSETS_PER_TRIGGER = 400

_TRIP = T.StructType([T.StructField(c, T.StringType()) for c in ("trip_id", "route_id", "start_date", "direction")])
_UPDATE = T.StructType(
    [T.StructField("stop_id", T.StringType()), T.StructField("arrival", T.LongType()), T.StructField("departure", T.LongType())]
)
_TEXT = T.StructType([T.StructField("text", T.StringType()), T.StructField("language", T.StringType())])
_INFORMED = T.StructType([T.StructField(c, T.StringType()) for c in ("route_id", "trip_route_id", "trip_id")])
ENTITY = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vehicle", T.StructType([T.StructField("trip", _TRIP), T.StructField("current_status", T.StringType())])),
        T.StructField("trip_update", T.StructType([T.StructField("trip", _TRIP), T.StructField("stop_time_update", T.ArrayType(_UPDATE))])),
        T.StructField("alert", T.StructType([T.StructField("header", T.ArrayType(_TEXT)), T.StructField("informed", T.ArrayType(_INFORMED))])),
    ]
)
SNAPSHOT = T.StructType([T.StructField("feed_time", T.LongType()), T.StructField("entities", T.ArrayType(ENTITY))])
MESSAGE = T.StructType(
    [T.StructField("feed", T.StringType()), T.StructField("feed_time", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("entities", T.ArrayType(ENTITY))]
)


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", max_offsets)
        .option("includeHeaders", "true")
        .load()
    )


def file_stream(spark: SparkSession, path: str, schema: T.StructType = MESSAGE, max_files: int | None = None) -> DataFrame:
    """Landed messages in Parquet; new files are the stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def decode(records: DataFrame) -> DataFrame:
    """(key, value, offset) records with JSON values to messages."""
    value = F.from_json(F.col("value").cast("string"), SNAPSHOT)
    return records.select(
        F.coalesce(F.col("key").cast("string"), F.lit("")).alias("feed"),
        value["feed_time"].alias("feed_time"),
        F.col("offset"),
        value["entities"].alias("entities"),
    )


def encode(messages: DataFrame, fetched_at=None) -> DataFrame:
    """Messages to keyed records with a ``fetched_at`` header, as a sink takes them."""
    at = F.col("feed_time") if fetched_at is None else fetched_at
    header = F.struct(F.lit("fetched_at").alias("key"), at.cast("string").cast("binary").alias("value"))
    return messages.select(
        F.col("feed").cast("binary").alias("key"),
        F.to_json(F.struct("feed_time", "entities")).cast("binary").alias("value"),
        F.array(header).alias("headers"),
    )


def write_records(records: DataFrame, format: str, **options: str) -> None:
    records.write.format(format).options(**options).mode("append").save()


def read_offsets(spark: SparkSession, first: int, end: int, *, format: str = "parquet", path: str | None = None, servers: str = "", topic: str = "") -> DataFrame:
    """Records with offsets in ``[first, end)`` of a topic or of landed files."""
    if format == "kafka":
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", f'{{"{topic}":{{"0":{first}}}}}')
            .option("endingOffsets", f'{{"{topic}":{{"0":{end}}}}}')
            .load()
        )
    return offset_range(spark.read.format(format).load(path), first, end)


def offset_range(records: DataFrame, first: int, end: int) -> DataFrame:
    return records.where((F.col("offset") >= first) & (F.col("offset") < end))
