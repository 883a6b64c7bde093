"""Scans of landed files and the partitioned writes of each layer."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import model
from tidemark.functions import timefns


class HeaderError(ValueError):
    """The header of a file is not the declared one."""


def read_csv(spark: SparkSession, path, schema: T.StructType = model.SOURCE_SCHEMA, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with declared types and columns: empty fields are NULL, bad rows stop the read."""
    df = spark.read.schema(schema).option("header", True).option("nullValue", "").option("mode", "FAILFAST").csv(path)
    return df.select(*columns) if columns else df


def read_csv_strict(spark: SparkSession, path, schema: T.StructType = model.SOURCE_SCHEMA) -> DataFrame:
    """As :func:`read_csv`, and the header must list exactly the declared columns, in order."""
    found = spark.read.option("header", True).csv(path).columns
    if found != schema.fieldNames():
        raise HeaderError(f"header {found} differs from {schema.fieldNames()}")
    reader = spark.read.schema(schema).option("header", True).option("nullValue", "").option("mode", "FAILFAST")
    return reader.option("enforceSchema", False).csv(path)


def typed_records(raw: DataFrame) -> DataFrame:
    """Records whose numbers are text and whose point is an object, as typed fact columns."""
    lon, lat = (F.get(F.col("georeference.coordinates"), F.lit(i)) for i in (0, 1))
    text = {
        "ridership": F.col("ridership").try_cast("double"),
        "transfers": F.col("transfers").try_cast("double"),
        "latitude": F.col("latitude").try_cast("double"),
        "longitude": F.col("longitude").try_cast("double"),
        "transit_timestamp": F.to_timestamp_ntz("transit_timestamp"),
        "georeference": F.format_string("POINT (%s %s)", lon.cast("string"), lat.cast("string")),
    }
    return raw.select(*[text.get(c, F.col(c)).alias(c) for c in model.SOURCE_COLUMNS])


RECORD_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType())
        if c != "georeference"
        else T.StructField(c, T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.ArrayType(T.DoubleType()))]))
        for c in model.SOURCE_COLUMNS
    ]
)


def read_records(spark: SparkSession, path) -> DataFrame:
    """JSON records as the portal returns them."""
    return typed_records(spark.read.schema(RECORD_SCHEMA).json(path))


def read_variant_records(spark: SparkSession, path) -> DataFrame:
    """JSON lines of any shape as ``VARIANT``: ``record`` (NULL if the line is no JSON object) beside the ``line``."""
    record = F.try_parse_json("value")
    whole = F.schema_of_variant(record).startswith("OBJECT")
    return spark.read.text(path).select(F.col("value").alias("line"), F.when(whole, record).alias("record"))


def typed_variants(records: DataFrame) -> DataFrame:
    """Fact columns of variant records, each field by its own path and whatever form it comes in.

    Numbers may be numbers or text, the point an object with coordinates or text. A field that is absent or can't be
    read is NULL; ``bad`` marks lines that are no record.
    """
    r = F.col("record")

    def text(name: str) -> Column:
        return F.try_variant_get(r, f"$.{name}", "string")

    lon, lat = (F.try_variant_get(r, f"$.georeference.coordinates[{i}]", "double") for i in (0, 1))
    point = F.when(lon.isNotNull(), F.format_string("POINT (%s %s)", lon.cast("string"), lat.cast("string"))).otherwise(
        F.when(F.schema_of_variant(F.try_variant_get(r, "$.georeference", "variant")) == "STRING", text("georeference"))
    )
    typed = {
        **{c: text(c).try_cast("double") for c in ("ridership", "transfers", "latitude", "longitude")},
        "transit_timestamp": F.try_to_timestamp(text("transit_timestamp")).cast("timestamp_ntz"),
        "georeference": point,
    }
    return records.select(*[typed.get(c, text(c)).alias(c) for c in model.SOURCE_COLUMNS], r.isNull().alias("bad"))


def read_parquet(spark: SparkSession, *paths: str, folders_as_columns: bool = True) -> DataFrame:
    """One file, several files or a glob; optionally without the partition folders as columns."""
    reader = spark.read if folders_as_columns else spark.read.option("recursiveFileLookup", True)
    return reader.parquet(*paths)


# --- writes -------------------------------------------------------------------


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows gathered by folder columns for a write.

    Adaptive execution splits a folder that outgrows one task and merges small
    ones, so neither a hot month nor many empty ones hurt.
    """
    return df.hint("rebalance", *columns)


def write_months(
    df: DataFrame, path: str, ts: str = "transit_timestamp", keys: Sequence[str] = model.ROW_KEY, finish: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Key-sorted files under ``year=/month=``; only the months present are replaced.

    ``finish`` is applied to the gathered and sorted rows, in the stage that writes them; it must keep ``year`` and ``month``.
    """
    parts = df.withColumns({"year": F.year(ts), "month": F.month(ts)})
    rows = balanced(parts, "year", "month").sortWithinPartitions("year", "month", *keys)
    (
        (finish(rows) if finish else rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("year", "month")
        .parquet(path)
    )


def with_bookkeeping(df: DataFrame, updated: Column, fetched: Column) -> DataFrame:
    """Raw rows plus the instant of the source's last change and of the fetch."""
    return df.withColumns({"source_updated_at": updated, "fetched_at": fetched})


def write_days(df: DataFrame, path: str, ts: str = "transit_timestamp", keys: Sequence[str] = model.ROW_KEY) -> None:
    """Raw layer: one folder per day, replaced day by day."""
    days = df.withColumn("day", F.to_date(ts))
    (
        balanced(days, "day")
        .sortWithinPartitions("day", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("day")
        .parquet(path)
    )


def land_new_rows(df: DataFrame, path: str, ingest_date: str) -> None:
    """Append one cycle's new rows under their ingest date."""
    df.withColumn("ingest_date", F.lit(ingest_date).cast("date")).write.mode("append").partitionBy("ingest_date").parquet(path)


def export_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Headered CSV in a global order; range partitioning keeps the sort distributed."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def append_log(spark: SparkSession, path: str, entry: dict, schema: str) -> None:
    """One JSON line per cycle."""
    spark.createDataFrame([entry], schema).coalesce(1).write.mode("append").json(path)


def months_of(df: DataFrame, ts: str = "transit_timestamp") -> DataFrame:
    return df.select(timefns.month_start(ts).alias("month")).distinct()
