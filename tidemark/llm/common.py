"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.session import configure, scratch

#: Rows of one Arrow batch. Texts can be very long, so batches stay short.
BATCH_ROWS = 500
#: Word characters: everything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back, so that later steps don't run it again."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """``fn`` for each Arrow batch of ``df``. Columns may have any name, dots included."""
    names = df.columns
    kinds = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    outer = StructType([StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield fn(b.rename_columns(names)).rename_columns(outer.names)

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, outer).toDF(*kinds.names)


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``size`` bytes."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def texts(column: pa.Array) -> list[str]:
    """Strings of an Arrow column, null as the empty string."""
    return [t or "" for t in column.to_pylist()]


def byte_strings(column: pa.Array) -> list[bytes]:
    """The values of a binary or string column, several times faster than by ``to_pylist``."""
    return column.to_numpy(zero_copy_only=False).tolist()


_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts of a binary column without nulls, end to end, and how many each text has."""
    offsets = np.frombuffer(column.buffers()[1] or bytes(4), np.int32)[column.offset : column.offset + len(column) + 1]
    begin, end = (int(offsets[0]), int(offsets[-1])) if len(column) else (0, 0)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[begin:end]
    inside = _IN_WORD[data]
    # A word begins behind white space and at the start of a text.
    goes_on = np.zeros(len(data), bool)
    goes_on[1:] = inside[:-1]
    cuts = offsets - begin
    goes_on[cuts[cuts < len(data)]] = False
    begins = inside & ~goes_on
    packed = data[inside]
    at = np.append(np.flatnonzero(begins[inside]), len(packed)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(packed)])
    return words, np.diff(np.searchsorted(np.flatnonzero(begins), cuts)) if len(column) else np.zeros(0, np.int64)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_hash(doc_id: Column) -> Column:
    """crc32 of the id written as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary"))
