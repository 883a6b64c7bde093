"""Replaceable tables on plain Parquet.

Every write goes to a new version folder; a version counts once Spark's commit
marker is in it, so readers see the old table or the new one and a failed or
repeated write leaves nothing half done. Old versions are removed after the
switch.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import upsert as merge
from tidemark.session import scratch
from tidemark.sources.files import balanced


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one folder of a table this library owns."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Let a finished folder appear under its name, unless that name is taken; then the folder is removed."""
    fs, old = _fs(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(new.getParent())
    if not fs.exists(new) and fs.rename(old, new):
        return True
    fs.delete(old, True)
    return False


def set_age(spark: SparkSession, folder: str, seconds: int) -> None:
    """Give the files of a folder a time of change: so many seconds after a fixed instant. Streams read files by age."""
    fs, p = _fs(spark, folder)
    for status in fs.listStatus(p):
        fs.setTimes(status.getPath(), 1_600_000_000_000 + 1000 * seconds, -1)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def committed(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete folders ``prefix=N`` below a path."""
    found = []
    for name in children(spark, path):
        m = re.fullmatch(rf"{prefix}=(\d+)", name)
        if m and exists(spark, f"{path}/{name}/_SUCCESS"):
            found.append(int(m.group(1)))
    return sorted(found)


def written_once(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of a relation several steps read by writing it to the shared folder."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Table:
    """A small or medium table that is replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keep: int = 2):
        self.spark, self.path, self.schema, self.keep = spark, path, schema, keep

    def versions(self) -> list[int]:
        return committed(self.spark, self.path, "version")

    def read(self) -> DataFrame:
        versions = self.versions()
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/version={versions[-1]:012d}")

    def replace(self, df: DataFrame) -> None:
        """Write the next version. ``df`` may read the current one."""
        versions = self.versions()
        number = versions[-1] + 1 if versions else 0
        columns = [f.strip().split()[0] for f in self.schema.split(",")]
        df.select(*columns).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/version={number:012d}")
        for old in versions[: -self.keep] if self.keep else []:
            remove(self.spark, f"{self.path}/version={old:012d}")

    def upsert(self, incoming: DataFrame, keys: list[str]) -> None:
        self.replace(merge.upsert(self.read(), incoming, keys))

    def add(self, delta: DataFrame, keys: list[str], sums: list[str], maxima: list[str] = ()) -> None:
        self.replace(merge.additive_upsert(self.read(), delta, keys, sums, maxima))

    def delete_missing(self, source: DataFrame, keys: list[str]) -> None:
        self.replace(merge.delete_missing(self.read(), source, keys))

    def retain(self, ts: str, days: int) -> None:
        self.replace(merge.retain_days(self.read(), ts, days))

    def keep_newest(self, group: str, order: str, n: int) -> None:
        self.replace(merge.newest_per_group(self.read(), group, order, n))


class BucketTable:
    """A keyed table in hash buckets of its key; a merge reads and rewrites only the buckets its keys fall into.

    A merge writes its buckets to a folder of its own and then a manifest that says for every bucket which folder holds it. The
    manifest counts once Spark's commit marker is in it, so all buckets of a merge appear at once, and a merge that died is
    not seen. A manifest has one row a bucket. What no kept manifest names is removed.
    """

    MANIFEST = "bucket int, folder string"

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = 64, keep: int = 2):
        self.spark, self.path, self.schema, self.keys, self.buckets, self.keep = spark, path, schema, keys, buckets, keep
        self.columns = [f.strip().split()[0] for f in schema.split(",")]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        return committed(self.spark, f"{self.path}/manifest", "version")

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """Folder of every bucket that has rows; at most as many as there are buckets."""
        versions = self.versions() if version is None else [version]
        if not versions:
            return {}
        rows = self.spark.read.schema(self.MANIFEST).parquet(f"{self.path}/manifest/version={versions[-1]}")
        return {r.bucket: r.folder for r in rows.collect()}

    def read(self, only: set[int] | None = None) -> DataFrame:
        folders = [f"{self.path}/{folder}" for k, folder in sorted(self.manifest().items()) if only is None or k in only]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Stored rows of the given keys; other buckets are not read."""
        touched = {r[0] for r in keys.select(self.bucket()).distinct().collect()}
        return self.read(touched).join(keys.select(*self.keys).distinct(), self.keys, "left_semi")

    def _merge(self, incoming: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], touched: set[int] | None = None) -> None:
        """Replace the touched buckets (by default those of the incoming keys) by ``how(stored, incoming)``."""
        incoming = written_once(incoming.select(*self.columns), "incoming")
        if touched is None:
            touched = {r[0] for r in incoming.select(self.bucket()).distinct().collect()}
        versions, now = self.versions(), self.manifest()
        number = versions[-1] + 1 if versions else 0
        folder = f"data/merge={number}"
        merged = how(self.read(touched), incoming).select(*self.columns).withColumn("bucket", self.bucket())
        balanced(merged, "bucket").write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self.path}/{folder}")
        written = {int(n.partition("=")[2]) for n in children(self.spark, f"{self.path}/{folder}") if n.startswith("bucket=")}
        after = {k: f for k, f in now.items() if k not in touched} | {k: f"{folder}/bucket={k}" for k in written}
        rows = self.spark.createDataFrame(sorted(after.items()), self.MANIFEST).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}/manifest/version={number}")
        self._clean()

    def _clean(self) -> None:
        versions = self.versions()
        kept = versions[-self.keep :]
        named = {folder for v in kept for folder in self.manifest(v).values()}
        for number in committed(self.spark, f"{self.path}/data", "merge"):
            folder = f"data/merge={number}"
            held = [f"{folder}/{n}" for n in children(self.spark, f"{self.path}/{folder}") if n.startswith("bucket=")]
            for old in set(held) - named:
                remove(self.spark, f"{self.path}/{old}")
            if number not in kept and named.isdisjoint(held):
                remove(self.spark, f"{self.path}/{folder}")
        for v in versions[: -self.keep]:
            remove(self.spark, f"{self.path}/manifest/version={v}")

    def replace(self, df: DataFrame) -> None:
        self._merge(df, lambda stored, rows: rows, set(range(self.buckets)))

    def upsert(self, incoming: DataFrame) -> None:
        """Incoming rows win, one row a key."""
        self._merge(incoming, lambda stored, rows: merge.upsert(stored, rows, self.keys))

    def add(self, delta: DataFrame, sums: list[str], maxima: list[str] = ()) -> None:
        """Counts and sums are added, maxima merged."""
        self._merge(delta, lambda stored, rows: merge.additive_upsert(stored, rows, self.keys, sums, maxima))

    def delete(self, keys: DataFrame) -> None:
        """Remove the rows of the given keys."""
        wanted = written_once(keys.select(*self.keys).distinct(), "deleted")
        touched = {r[0] for r in wanted.select(self.bucket()).distinct().collect()}
        none = self.spark.createDataFrame([], self.schema)
        self._merge(none, lambda stored, _: stored.join(wanted, self.keys, "left_anti"), touched)


def bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """``df`` stored in hash buckets of the keys, sorted in each, and registered as table ``name``.

    Tables with the same buckets join on those keys without moving either side, however often they are joined.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # One file a bucket: rows are dealt by the hash the buckets use.
    gathered = df.repartition(buckets, *keys)
    gathered.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    return spark.table(name)


class MonthTable:
    """A large fact in month folders; a month is the unit of replacement."""

    def __init__(self, spark: SparkSession, path: str, day: str):
        self.spark, self.path, self.day = spark, path, day

    def read(self) -> DataFrame | None:
        if not any(n.startswith("month=") for n in children(self.spark, self.path)):
            return None
        return self.spark.read.parquet(self.path).drop("month")

    def read_months(self, months: list) -> DataFrame:
        """Rows of some months; the folders of others are not read."""
        wanted = F.col("month").isin([m.replace(day=1) for m in months])
        return self.spark.read.parquet(self.path).where(wanted).drop("month")

    def replace_months(self, df: DataFrame) -> None:
        """Replace every month that occurs in ``df``; other months stay untouched."""
        months = df.withColumn("month", F.date_format(F.col(self.day), "yyyy-MM-01"))
        (
            balanced(months, "month")
            .sortWithinPartitions("month", self.day)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy("month")
            .parquet(self.path)
        )

    def delete_month(self, month) -> None:
        remove(self.spark, f"{self.path}/month={month:%Y-%m}-01")
