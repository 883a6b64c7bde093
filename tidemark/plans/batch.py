"""The batch jobs: raw days to clean months to marts, and the month-wise variant.

Both are plain functions over the operators. Relations that several steps read
are written once; what reaches the driver is a list of months, which the
calendar bounds, and the rule counts.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import model
from tidemark.functions import timefns
from tidemark.operators import incremental, marts, quality
from tidemark.operators.upsert import month_list
from tidemark.session import configure, scratch, scratch_scope
from tidemark.sources import files
from tidemark.sources.tables import MonthTable, Table, children, exists, remove, rename, written_once

FINGERPRINT = "day date, rows bigint, ridership double, transfers double, source_updated_at timestamp_ntz"
RUNS = (
    "run_id string, job string, started_at timestamp, finished_at timestamp, status string, stage string, "
    "days_fetched bigint, rows_fetched bigint, months_built string, message string"
)
VERSIONS = "month date, rows bigint, source_updated_at timestamp_ntz, built_at timestamp"
QUALITY = "month date, tag string, severity string, rows bigint"
STATION = "station_complex_id string, station_complex string, borough string, transit_mode string, latitude double, longitude double"
DATES = "date date, year int, month int, day int, day_of_week int, is_weekend boolean"
PROFILE = "station_complex_id string, day_type string, hour_of_day int, mean_ridership double"

MESSAGE_LENGTH = 500
#: Months that one scan counts and writes; it bounds the number of counted expressions.
MONTHS_AT_ONCE = 6


@dataclass
class Lake:
    """Folders of one data set and the tables in them."""

    spark: SparkSession
    path: str

    @property
    def raw(self) -> str:
        return f"{self.path}/raw"

    @property
    def clean(self) -> str:
        return f"{self.path}/clean"

    def small(self, name: str, schema: str) -> Table:
        return Table(self.spark, f"{self.path}/{name}", schema)

    def fact(self, name: str, day: str) -> MonthTable:
        return MonthTable(self.spark, f"{self.path}/{name}", day)

    fingerprints = property(lambda self: self.small("fingerprints", FINGERPRINT))
    runs = property(lambda self: self.small("runs", RUNS))
    versions = property(lambda self: self.small("clean_versions", VERSIONS))
    quality = property(lambda self: self.small("quality_month", QUALITY))
    stations = property(lambda self: self.small("dim_station", STATION))
    dates = property(lambda self: self.small("dim_date", DATES))
    profile = property(lambda self: self.small("station_hour_profile", PROFILE))
    hourly = property(lambda self: self.fact("ridership_hourly", "hour"))
    daily_station = property(lambda self: self.fact("ridership_daily_station", "day"))
    daily_class = property(lambda self: self.fact("ridership_daily_class", "day"))
    station_parts = property(lambda self: self.fact("station_parts", "first_day"))
    profile_parts = property(lambda self: self.fact("profile_parts", "first_day"))

    @property
    def facts(self) -> dict[str, MonthTable]:
        """Every table kept by month."""
        names = ("hourly", "daily_station", "daily_class", "station_parts", "profile_parts")
        return {n: getattr(self, n) for n in names}


def fingerprint(source: DataFrame) -> DataFrame:
    return incremental.day_fingerprint(
        source, marts.TS, {"ridership": F.col("ridership"), "transfers": F.col("transfers")}, "source_updated_at"
    )


class Run:
    """Start and finish rows of one run in the run log."""

    def __init__(self, lake: Lake, job: str):
        self.lake, self.id, self.job, self.stage = lake, str(uuid.uuid4()), job, "start"
        self.started = dt.datetime.now(dt.timezone.utc)
        self._write(None, "running", 0, 0, [], None)

    def _write(self, finished, status, days, rows, months, message):
        row = (self.id, self.job, self.started, finished, status, self.stage, days, rows, month_list(months), (message or "")[:MESSAGE_LENGTH])
        self.lake.runs.upsert(self.lake.spark.createDataFrame([row], RUNS), ["run_id"])

    def finish(self, status: str, days: int = 0, rows: int = 0, months=(), message: str | None = None) -> None:
        self._write(dt.datetime.now(dt.timezone.utc), status, days, rows, months, message)


def _months(df: DataFrame) -> list[dt.date]:
    return sorted(r.month for r in df.select("month").distinct().toLocalIterator())


def _in_months(ts, months: list[dt.date]):
    return timefns.month_start(ts).isin(months)


def run_batch(lake: Lake, source: DataFrame, limit_days: int | None = None, rebuild: bool = False) -> Run:
    """Load every changed day of the source and rebuild the months it touches."""
    configure(lake.spark)
    run = Run(lake, "batch")
    try:
        with scratch_scope(lake.spark):
            _run_batch(lake, source, limit_days, rebuild, run)
    except Exception as error:
        run.finish("failed", message=f"{type(error).__name__}: {error}")
        raise
    return run


def _run_batch(lake: Lake, source: DataFrame, limit_days: int | None, rebuild: bool, run: Run) -> None:
    run.stage = "plan"
    server = written_once(fingerprint(source), "server")
    stored = lake.fingerprints.read()
    changes = written_once(incremental.changed_days(server, stored), "changes")
    removed = [r.day for r in changes.where("change = 'removed'").toLocalIterator()]
    fetch = changes.where("change <> 'removed'")
    if limit_days is not None:
        fetch = written_once(incremental.newest_days(fetch, limit_days), "fetch")
    counts = fetch.join(server, "day").agg(F.count("*").alias("days"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    touched = set(_months(fetch.select(timefns.month_start("day").alias("month")))) | {d.replace(day=1) for d in removed}

    run.stage = "extract"
    if counts.days:
        rows = source.withColumn("_d", F.to_date(marts.TS)).join(fetch.select(F.col("day").alias("_d")), "_d", "left_semi").drop("_d")
        landed = files.with_bookkeeping(rows, F.col("source_updated_at"), F.current_timestamp())
        files.write_days(landed, lake.raw)
    for day in removed:
        remove(lake.spark, f"{lake.raw}/day={day}")
    # Only now: a day counts as stored when its file is written.
    if counts.days or removed:
        fresh = server.join(fetch.select("day"), "day", "left_semi")
        kept = stored.join(changes.where("change = 'removed'").select("day"), "day", "left_anti")
        kept = kept.join(fetch.select("day"), "day", "left_anti")
        lake.fingerprints.replace(kept.unionByName(fresh))

    if not any(n.startswith("day=") for n in children(lake.spark, lake.raw)):
        for month in touched:
            drop_month(lake, month)
        run.finish("success", counts.days, counts.rows, touched)
        return
    raw = files.read_parquet(lake.spark, lake.raw)
    present = set(_months(lake.fingerprints.read().select(timefns.month_start("day").alias("month"))))
    # Months an earlier run fetched but could not build are due as well.
    months = sorted(present if rebuild else (touched | set(_months(stale_months(lake)))) & present)
    build_months(lake, raw, months, run)
    vanished = sorted(touched - present)
    for month in vanished:
        drop_month(lake, month)
    if months or vanished:
        run.stage = "full marts"
        build_full_marts(lake)
    run.stage = "done"
    run.finish("success", counts.days, counts.rows, months)


def stale_months(lake: Lake) -> DataFrame:
    """Months whose fetched days are not what their clean version was built from."""
    fetched = lake.fingerprints.read().groupBy(timefns.month_start("day").alias("month")).agg(F.sum("rows").alias("_rows"))
    built = fetched.join(lake.versions.read().select("month", "rows"), "month", "left")
    return built.where(~F.col("_rows").eqNullSafe(F.col("rows"))).select("month")


def build_months(lake: Lake, raw: DataFrame, months: list[dt.date], run: Run | None = None) -> None:
    """Write the clean rows of all months aside, publish them if the gate passes, then marts, versions and rule counts.

    One scan of a month's rows counts every rule and writes its clean form.
    """
    if not months:
        return
    stage = lambda s: setattr(run, "stage", s) if run else None
    stage("gate")
    rules = quality.fact_rules()
    mode = quality.station_mode(raw)
    staged = scratch(lake.spark, "clean-staged")
    parts = [months[i : i + MONTHS_AT_ONCE] for i in range(0, len(months), MONTHS_AT_ONCE)]
    counted = [_write_clean(raw, mode, rules, part, staged) for part in parts]
    for c in counted:
        c.check()

    stage("clean")
    for month in months:
        folder = f"year={month.year}/month={month.month}"
        remove(lake.spark, f"{lake.clean}/{folder}")
        rename(lake.spark, f"{staged}/{folder}", f"{lake.clean}/{folder}")
    stage("marts")
    clean = lake.spark.read.parquet(lake.clean).where(_partition_filter(months)).drop("year", "month")
    lake.hourly.replace_months(marts.hourly_by_method(clean))
    lake.daily_station.replace_months(marts.daily_by_station(clean))
    lake.daily_class.replace_months(marts.daily_by_class(clean))
    lake.station_parts.replace_months(marts.station_parts(clean))
    lake.profile_parts.replace_months(marts.profile_parts(clean))
    seen = [(m, c) for part, c in zip(parts, counted, strict=True) for m in part]
    version = lake.spark.createDataFrame([(m, c.value("rows", f"{m:%Y-%m}"), c.value("source_updated_at", f"{m:%Y-%m}")) for m, c in seen], "month date, rows bigint, source_updated_at timestamp_ntz")
    lake.versions.upsert(version.withColumn("built_at", F.current_timestamp()), ["month"])
    found = [(m, r.tag, r.severity, c.value(r.tag, f"{m:%Y-%m}")) for m, c in seen for r in rules]
    lake.quality.upsert(lake.spark.createDataFrame(found, QUALITY), ["month", "tag"])


def _write_clean(raw: DataFrame, mode: DataFrame, rules: list, months: list[dt.date], staged: str) -> quality.Counted:
    """Clean rows of some months below ``staged``, with the counts of the pass that wrote them."""
    month = timefns.month_start("day")
    counted = quality.Counted(rules, {f"{m:%Y-%m}": month == F.lit(m) for m in months}, {"source_updated_at": F.col("source_updated_at")})

    def finish(rows: DataFrame) -> DataFrame:
        seen = counted.on(rows)
        return quality.clean(seen, [*model.SOURCE_COLUMNS, "year", "month"])

    # The folder column prunes the scan to the months.
    rows = quality.with_station_mode(raw.where(month.isin(months)), mode)
    files.write_months(rows, staged, finish=finish)
    return counted


def _partition_filter(months: list[dt.date]):
    return F.make_date("year", "month", F.lit(1)).isin(months)


def build_full_marts(lake: Lake) -> None:
    """Dimensions and the station profile over all months.

    They are merged from the monthly parts, so a run reads the clean rows of
    its own months only.
    """
    if lake.daily_class.read() is None:  # the last month is gone
        for table in (lake.stations, lake.dates, lake.profile):
            table.replace(table.read().limit(0))
        return
    days = lake.daily_class.read().select("day").distinct()
    lake.stations.replace(marts.station_dim_from_parts(lake.station_parts.read()))
    lake.dates.replace(marts.date_dim(days, "day"))
    lake.profile.replace(marts.profile_from_parts(lake.profile_parts.read(), days))


def drop_month(lake: Lake, month: dt.date) -> None:
    """A month the source no longer has leaves every layer."""
    folder = f"{lake.clean}/year={month.year}/month={month.month}"
    if exists(lake.spark, folder):
        remove(lake.spark, folder)
    for table in lake.facts.values():
        table.delete_month(month)
    gone = F.col("month") != F.lit(month)
    lake.versions.replace(lake.versions.read().where(gone))
    lake.quality.replace(lake.quality.read().where(gone))


def verify(lake: Lake) -> DataFrame:
    """(check, failing): stored fingerprints against the marts and the clean layer."""
    from tidemark.operators.compare import differing_keys

    prints = lake.fingerprints.read()
    daily = {
        "days whose hourly ridership differs": lake.hourly.read().groupBy(F.to_date("hour").alias("day")),
        "days whose station ridership differs": lake.daily_station.read().groupBy("day"),
    }
    parts = [
        differing_keys(prints, g.agg(F.sum("ridership").cast("double").alias("ridership")), ["day"], "ridership").select(
            F.lit(name).alias("check"), F.col("differing").alias("failing")
        )
        for name, g in daily.items()
    ]
    raw_rows = prints.groupBy(timefns.month_start("day").alias("month")).agg(F.sum("rows").alias("rows"))
    # Counted from the clean files themselves, so rows lost on the way are seen.
    stored = lake.spark.read.parquet(lake.clean).groupBy(F.make_date("year", "month", F.lit(1)).alias("month")).agg(F.count("*").alias("rows"))
    parts.append(
        differing_keys(raw_rows, stored, ["month"], "rows").select(
            F.lit("months whose clean row count differs").alias("check"), F.col("differing").alias("failing")
        )
    )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def serving_summary(lake: Lake) -> DataFrame:
    """(table, rows) of the serving tables."""
    tables = {
        "ridership_hourly": lake.hourly.read(),
        "ridership_daily_station": lake.daily_station.read(),
        "ridership_daily_class": lake.daily_class.read(),
        "dim_station": lake.stations.read(),
        "station_hour_profile": lake.profile.read(),
    }
    out = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


# --- the month-wise variant -----------------------------------------------------


def run_etl(lake: Lake, source: DataFrame) -> Run:
    """Reload whole months: no raw layer, ten checks before the load, observed days only."""
    configure(lake.spark)
    run = Run(lake, "etl")
    try:
        with scratch_scope(lake.spark):  # the staging folder goes as well
            _run_etl(lake, source, run)
    except Exception as error:
        run.finish("failed", message=f"{type(error).__name__}: {error}")
        raise
    return run


def _run_etl(lake: Lake, source: DataFrame, run: Run) -> None:
    run.stage = "plan"
    server = written_once(fingerprint(source), "server")
    stored = lake.fingerprints.read()
    changes = written_once(incremental.changed_days(server, stored), "changes")
    months = _months(incremental.changed_months(changes))
    if not months:
        run.stage = "done"
        run.finish("success", message="no change")
        return
    present = set(_months(server.select(timefns.month_start("day").alias("month"))))
    build = [m for m in months if m in present]

    run.stage = "extract"
    staging = scratch(lake.spark, "staging")
    source.where(_in_months(marts.TS, months)).write.parquet(f"{staging}/raw")
    raw = lake.spark.read.schema(source.schema).parquet(f"{staging}/raw")

    run.stage = "gate"
    rules = quality.fact_rules()
    with_mode = quality.with_station_mode(raw, quality.station_mode(raw))
    quality.write_gated(with_mode, rules, f"{staging}/clean", quality.clean_features)

    run.stage = "transform"
    clean = lake.spark.read.parquet(f"{staging}/clean")
    hourly = marts.hourly_by_method(clean, dst_flag=True)
    daily = marts.daily_by_station(clean)

    run.stage = "check"
    failed = [r.check for r in quality.post_checks(raw, clean, hourly, daily).where("NOT passed").collect()]
    if failed:
        raise quality.QualityError(f"checks failed: {', '.join(sorted(failed))}")

    run.stage = "load"
    lake.hourly.replace_months(hourly)
    lake.daily_station.replace_months(daily)
    lake.daily_class.replace_months(marts.daily_by_class(clean))
    for month in months:
        if month not in present:
            for table in lake.facts.values():
                table.delete_month(month)
    lake.quality.upsert(quality.counts_by_month(with_mode, rules), ["month", "tag"])
    lake.stations.upsert(marts.station_dim(clean), ["station_complex_id"])
    lake.dates.upsert(marts.date_dim(clean, observed_only=True), ["date"])
    fresh = server.where(timefns.month_start("day").isin(months))
    others = stored.where(~timefns.month_start("day").isin(months))
    lake.fingerprints.replace(others.unionByName(fresh))

    total = fresh.agg(F.count("*").alias("days"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    run.stage = "done"
    run.finish("success", total.days, total.rows, build)


def row_flow(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) from extract to load."""
    out = None
    for i, (name, df) in enumerate(stages.items()):
        part = df.agg(F.count("*").alias("rows")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


