"""Declarative quality rules: tagging, counting, gating, repair and scoring.

A rule is a predicate that is true when a row violates it. NULL results do not
tag, as in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import model
from tidemark.functions import textfns, timefns
from tidemark.sources.tables import remove, rename, written_once


class QualityError(RuntimeError):
    """Blocking rule violations were found before anything was written."""


@dataclass(frozen=True)
class Rule:
    tag: str
    dimension: str
    severity: str
    violated: Column
    repaired: bool = False

    @property
    def blocking(self) -> bool:
        return self.severity == "error" and not self.repaired


def box_violated(lat: str, lon: str, box: dict) -> Column:
    return ~F.col(lat).between(*box["lat"]) | ~F.col(lon).between(*box["lon"])


def point_text_differs(point: str = "georeference", lon: str = "longitude", lat: str = "latitude") -> Column:
    """Whole-text comparison of a stored point with its coordinates."""
    return F.col(point) != textfns.point_text(lon, lat)


def fact_rules(columns: Sequence[str] = tuple(model.SOURCE_COLUMNS), box: dict = model.CITY_BOX) -> list[Rule]:
    """The twelve rules of the hourly fact; rows must carry ``station_mode``."""
    c = F.col
    whole = lambda name: c(name) != F.floor(name)
    return [
        Rule("missing_value", "Completeness", "error", reduce(or_, [c(n).isNull() for n in columns])),
        Rule(
            "invalid_category",
            "Validity",
            "error",
            ~c("transit_mode").isin(model.MODES)
            | ~c("payment_method").isin(model.METHODS)
            | ~c("borough").isin(model.BOROUGHS),
        ),
        Rule("nonpositive_ridership", "Validity", "error", c("ridership") <= 0),
        Rule("negative_transfers", "Validity", "error", c("transfers") < 0, repaired=True),
        Rule("transfers_exceed_ridership", "Validity", "error", c("transfers") > c("ridership")),
        Rule("non_integer_count", "Validity", "error", whole("ridership") | whole("transfers")),
        Rule("outside_nyc", "Validity", "error", box_violated("latitude", "longitude", box)),
        Rule("not_on_hour", "Validity", "error", timefns.hour_start("transit_timestamp") != c("transit_timestamp")),
        Rule(
            "fare_class_payment_mismatch",
            "Consistency",
            "error",
            F.lower(textfns.text_before("fare_class_category", " - ")) != c("payment_method"),
        ),
        Rule("station_mode_mismatch", "Consistency", "error", c("transit_mode") != c("station_mode"), repaired=True),
        Rule(
            "georeference_mismatch",
            "Consistency",
            "error",
            (textfns.point_lon("georeference") != c("longitude")) | (textfns.point_lat("georeference") != c("latitude")),
        ),
        Rule("dst_transition_hour", "Accuracy", "warning", timefns.is_dst_hour("transit_timestamp")),
    ]


def catalogue(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as rows; one per rule, so its size is fixed by the code."""
    return spark.createDataFrame(
        [(r.tag, r.dimension, r.severity, r.blocking) for r in rules],
        "tag string, dimension string, severity string, blocking boolean",
    )


# --- dominant value and lookup join ----------------------------------------


def dominant_value(df: DataFrame, key: str, category: str, name: str) -> DataFrame:
    """Most frequent category per key; ties go to the last in text order."""
    counted = df.groupBy(key, category).agg(F.count("*").alias("_n"))
    return counted.groupBy(key).agg(F.max_by(category, F.struct("_n", category)).alias(name))


def station_mode(df: DataFrame) -> DataFrame:
    """Dominant mode of every station, written once.

    As a stored table the lookup has a known size when the join is planned, so
    it is broadcast below the threshold and the fact is not shuffled for it.
    Computed in the same plan, the fact would already be moving when the size
    is found out.
    """
    known = df.where("station_complex_id IS NOT NULL")
    return written_once(dominant_value(known, "station_complex_id", "transit_mode", "station_mode"), "station-mode")


def with_station_mode(df: DataFrame, modes: DataFrame) -> DataFrame:
    """Left join, so rows with a NULL station id still reach the rules.

    No broadcast hint: the planner goes by the size of the stored lookup, and
    beyond the threshold adaptive execution splits skewed stations.
    """
    return df.join(modes, "station_complex_id", "left")


# --- tagging and counting ---------------------------------------------------


def tag_array(rules: Sequence[Rule]) -> Column:
    """Sorted tags of the violated rules of a row."""
    return F.array_sort(F.array_compact(F.array(*[F.when(r.violated, F.lit(r.tag)) for r in rules])))


def flagged(df: DataFrame, rules: Sequence[Rule], name: str = "error_tags") -> DataFrame:
    """Rows that violate at least one rule, with their tags."""
    return df.withColumn(name, tag_array(rules)).where(F.size(name) > 0)


def counts_wide(df: DataFrame, rules: Sequence[Rule], where: Column | None = None, by: Sequence = ()) -> DataFrame:
    """One filtered count per rule, all rules in one scan."""
    if where is not None:
        df = df.where(where)
    return df.groupBy(*by).agg(*[F.count_if(r.violated).alias(r.tag) for r in rules])


def counts_long(df: DataFrame, rules: Sequence[Rule], keep_zero: bool = False) -> DataFrame:
    """(tag, rows): the wide counts turned over after aggregation, so no row is multiplied."""
    long = counts_wide(df, rules).unpivot([], [r.tag for r in rules], "tag", "rows")
    return long if keep_zero else long.where("rows > 0")


def counts_by_month(df: DataFrame, rules: Sequence[Rule], ts: str = "transit_timestamp") -> DataFrame:
    """(month, tag, severity, rows) with a row for every rule, also those without hits."""
    severity = F.element_at(F.create_map(*[F.lit(x) for r in rules for x in (r.tag, r.severity)]), F.col("tag"))
    wide = counts_wide(df, rules, by=[timefns.month_start(ts).alias("month")])
    return wide.unpivot(["month"], [r.tag for r in rules], "tag", "rows").select(
        "month", "tag", severity.alias("severity"), "rows"
    )


def diagnosis(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every rule of the catalogue with its number of violations."""
    return (
        catalogue(df.sparkSession, rules)
        .join(counts_long(df, rules), "tag", "left")
        .fillna(0, ["rows"])
    )


def gate(df: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """Count all rules and stop when a blocking one has hits. Collects one row."""
    counts = counts_wide(df, rules).first().asDict()
    blocking = {r.tag: counts[r.tag] for r in rules if r.blocking and counts[r.tag]}
    if blocking:
        raise QualityError(f"blocking rule violations {blocking}")
    return counts


class Counted:
    """Row and rule counts of a relation, taken by the pass that writes it.

    Place ``on`` behind the last shuffle before the write: a stage in front of a shuffle may run again when an executor is lost, and would
    count its rows twice. ``by`` names groups by a condition each; their number is that of the expressions.
    """

    def __init__(self, rules: Sequence[Rule], by: Mapping[str, Column] | None = None, extra: Mapping[str, Column] | None = None):
        self.rules, self.by, self.extra = list(rules), dict(by or {"": F.lit(True)}), dict(extra or {})
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        counts = [
            expr.alias(f"{name}@{group}")
            for group, inside in self.by.items()
            for name, expr in [
                ("rows", F.count_if(inside)),
                *[(r.tag, F.count_if(inside & r.violated)) for r in self.rules],
                *[(name, F.max(F.when(inside, c))) for name, c in self.extra.items()],
            ]
        ]
        return df.observe(self._seen, *counts)

    def value(self, name: str, group: str = ""):
        """A count, or the largest value of an ``extra`` column; waits for the write."""
        return self._seen.get[f"{name}@{group}"]

    @property
    def counts(self) -> dict[str, dict[str, int]]:
        """Violations by group and tag."""
        return {g: {r.tag: self.value(r.tag, g) for r in self.rules} for g in self.by}

    def check(self) -> None:
        """Stop when a blocking rule has hits."""
        blocking = {r.tag for r in self.rules if r.blocking}
        hits = [f"{g} {tag}: {n}".strip() for g, tags in sorted(self.counts.items()) for tag, n in sorted(tags.items()) if n and tag in blocking]
        if hits:
            raise QualityError(f"blocking rule violations: {'; '.join(hits)}")


def write_gated(df_with_mode: DataFrame, rules: Sequence[Rule], folder: str, project: Callable[[DataFrame], DataFrame] | None = None) -> Counted:
    """Write repaired rows and count all rules in one scan; the folder appears only if no blocking rule has hits."""
    spark = df_with_mode.sparkSession
    counted, staged = Counted(rules), f"{folder}-staged"
    try:
        (project or clean)(counted.on(df_with_mode)).write.mode("overwrite").option("compression", "zstd").parquet(staged)
        counted.check()
        rename(spark, staged, folder)
    finally:
        remove(spark, staged)
    return counted


def examples(flagged_rows: DataFrame, order: Sequence, n: int, tags: str = "error_tags") -> DataFrame:
    """First ``n`` rows of every tag combination."""
    from tidemark.operators.series import first_rows

    return first_rows(flagged_rows.withColumn("tags", F.array_join(tags, ", ")), ["tags"], order, n)


def violations_by(df: DataFrame, rule: Rule, key: str, measure: str, ts: str, label: str) -> DataFrame:
    """Where one rule is violated: rows, least value, sum, first and last day, labels."""
    return (
        df.where(rule.violated)
        .groupBy(key)
        .agg(
            F.count("*").alias("rows"),
            F.min(measure).alias("least"),
            F.sum(measure).alias("total"),
            F.to_date(F.min(ts)).alias("first_day"),
            F.to_date(F.max(ts)).alias("last_day"),
            # Labels come from a fixed category list, so the set stays small.
            F.array_join(F.array_sort(F.collect_set(label)), ", ").alias("labels"),
        )
    )


# --- scoring ----------------------------------------------------------------


def dimension_scores(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """Rows failing an error rule per dimension and the share that passes.

    Uniqueness counts excess rows per key; the last row covers all row rules.
    """
    from tidemark.operators.dedup import key_summary

    errors = [r for r in rules if r.severity == "error"]
    groups: dict[str, list[Rule]] = {}
    for r in errors:
        groups.setdefault(r.dimension, []).append(r)
    groups["All row-level rules"] = errors
    failing = [
        F.count_if(F.coalesce(reduce(or_, [F.coalesce(r.violated, F.lit(False)) for r in rs]), F.lit(False))).alias(d)
        for d, rs in groups.items()
    ]
    one = df.agg(F.count("*").alias("_total"), *failing)
    row_level = one.unpivot(["_total"], list(groups), "dimension", "failing_rows")
    unique = key_summary(df, keys).select(
        (F.col("distinct_keys") + F.col("excess_rows")).alias("_total"),
        F.lit("Uniqueness").alias("dimension"),
        F.col("excess_rows").alias("failing_rows"),
    )
    return row_level.unionByName(unique).select(
        "dimension", "failing_rows", (100 * (1 - F.col("failing_rows") / F.col("_total"))).alias("score_pct")
    )


# --- repair and before/after ------------------------------------------------


def clean(df_with_mode: DataFrame, columns: Sequence[str] = tuple(model.SOURCE_COLUMNS)) -> DataFrame:
    """Repaired rows: dominant mode, whole counts, negative transfers set to zero, DST mark."""
    repairs = {
        "transit_mode": F.coalesce("station_mode", "transit_mode"),
        "ridership": F.col("ridership").cast("int"),
        "transfers": F.greatest(F.col("transfers"), F.lit(0)).cast("int"),
    }
    return df_with_mode.select(
        *[repairs.get(c, F.col(c)).alias(c) for c in columns],
        timefns.is_dst_hour("transit_timestamp").alias("is_dst_transition"),
    )


def clean_features(df_with_mode: DataFrame) -> DataFrame:
    """The analytical form: repaired rows with calendar features and without the point text."""
    ts = F.col("transit_timestamp")
    cleaned = clean(df_with_mode)
    return cleaned.select(
        "transit_timestamp",
        F.to_date(ts).alias("date"),
        F.hour(ts).alias("hour_of_day"),
        timefns.iso_weekday(ts).alias("day_of_week"),
        timefns.is_weekend(ts).alias("is_weekend"),
        "is_dst_transition",
        *[c for c in model.SOURCE_COLUMNS if c not in ("transit_timestamp", "georeference")],
    )


def before_after_counts(before: DataFrame, after: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(tag, before, after) for every rule."""
    b = counts_long(before, rules, keep_zero=True).withColumnRenamed("rows", "before")
    a = counts_long(after, rules, keep_zero=True).withColumnRenamed("rows", "after")
    return b.join(a, "tag", "full")


def before_after_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and sums before and after, with their differences.

    ``transfers_change`` must equal ``zeroed_transfers``: nothing else moved.
    """
    def totals(df: DataFrame) -> DataFrame:
        return df.agg(
            F.count("*").alias("rows"),
            F.sum("ridership").cast("double").alias("ridership"),
            F.sum("transfers").cast("double").alias("transfers"),
            F.coalesce(-F.sum(F.when(F.col("transfers") < 0, F.col("transfers"))), F.lit(0.0)).cast("double").alias("negatives"),
        )

    b, a = totals(before), totals(after)
    both = b.select(F.struct("*").alias("b")).withColumn("a", a.select(F.struct("*")).scalar())
    return both.select(
        F.col("b.rows").alias("rows_before"),
        F.col("a.rows").alias("rows_after"),
        (F.col("a.ridership") - F.col("b.ridership")).alias("ridership_change"),
        (F.col("a.transfers") - F.col("b.transfers")).alias("transfers_change"),
        F.col("b.negatives").alias("zeroed_transfers"),
        (F.col("a.transfers") - F.col("b.transfers") == F.col("b.negatives")).alias("only_negatives_changed"),
    )


# --- ten checks after the transform -----------------------------------------

REQUIRED = ["transit_timestamp", "station_complex_id", "payment_method", "ridership", "transfers"]


def post_checks(raw: DataFrame, cleaned: DataFrame, hourly: DataFrame, daily_station: DataFrame) -> DataFrame:
    """(check, passed): what must hold before the marts may be loaded."""
    from tidemark.operators.dedup import key_summary

    def value(df: DataFrame, expr: Column) -> Column:
        return df.agg(expr.alias("v")).scalar()

    types = dict(cleaned.dtypes)
    modes = cleaned.groupBy("station_complex_id").agg(F.countDistinct("transit_mode").alias("n"))
    fact = cleaned.agg(
        F.count("*").alias("rows"),
        F.count_if(reduce(or_, [F.col(c).isNull() for c in REQUIRED])).alias("missing"),
        F.count_if(F.col("transfers") < 0).alias("negative"),
        F.sum("ridership").alias("ridership"),
    )
    checks = {
        "row count kept": F.col("rows") == value(raw, F.count("*")),
        "no missing values": F.col("missing") == 0,
        "counts are integers": F.lit(types["ridership"] == types["transfers"] == "int"),
        "no negative transfers": F.col("negative") == 0,
        "one mode per station": value(modes, F.max("n")) == 1,
        "ridership total kept": F.col("ridership") == value(raw, F.sum("ridership")),
        "hourly total equals clean": F.col("ridership") == value(hourly, F.sum("ridership")),
        "daily station total equals clean": F.col("ridership") == value(daily_station, F.sum("ridership")),
        "aggregate keys unique": key_summary(daily_station, ["day", "station_complex_id"]).select("excess_rows").scalar() == 0,
        "no duplicate keys": key_summary(cleaned, model.ROW_KEY).select("excess_rows").scalar() == 0,
    }
    wide = fact.select(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()])
    return wide.unpivot([], list(checks), "check", "passed")
