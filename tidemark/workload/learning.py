"""Features, labels, baselines and models over the grid made from events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.learn import features, models
from tidemark.learn.registry import Registry
from tidemark.operators import grid, series
from tidemark.plans import train
from tidemark.session import scratch
from tidemark.sources.tables import written_once
from tidemark.workload.fixtures import FACT, clean_fact, dst_sql, fact
from tidemark.workload.registry import query
from tidemark.workload.scalars import _HOLIDAYS

E, TS, V = train.ENTITY, train.TS, train.VALUE
FIRST_TEST = "2024-03-24"

_SH = f"sh AS MATERIALIZED (SELECT {E}, {TS}, CAST(sum(ridership) AS DOUBLE) AS riders FROM fact GROUP BY 1, 2)"
_HOL = _HOLIDAYS.replace("SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders", f"SELECT DISTINCT CAST(year({TS}) AS INT) AS year FROM fact")
_GRID = f"""{_SH}, {_HOL}, hh AS (SELECT DISTINCT {TS} FROM sh WHERE NOT {dst_sql(TS)}), ss AS (SELECT DISTINCT {E} FROM sh),
g AS MATERIALIZED (SELECT ss.{E}, hh.{TS}, coalesce(riders, 0) AS riders FROM hh CROSS JOIN ss LEFT JOIN sh ON sh.{E} = ss.{E} AND sh.{TS} = hh.{TS}),
c AS (SELECT *, CAST(hour({TS}) AS INT) AS hour, CAST(isodow({TS}) AS INT) AS dow, CAST(isodow({TS}) >= 6 AS INT) AS is_weekend, CAST(month({TS}) AS INT) AS month,
  CASE WHEN isodow({TS}) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type, CAST(CAST({TS} AS DATE) IN (SELECT day FROM hol) AS INT) AS is_holiday FROM g),
tr AS (SELECT * FROM c WHERE {TS} < TIMESTAMP '{FIRST_TEST}'), te AS (SELECT * FROM c WHERE {TS} >= TIMESTAMP '{FIRST_TEST}'),
pr AS (SELECT {E}, dow, hour, avg(riders) AS profile_mean, avg(ln(1 + riders)) AS profile_log FROM tr GROUP BY 1, 2, 3)"""
BASE = f"WITH {FACT}, {_GRID}"


def hourly(spark, sf):
    return fact(spark, sf).groupBy(E, TS).agg(F.sum("ridership").alias(V))


def calendar_grid(spark, sf):
    return features.calendar(grid.dense_grid(hourly(spark, sf), E, TS, V, drop_dst=True), TS)


def table_of_features(spark, sf):
    return features.feature_table(hourly(spark, sf), E, TS, V, FIRST_TEST)


def split(spark, sf):
    return features.split_at(table_of_features(spark, sf), TS, FIRST_TEST)


def written_split(spark, sf, columns=None):
    """``split`` of a table that is made once, with some of its features or all: a fit and its metrics read it several times."""
    rows = table_of_features(spark, sf)
    return features.split_at(written_once(rows.select(E, TS, V, *columns) if columns else rows, "features"), TS, FIRST_TEST)


@query("calendar_features", "M02 M03 J15 D11", f"{BASE} SELECT {E}, {TS}, riders, hour, dow, is_weekend, month, is_holiday, day_type FROM c")
def _(spark, sf):
    return calendar_grid(spark, sf).select(E, TS, V, "hour", "dow", "is_weekend", "month", "is_holiday", "day_type")


@query("split_counts", "M06", f"{BASE} SELECT 'train' AS part, count(*) AS rows, min({TS}) AS first_ts, max({TS}) AS last_ts FROM tr UNION ALL SELECT 'test', count(*), min({TS}), max({TS}) FROM te")
def _(spark, sf):
    parts = features.split_at(calendar_grid(spark, sf), TS, FIRST_TEST)
    a, b = (p.agg(F.count("*").alias("rows"), F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts")).select(F.lit(n).alias("part"), "*") for n, p in zip(("train", "test"), parts))
    return a.unionByName(b)


@query("hold_out_counts", "M06", f"{BASE} SELECT count(*) FILTER ({TS} <= m - INTERVAL 7 DAY) AS train_rows, count(*) FILTER ({TS} > m - INTERVAL 7 DAY) AS test_rows FROM c, (SELECT max({TS}) AS m FROM c)")
def _(spark, sf):
    a, b = features.hold_out(calendar_grid(spark, sf), TS, 7)
    return a.agg(F.count("*").alias("train_rows")).withColumn("test_rows", b.agg(F.count("*")).scalar())


@query("profile_lookup", "M04", f"{BASE} SELECT {E}, dow, hour, round(profile_mean, 9) AS profile_mean, round(profile_log, 9) AS profile_log FROM pr")
def _(spark, sf):
    t, _ = features.split_at(calendar_grid(spark, sf), TS, FIRST_TEST)
    p = features.weekday_lookup(t, E, V)
    return p.withColumns({c: F.round(c, 9) for c in ("profile_mean", "profile_log")})


@query(
    "serving_lookup",
    "M04 J16",
    f"""{BASE}, sm AS (SELECT {E}, avg(riders) AS station_mean FROM tr GROUP BY 1), dp AS (SELECT {E}, day_type, hour, avg(riders) AS profile_mean FROM tr GROUP BY 1, 2, 3)
    SELECT te.{E}, {TS}, round(station_mean, 9) AS station_mean, round(profile_mean, 9) AS profile_mean FROM te LEFT JOIN sm USING ({E}) LEFT JOIN dp USING ({E}, day_type, hour)""",
)
def _(spark, sf):
    t, test = features.split_at(calendar_grid(spark, sf), TS, FIRST_TEST)
    rows = features.serving_features(test, t, E, V)
    return rows.select(E, TS, F.round("station_mean", 9).alias("station_mean"), F.round("profile_mean", 9).alias("profile_mean"))


_LAGGED = f"""lag7 AS (SELECT te.*, g7.riders AS lag_7d, profile_mean FROM te JOIN pr USING ({E}, dow, hour) LEFT JOIN g g7 ON g7.{E} = te.{E} AND g7.{TS} = te.{TS} - INTERVAL 7 DAY)"""


_LAG_HOURS = {"lag_1h": 1, "lag_24h": 24, "lag_7d": 168, "lag_14d": 336, "lag_21d": 504}


@query(
    "feature_table",
    "M05 J08 J16",
    # One row an hour and entity, so a frame of one instant holds that hour's row or none.
    f"{BASE}, l AS (SELECT {E}, {TS}, "
    + ", ".join(f"max(riders) OVER (PARTITION BY {E} ORDER BY {TS} RANGE BETWEEN INTERVAL {h} HOUR PRECEDING AND INTERVAL {h} HOUR PRECEDING) AS {n}" for n, h in _LAG_HOURS.items())
    + f" FROM g), f AS (SELECT c.*, l.* EXCLUDE ({E}, {TS}), profile_mean FROM c JOIN pr USING ({E}, dow, hour) JOIN l USING ({E}, {TS})"
    + f") SELECT {E}, {TS}, riders, lag_1h, lag_24h, lag_7d, lag_14d, lag_21d, round(profile_mean, 9) AS profile_mean FROM f",
)
def _(spark, sf):
    rows = table_of_features(spark, sf)
    return rows.select(E, TS, V, "lag_1h", "lag_24h", "lag_7d", "lag_14d", "lag_21d", F.round("profile_mean", 9).alias("profile_mean"))


def _metrics_sql(p):
    return (
        f"count(*) AS rows, round(avg(abs(riders - {p})), 6) AS mae, round(100 * sum(abs(riders - {p})) / sum(riders), 6) AS wape_pct, "
        f"round(sqrt(avg((riders - {p}) * (riders - {p}))), 6) AS rmse, round(1 - sum((riders - {p}) * (riders - {p})) / (var_pop(riders) * count(*)), 6) AS r2"
    )


def _rounded(m):
    return m.select("rows", *[F.round(c, 6).alias(c) for c in ("mae", "wape_pct", "rmse", "r2")])


@query("baseline_lag_metrics", "M08 M09 P10", f"{BASE}, {_LAGGED} SELECT {_metrics_sql('coalesce(lag_7d, profile_mean)')} FROM lag7")
def _(spark, sf):
    _, test = split(spark, sf)
    return _rounded(models.regression_metrics(test.withColumn("p", models.lag_baseline()), V, "p"))


@query("baseline_profile_metrics", "M08 M09", f"{BASE}, {_LAGGED} SELECT {_metrics_sql('profile_mean')} FROM lag7")
def _(spark, sf):
    _, test = split(spark, sf)
    return _rounded(models.regression_metrics(test, V, "profile_mean"))


_PEAK = f"""th AS (SELECT {E}, quantile_cont(riders, 0.8) AS t FROM tr GROUP BY 1), pk AS (SELECT c.*, CAST(riders >= t AND riders > 0 AS INT) AS is_peak, CAST(dow <= 5 AND hour IN (6, 7, 8, 9, 16, 17, 18, 19) AS INT) AS rule FROM c JOIN th USING ({E}))"""


def peaks(spark, sf):
    # Thresholds and labels both read the grid, so it is made once.
    rows = written_once(calendar_grid(spark, sf), "grid")
    t, _ = features.split_at(rows, TS, FIRST_TEST)
    return features.with_peak(rows, features.peak_threshold(t, E, V), E, V)


@query("peak_share", "M11 J17", f"{BASE}, {_PEAK} SELECT {E}, count(*) AS hours, CAST(sum(is_peak) AS BIGINT) AS peaks FROM pk GROUP BY 1")
def _(spark, sf):
    return peaks(spark, sf).groupBy(E).agg(F.count("*").alias("hours"), F.sum("is_peak").alias("peaks"))


@query("rule_confusion", "M13 M14", f"{BASE}, {_PEAK} SELECT is_peak AS actual, rule AS predicted, count(*) AS rows FROM pk WHERE {TS} >= TIMESTAMP '{FIRST_TEST}' GROUP BY 1, 2")
def _(spark, sf):
    _, test = features.split_at(peaks(spark, sf), TS, FIRST_TEST)
    return models.confusion(test.withColumn("rule", features.rush_rule()), "is_peak", "rule")


@query(
    "rule_metrics",
    "M13 M14",
    f"""{BASE}, {_PEAK}, m AS (SELECT count(*) FILTER (is_peak = 1 AND rule = 1) AS tp, count(*) FILTER (is_peak = 0 AND rule = 1) AS fp, count(*) FILTER (is_peak = 1 AND rule = 0) AS fn, count(*) AS n,
    count(*) FILTER (is_peak = rule) AS ok FROM pk WHERE {TS} >= TIMESTAMP '{FIRST_TEST}') SELECT round(ok / n, 9) AS accuracy, round(tp / (tp + fp), 9) AS "precision", round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM m""",
)
def _(spark, sf):
    _, test = features.split_at(peaks(spark, sf), TS, FIRST_TEST)
    m = models.classification_metrics(models.confusion(test.withColumn("rule", features.rush_rule()), "is_peak", "rule"))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


_SHARES = ", ".join(
    f"round(coalesce(sum(ridership) FILTER (isodow({TS}) {op} 6 AND hour({TS}) = {h}) / nullif(sum(ridership) FILTER (isodow({TS}) {op} 6), 0), 0), 9) AS {d}_{h:02d}"
    for d, op in (("weekday", "<"), ("weekend", ">="))
    for h in range(24)
)


@query("hour_share_vectors", "M15 W08 P12", f"WITH {FACT} SELECT {E}, {_SHARES} FROM fact GROUP BY 1")
def _(spark, sf):
    v = features.hour_share_vectors(fact(spark, sf), E, TS, "ridership")
    return v.select(E, *[F.round(c, 9).alias(c) for c in features.SHARE_COLUMNS])


def described_stations(spark, sf):
    """One row per station: shares, means per day and borough."""
    f = fact(spark, sf)
    weekend = F.weekday(TS) >= 5
    n = f.select(F.to_date(TS).alias("d")).distinct().agg(
        F.struct(F.count_if(F.weekday("d") < 5).alias("wd"), F.count_if(F.weekday("d") >= 5).alias("we"), F.count("*").alias("n"))
    ).scalar()
    totals = f.groupBy(E).agg(
        F.any_value("borough").alias("borough"),
        (F.sum("ridership") / n["n"]).alias("avg_daily"),
        (F.coalesce(F.sum(F.when(~weekend, F.col("ridership"))), F.lit(0)) / n["wd"]).alias("weekday_mean"),
        (F.coalesce(F.sum(F.when(weekend, F.col("ridership"))), F.lit(0)) / n["we"]).alias("weekend_mean"),
    )
    return totals.join(features.hour_share_vectors(f, E, TS, "ridership"), E)


_H24 = [f"weekday_{h:02d}" for h in range(24)]


@query(
    "group_summary",
    "M17 W09 W10",
    f"""WITH {FACT}, v AS (SELECT {E}, {_SHARES.replace('round(', '(').replace(', 9) AS', ') AS')} FROM fact GROUP BY 1),
    n AS (SELECT count(*) FILTER (isodow(d) < 6) AS wd, count(*) FILTER (isodow(d) >= 6) AS we, count(*) AS n FROM (SELECT DISTINCT CAST({TS} AS DATE) AS d FROM fact)),
    t AS (SELECT {E}, any_value(borough) AS borough, sum(ridership) / any_value(n.n) AS avg_daily, coalesce(sum(ridership) FILTER (isodow({TS}) < 6), 0) / any_value(wd) AS a, coalesce(sum(ridership) FILTER (isodow({TS}) >= 6), 0) / any_value(we) AS b FROM fact, n GROUP BY 1),
    r AS (SELECT t.*, v.* EXCLUDE ({E}), row_number() OVER (PARTITION BY borough ORDER BY avg_daily DESC, {E}) AS i FROM t JOIN v USING ({E})),
    m AS (SELECT borough, {', '.join(f'avg({c}) AS {c}' for c in _H24)} FROM r GROUP BY 1), mu AS (UNPIVOT m ON {', '.join(_H24)} INTO NAME h VALUE s),
    pk AS (SELECT borough, CAST(right(h, 2) AS INT) AS peak_hour, 100 * s AS peak_share FROM (SELECT *, row_number() OVER (PARTITION BY borough ORDER BY s DESC, h) AS rn FROM mu) WHERE rn = 1)
    SELECT borough AS "cluster", count(*) AS stations, round(avg(avg_daily), 6) AS avg_daily, round(avg(100 * (weekday_06 + weekday_07 + weekday_08 + weekday_09)), 6) AS am_share,
    round(avg(100 * (weekday_16 + weekday_17 + weekday_18 + weekday_19)), 6) AS pm_share, round(avg(100 * b / nullif(a, 0)), 6) AS weekend_ratio, round(avg(CASE WHEN borough = 'Manhattan' THEN 100.0 ELSE 0 END), 6) AS borough_pct,
    any_value(peak_hour) AS peak_hour, round(any_value(peak_share), 6) AS peak_share, string_agg({E}, '; ' ORDER BY i) FILTER (i <= 3) AS top_names FROM r JOIN pk USING (borough) GROUP BY 1""",
)
def _(spark, sf):
    """The summary of named groups; the boroughs stand in for fitted clusters."""
    s = features.cluster_summary(described_stations(spark, sf).withColumn("cluster", F.col("borough")), "cluster", E)
    exact = {"cluster", "stations", "peak_hour", "top_names"}
    return s.select(*[c if c in exact else F.round(c, 6).alias(c) for c in s.columns])


# --- fitted models: rows only, because no SQL engine fits them -----------------------


@query("trees_log_metrics", "M07 M08")
def _(spark, sf):
    t, test = written_split(spark, sf)
    model = models.fit_log_trees(t, features.SCENARIO_A, V)
    return models.regression_metrics(models.predict(model, test, features.SCENARIO_A, True), V, "prediction")


@query("poisson_metrics", "M07 M08")
def _(spark, sf):
    t, test = written_split(spark, sf, features.SCENARIO_B)
    model = models.fit_poisson(t, features.SCENARIO_B, V)
    rows = models.alike(test, [V, *features.SCENARIO_B])
    scored = models.predict(model, models.log_counts(rows, features.SCENARIO_B), features.SCENARIO_B, False)
    return models.regression_metrics(scored, V, "prediction", "_n")


@query("poisson_trees_metrics", "M07 M08")
def _(spark, sf):
    """Poisson trees beside the linear Poisson model on the same held-out rows."""
    t, test = written_split(spark, sf, features.SCENARIO_B)
    trees = models.fit_poisson_trees(t, features.SCENARIO_B, V)
    linear = models.fit_poisson(t, features.SCENARIO_B, V)
    rows = models.alike(test, [V, *features.SCENARIO_B])
    scored = models.predict(trees, rows, features.SCENARIO_B, False, "trees", F.exp)
    both = models.predict(linear, models.log_counts(scored, features.SCENARIO_B), features.SCENARIO_B, False, "linear")
    figures = [F.struct(F.lit(m).alias("model"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), models.poisson_deviance(V, m, "_n").alias("deviance"), models.mean_error(V, m, "_n").alias("mae")) for m in ("trees", "linear")]
    return both.agg(F.array(*figures).alias("figures")).select(F.inline("figures"))


@query("permutation_importance", "M10")
def _(spark, sf):
    t, test = written_split(spark, sf)
    model = models.fit_log_trees(t, features.SCENARIO_A, V)
    return models.permutation_importance(model, test, features.SCENARIO_A, V, True, [E, TS], repeats=3)


@query("peak_classifier", "M12 M14")
def _(spark, sf):
    t, test = written_split(spark, sf)
    # Thresholds, labels and scores are read more than once, too.
    threshold = written_once(features.peak_threshold(t, E, V), "thresholds")
    model = models.fit_peak_classifier(features.with_peak(t, threshold, E, V), features.SCENARIO_B)
    scored = models.predict_peak(model, features.with_peak(test, threshold, E, V), features.SCENARIO_B)
    scored = written_once(scored.select(E, TS, "is_peak", "probability", "predicted"), "scores")
    metrics = models.classification_metrics(models.confusion(scored, "is_peak", "predicted"))
    return metrics.withColumn("roc_auc", F.lit(models.roc_auc(scored)))


@query("cluster_search", "M16")
def _(spark, sf):
    v = models.as_vectors(features.hour_share_vectors(fact(spark, sf), E, TS, "ridership"), features.SHARE_COLUMNS)
    return models.k_search(v, range(2, 9))


@query("cluster_summary", "M16 M17 W11")
def _(spark, sf):
    """Three clusters numbered by their morning share, described."""
    rows = described_stations(spark, sf)
    labelled = models.assign_clusters(models.as_vectors(rows, features.SHARE_COLUMNS), 3)
    am = sum((F.col(f"weekday_{h:02d}") for h in (6, 7, 8, 9)), F.lit(0.0))
    numbered = series.renumber(labelled.withColumn("_am", am), "raw_cluster", "_am", "cluster")
    return features.cluster_summary(numbered, "cluster", E)


@query("next_day_forecast", "M18 M01 V08")
def _(spark, sf):
    """All stations, 24 hours of the day after the data."""
    # The fit, the lookups and the forecast read the grid, so it is made once.
    frame = written_once(train.station_hours(clean_fact(spark, sf), 365), "grid")
    model = models.fit_log_trees(features.serving_features(frame, frame, E, V), features.SERVING, V)
    return train.forecast(model, frame, dt.date(2024, 3, 31))


@query("model_registry", "M19 M07 S22")
def _(spark, sf):
    registry = Registry(spark, scratch(spark, "models"))
    for _ in range(2):
        train.train(clean_fact(spark, sf), registry, days=365, hold_out_days=7)
    return registry.models().drop("artifact")
