"""Weekly training of the ridership model and batch scoring with it."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.learn import features, models
from tidemark.learn.registry import Registry
from tidemark.operators import grid

NAME = "ridership_hourly"
ENTITY, TS, VALUE = "station_complex_id", "transit_timestamp", "riders"


def station_hours(clean: DataFrame, days: int) -> DataFrame:
    """Zero-filled station × hour totals over the newest days, one row a station: the fit and the lookups need no row for each hour."""
    hourly = clean.groupBy(ENTITY, TS).agg(F.sum("ridership").alias(VALUE))
    return grid.dense_grid(hourly, ENTITY, TS, VALUE, last_days=days, folded=True)


def evaluate(frame: DataFrame, hold_out_days: int = 28, **params) -> dict:
    """Metrics on the newest days with lookups and model from the days before."""
    train, test = features.hold_out(frame, TS, hold_out_days)
    learn = features.serving_features(train, train, ENTITY, VALUE)
    model = models.fit_log_trees(learn, features.SERVING, VALUE, **params)
    rows = features.calendar(grid.opened(test, ENTITY, TS, VALUE), TS)
    scored = models.predict(model, features.serving_features(rows, train, ENTITY, VALUE), features.SERVING, log_target=True)
    ours = models.regression_metrics(scored, VALUE, "prediction").first()
    base = models.regression_metrics(scored, VALUE, "profile_mean").first()
    return {"holdout_days": hold_out_days, "mae": ours.mae, "r2": ours.r2, "baseline_profile_mae": base.mae, "test_rows": ours.rows}


def train(clean: DataFrame, registry: Registry, days: int = 365, hold_out_days: int = 28, **params) -> str:
    """Evaluate on the hold-out, fit on all rows, register."""
    frame = station_hours(clean, days).persist()
    try:
        # Side by side: a fit is many short jobs that leave tasks idle between them.
        with ThreadPoolExecutor(1) as pool:
            fit = pool.submit(lambda: models.fit_log_trees(features.serving_features(frame, frame, ENTITY, VALUE), features.SERVING, VALUE, **params))
            metrics = evaluate(frame, hold_out_days, **params)
            model = fit.result()
        span = frame.agg(F.min("_first").alias("a"), F.max("_last").alias("b")).first()
    finally:
        frame.unpersist()
    return registry.register(NAME, model, span.a, span.b, metrics)


def forecast(model: PipelineModel, frame: DataFrame, day: dt.date) -> DataFrame:
    """24 hours of a date for every station beside its profile value."""
    hours = (
        frame.select(ENTITY).distinct().select(ENTITY, F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"))
        .select(ENTITY, (F.lit(day).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("_h"))).alias(TS))
    )
    rows = features.serving_features(features.calendar(hours, TS), frame, ENTITY, VALUE)
    scored = models.predict(model, rows, features.SERVING, log_target=True)
    return scored.select(ENTITY, "hour", F.coalesce("profile_mean", F.lit(0.0)).alias("profile_mean"), "prediction")
