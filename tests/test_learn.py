import datetime as dt
import functools
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.learn import features, models
from tidemark.learn.registry import KEPT, Registry
from tidemark.operators import grid
from tidemark.sources.tables import written_once as once
from tidemark.workload import registry

T0 = dt.datetime(2025, 3, 1)


@pytest.fixture(scope="module")
def hourly(spark):
    """Two entities over 30 days; the second has no rows at night."""
    hours = spark.range(24 * 30).select((F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("ts"))
    pairs = hours.withColumn("e", F.explode(F.array(F.lit("a"), F.lit("b")))).where("e = 'a' OR hour(ts) >= 6")
    return pairs.withColumn("v", (F.hour("ts") + F.when(F.col("e") == "a", 1).otherwise(5)).cast("double"))


def test_dense_grid_fills_zeros_and_drops_clock_changes(hourly):
    full = grid.dense_grid(hourly, "e", "ts", "v")
    assert full.count() == 2 * 720 and full.where("e = 'b' AND hour(ts) < 6 AND v <> 0").count() == 0
    assert grid.dense_grid(hourly, "e", "ts", "v", drop_dst=True).count() == 2 * 719  # 2025-03-09 02:00
    assert grid.dense_grid(hourly, "e", "ts", "v", last_days=2).count() == 2 * 48


def test_lags_are_by_time_not_by_row(hourly):
    lagged = grid.lag_features(grid.dense_grid(hourly, "e", "ts", "v", drop_dst=True), "e", "ts", "v", {"lag_1h": 1, "lag_24h": 24})
    at = {r.ts: (r.lag_1h, r.lag_24h) for r in lagged.where("e = 'a'").collect()}
    assert at[T0] == (None, None)
    assert at[dt.datetime(2025, 3, 9, 3)] == (None, 4.0)  # its previous hour does not exist
    assert at[dt.datetime(2025, 3, 10, 2)] == (2.0, None)
    assert at[dt.datetime(2025, 3, 12, 5)] == (5.0, 6.0)


def test_mean_ignoring_null(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    assert [r.m for r in df.select(grid.mean_ignoring_null(["a", "b", "c"]).alias("m")).collect()] == [2.0, None]


def test_shares_sum_to_one(hourly):
    v = features.hour_share_vectors(hourly, "e", "ts", "v")
    for part in ("weekday", "weekend"):
        total = sum((F.col(f"{part}_{h:02d}") for h in range(24)), F.lit(0.0))
        assert all(r.t == pytest.approx(1.0) for r in v.select(total.alias("t")).collect())


def test_metrics_against_hand_counts(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 16.0), (0.0, 0.0)], "y double, p double")
    m = models.regression_metrics(df, "y", "p").first()
    assert (m.mae, m.wape_pct) == (2.0, 20.0) and m.rmse == pytest.approx((20 / 3) ** 0.5) and m.r2 == pytest.approx(1 - 20 / 200)
    counts = spark.createDataFrame([(1, 1, 3), (0, 1, 1), (1, 0, 2), (0, 0, 4)], "actual int, predicted int, rows bigint")
    c = models.classification_metrics(counts).first()
    assert (c.accuracy, c.precision, c.recall, c.f1) == (0.7, 0.75, 0.6, pytest.approx(2 * 0.75 * 0.6 / 1.35))


def test_importance_finds_the_only_useful_feature(spark):
    df = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("x"), F.rand(1).alias("noise"))
    df = df.withColumn("v", F.expm1(F.col("x") / 2)).persist()
    model = models.fit_log_trees(df, ["x", "noise"], "v", maxIter=5, maxDepth=3)
    got = {r.feature: r.mae_increase for r in models.permutation_importance(model, df, ["x", "noise"], "v", True, ["id"], 2).collect()}
    assert got["x"] > 1 and abs(got["noise"]) < 0.2


def test_poisson_recovers_a_log_linear_mean(spark):
    df = spark.range(500).select((F.col("id") % 10).cast("double").alias("x")).withColumn("v", F.round(F.exp(F.col("x") * 0.3)))
    model = models.fit_poisson(df.withColumn("profile_mean", F.lit(0.0)), ["x"], "v")
    rows = models.predict(model, df, ["x"], log_target=False)
    assert models.regression_metrics(rows, "v", "prediction").first().r2 > 0.98


def test_search_for_the_number_of_clusters(spark):
    rows = [(float(10 * (i % 3)) + 0.1 * (i % 7), float(10 * (i % 3)) - 0.1 * (i % 5)) for i in range(90)]
    vectors = models.as_vectors(spark.createDataFrame(rows, "x double, y double"), ["x", "y"])
    found = {r.k: r for r in models.k_search(vectors, (2, 3, 4), starts=4).collect()}
    assert found[2].inertia > found[3].inertia > found[4].inertia
    assert max(found, key=lambda k: found[k].silhouette) == 3 and found[3].smallest_cluster == 30
    assert models.assign_clusters(vectors, 3, starts=2).select("raw_cluster").distinct().count() == 3


def counts_with_a_bend(spark):
    """Counts whose logarithm is not linear in the features."""
    df = spark.range(3000).select((F.col("id") % 10).cast("double").alias("x"), (F.floor(F.col("id") / 10) % 10).cast("double").alias("z"))
    mean = F.when(F.col("x") < 3, 2.0).when((F.col("x") < 7) & (F.col("z") > 4), 30.0).otherwise(8.0)
    return df.withColumn("v", F.floor(mean + 4 * (F.rand(3) - 0.5))).withColumn("profile_mean", F.lit(0.0)).persist()


def test_poisson_trees_beat_the_linear_model(spark):
    df = counts_with_a_bend(spark)
    trees = models.fit_poisson_trees(df, ["x", "z"], "v", maxIter=25, maxDepth=3, stepSize=0.3)
    linear = models.fit_poisson(df, ["x", "z"], "v")
    a = models.predict(trees, df, ["x", "z"], False, link=F.exp)
    b = models.predict(linear, df, ["x", "z"], False)
    deviance = [rows.agg(models.poisson_deviance("v", "prediction")).first()[0] for rows in (a, b)]
    assert deviance[0] < 0.3 * deviance[1]
    # With a log link, a boosted model that fits keeps the total.
    total = a.agg(F.sum("v").alias("v"), F.sum("prediction").alias("p")).first()
    assert total.p == pytest.approx(total.v, rel=0.02)


def test_poisson_trees_step_by_step(spark):
    """One round is a Newton step: the leaf's mean of y / mu - 1, weighted by mu."""
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 3.0), (1.0, 10.0), (1.0, 6.0)], "x double, v double")
    model = models.fit_poisson_trees(df, ["x"], "v", maxIter=2, maxDepth=1, stepSize=0.5)
    f = {0.0: math.log(5.0), 1.0: math.log(5.0)}
    for _ in range(2):
        f = {x: f[x] + 0.5 * (sum(y) / (2 * math.exp(f[x])) - 1) for x, y in ((0.0, (1.0, 3.0)), (1.0, (10.0, 6.0)))}
    got = {r.x: r.prediction for r in models.predict(model, df, ["x"], False, link=F.exp).collect()}
    assert got == pytest.approx({x: math.exp(m) for x, m in f.items()}, rel=1e-9)
    with pytest.raises(ValueError):
        models.fit_poisson_trees(df.withColumn("v", F.lit(0.0)), ["x"], "v", maxIter=1)


def test_deviance_by_hand(spark):
    df = spark.createDataFrame([(0.0, 2.0), (4.0, 2.0)], "y double, p double")
    want = 2 * ((0 - (0 - 2)) + (4 * math.log(2) - 2)) / 2
    assert df.agg(models.poisson_deviance("y", "p")).first()[0] == pytest.approx(want)


def test_a_stored_poisson_model_predicts_the_same(spark, tmp_path):
    df = counts_with_a_bend(spark)
    model = models.fit_poisson_trees(df, ["x", "z"], "v", maxIter=3, maxDepth=2)
    model.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    a, b = (models.predict(m, df, ["x", "z"], False, link=F.exp).agg(F.sum("prediction")).first()[0] for m in (model, back))
    assert a == pytest.approx(b)


def test_registry_keeps_five_and_one_current(spark, tmp_path):
    df = spark.range(20).select(F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("v"), F.lit(0.0).alias("profile_mean"))
    model = models.fit_poisson(df, ["x"], "v", maxIter=2)
    r = Registry(spark, str(tmp_path))
    ids = [r.register("m", model, T0, T0, {"i": i}, dt.datetime(2025, 1, 1 + i)) for i in range(KEPT + 2)]
    r.register("other", model, T0, T0, {}, dt.datetime(2024, 1, 1))
    kept = r.models().where("name = 'm'").orderBy("trained_at").collect()
    assert [k.model_id for k in kept] == ids[2:] and [k.is_current for k in kept] == [False] * 4 + [True]
    assert r.models().where("name = 'other' AND is_current").count() == 1
    assert len(list((tmp_path / "models").iterdir())) == KEPT + 1
    assert r.current("m").transform is not None and r.current("none") is None


def test_trees_over_cells_are_those_over_rows(spark):
    """Rows of equal bins are one weighted row; Spark's own trees over the rows predict the same."""
    made = spark.range(3000).withColumns({"x": (F.col("id") % 10).cast("double"), "z": (F.floor(F.col("id") / 10) % 10).cast("double"), "w": F.rand(5)})
    df = made.withColumn("v", F.when(F.col("x") < 3, 2.0).when(F.col("z") > 4, 3 * F.col("x")).otherwise(8.0) + F.col("id") % 3).persist()
    names = ["x", "z", "w"]
    assert df.count() <= models.SPLIT_ROWS
    ours = models.predict(models.fit_log_trees(df, names, "v", maxIter=4, maxDepth=3), df, names, True).select("id", "prediction")
    data = VectorAssembler(inputCols=names, outputCol="f").transform(df.withColumn("l", F.log1p("v")))
    trees = GBTRegressor(featuresCol="f", labelCol="l", predictionCol="p", maxIter=4, maxDepth=3, stepSize=0.1, seed=models.SEED).fit(data)
    both = ours.join(trees.transform(data).select("id", F.expm1("p").alias("p")), "id")
    assert both.agg(F.max(F.abs(F.col("prediction") - F.col("p")))).first()[0] < 1e-6
    peak = df.withColumn("is_peak", (F.col("v") > 9).cast("int"))
    ours = models.predict_peak(models.fit_peak_classifier(peak, names, maxIter=4, maxDepth=3), peak, names).select("id", "probability")
    data = VectorAssembler(inputCols=names, outputCol="f").transform(peak)
    trees = GBTClassifier(featuresCol="f", labelCol="is_peak", maxIter=4, maxDepth=3, stepSize=0.1, seed=models.SEED).fit(data)
    both = ours.join(trees.transform(data).select("id", vector_to_array("probability")[1].alias("p")), "id", "inner").select(ours["probability"], "p")
    assert both.agg(F.max(F.abs(F.col("probability") - F.col("p")))).first()[0] < 1e-6


def test_cells_grow_with_vectors_and_not_with_rows(spark):
    data = spark.range(40_000).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 4).cast("double").alias("z"), (F.col("id") % 7).cast("double").alias("y"))
    with models._cells(data, ["x", "z"], models.BINS, "y") as (stages, cells):
        assert cells.count() == 20 and len(stages) == 2
        total = cells.agg(F.sum("_n").alias("n"), F.sum(F.col("_n") * F.col("y")).alias("y")).first()
    assert (total.n, total.y) == (40_000, pytest.approx(sum(i % 7 for i in range(40_000))))
    assert models.thresholds([1.0, 1.0, 3.0, 4.0]) == [2.0, 3.5] and models.thresholds([5.0]) == []
    many = models.thresholds([float(i) for i in range(100)], 4)
    assert many == [24.5, 49.5, 74.5]


def test_the_grid_is_not_moved_after_it_is_opened(spark, hourly):
    rows = features.feature_table(hourly, "e", "ts", "v", "2025-03-20")
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Generate inline")[0]
    assert "Window" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    at = {(r.e, r.ts): r for r in rows.collect()}
    assert len(at) == 2 * 719
    want = features.weekday_lookup(rows.where("ts < '2025-03-20'").drop("profile_mean", "profile_log"), "e", "v").collect()
    got = {(r.e, r.dow, r.hour): (r.profile_mean, r.profile_log) for r in at.values()}
    assert got == {(r.e, r.dow, r.hour): (pytest.approx(r.profile_mean), pytest.approx(r.profile_log)) for r in want}


def test_profiles_by_entity_leave_unknown_ones_null(spark):
    columns = "e string, day_type string, hour int, v double"
    train = spark.createDataFrame([("a", "weekday", 3, 2.0), ("a", "weekday", 3, 4.0), ("a", "weekend", 3, 9.0), (None, "weekday", 3, 1.0)], columns)
    rows = spark.createDataFrame([("a", "weekday", 3, 0.0), ("a", "weekend", 3, 0.0), ("a", "weekend", 4, 0.0), ("b", "weekday", 3, 0.0), (None, "weekday", 3, 0.0)], columns)
    got = {(r.e, r.day_type, r.hour): (r.station_mean, r.profile_mean) for r in features.serving_features(rows, train, "e", "v").collect()}
    assert got == {("a", "weekday", 3): (5.0, 3.0), ("a", "weekend", 3): (5.0, 9.0), ("a", "weekend", 4): (5.0, None), ("b", "weekday", 3): (None, None), (None, "weekday", 3): (None, None)}


def test_a_clustering_reads_few_partitions(spark):
    vectors = models.as_vectors(spark.range(0, 90, 1, 9).select((F.col("id") % 3).cast("double").alias("x")), ["x"])
    with models._few(vectors) as few:
        assert few.rdd.getNumPartitions() == 1 and few.count() == 90
    assert [m.getK() for m in models._best_of_each(vectors, (2, 3), 2)] == [2, 3]


def test_hours_of_the_grid_open_after_the_move(hourly):
    """days are dealt to the tasks without their lists of hours."""
    for drop in (False, True):
        plan = grid.dense_grid(hourly, "e", "ts", "v", drop_dst=drop)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        move = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
        depth = len(plan[move]) - len(plan[move].lstrip(" :+-"))
        below = [line for line in plan[move + 1 :] if len(line) - len(line.lstrip(" :+-")) > depth]
        assert any("_opened" in line for line in plan[:move]) and not any("_opened" in line for line in below)


def test_serving_features_join_their_rows_once(hourly):
    """entity mean and profile come by one join, also for entities that aren't learnt."""
    rows = features.calendar(hourly, "ts")
    served = features.serving_features(rows, rows.where("e = 'a'"), "e", "v")
    assert served._jdf.queryExecution().analyzed().toString().count("Join LeftOuter") == 1
    assert served.count() == rows.count()
    means = {r.e: (r.m, r.p) for r in served.groupBy("e").agg(F.max("station_mean").alias("m"), F.max("profile_mean").alias("p")).collect()}
    assert means == {"a": (12.5, 24.0), "b": (None, None)}


@pytest.fixture
def small_fits(monkeypatch, spark, hourly):
    """The workload's fits over a small grid with few rounds; the labels of what it writes."""
    from tidemark.workload import learning

    fact = hourly.select(F.col("e").alias(learning.E), F.col("ts").alias(learning.TS), F.col("v").alias("ridership"))
    written = []
    registry.load_all()
    monkeypatch.setattr(learning, "FIRST_TEST", "2025-03-24")
    monkeypatch.setattr(learning, "fact", lambda spark, sf: fact)
    monkeypatch.setattr(learning, "clean_fact", lambda spark, sf: fact)
    monkeypatch.setattr(learning, "written_once", lambda df, label: (written.append(label), once(df, label))[1])
    for name in ("fit_log_trees", "fit_poisson_trees", "fit_peak_classifier"):
        monkeypatch.setattr(models, name, functools.partial(getattr(models, name), maxIter=2, maxDepth=2))
    return written


@pytest.mark.parametrize("name, label", [("next_day_forecast", "grid"), ("peak_classifier", "features"), ("permutation_importance", "features"), ("poisson_trees_metrics", "features")])
def test_fits_make_their_table_once(spark, small_fits, name, label):
    """F4 to F7: the table below a fit and its metrics is written and not made again for each of them."""
    rows = registry.QUERIES[name](spark, "").collect()
    assert small_fits.count(label) == 1 and rows
    if name == "next_day_forecast":
        assert len(rows) == 48
    if name == "poisson_trees_metrics":
        assert [r.model for r in rows] == ["trees", "linear"] and rows[0].rows == rows[1].rows > 0


def test_importance_scores_changed_copies_only(spark, monkeypatch):
    """a copy that gets the value it had isn't scored; the result is that of scoring all of them."""
    df = spark.range(300).select("id", (F.col("id") % 7).cast("double").alias("x"), F.lit(3.0).alias("same"), F.when(F.col("id") % 3 > 0, (F.col("id") % 2).cast("double")).alias("gap"))
    df = df.withColumn("v", F.when(F.col("id") % 10 > 0, F.expm1(F.col("x") / 2))).persist()
    names = ["x", "same", "gap"]
    model = models.fit_log_trees(df.where("v IS NOT NULL"), names, "v", maxIter=3, maxDepth=3)
    scored, predict = [], models.predict

    def spy(model, rows, *rest):
        scored.append(rows)
        return predict(model, rows, *rest)

    monkeypatch.setattr(models, "predict", spy)
    got = {r.feature: r.mae_increase for r in models.permutation_importance(model, df, names, "v", True, ["id"], 2).collect()}
    assert set(got) == set(names) and got["same"] == 0.0
    assert scored[-1].where("_which = 'same'").count() == 0 and 0 < scored[-1].where("_which = 'gap'").count() < 600
    # All copies by hand: the same dealing, each feature swapped and scored on its own.
    before = predict(model, df, names, True).agg(F.avg(F.abs(F.col("v") - F.col("prediction")))).first()[0]
    copies = df.withColumn("_repeat", F.explode(F.array(F.lit(1), F.lit(2))))
    place = Window.partitionBy("_repeat")
    mixed = copies.select("_repeat", F.row_number().over(place.orderBy(F.xxhash64("id", F.lit(models.SEED + 1), "_repeat"), "id")).alias("_i"), F.col("x").alias("_x2"))
    swapped = copies.withColumn("_i", F.row_number().over(place.orderBy("id"))).join(mixed, ["_repeat", "_i"]).withColumn("x", F.col("_x2")).drop("_x2")
    after = predict(model, swapped, names, True).agg(F.avg(F.abs(F.col("v") - F.col("prediction")))).first()[0]
    assert got["x"] == pytest.approx(after - before)
    assert models.permutation_importance(model, df.limit(0), names, "v", True, ["id"], 2).count() == 0


def test_poisson_rounds_start_from_written_margins(spark, monkeypatch):
    """the plan below the cells isn't part of the rounds."""
    written = []
    monkeypatch.setattr(models, "written_once", lambda df, label: (written.append(label), once(df, label))[1])
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 3.0), (1.0, 10.0), (1.0, 6.0)], "x double, v double")
    models.fit_poisson_trees(df, ["x"], "v", maxIter=1, maxDepth=1)
    assert written == ["margins"]


@pytest.fixture
def gaps(spark):
    """Totals with holes, an entity without a name, one without any hour of the span, and a value of none."""
    rows = [(f"s{i % 4}" if i % 13 else None, T0 + dt.timedelta(hours=7 * i % 400), float(i % 17) if i % 5 else None) for i in range(150)]
    rows += [("late", None, 3.0), ("early", T0 - dt.timedelta(days=90), 2.0)]
    return spark.createDataFrame(rows, "e string, ts timestamp_ntz, v double").groupBy("e", "ts").agg(F.sum("v").alias("v")).persist()


def test_a_folded_grid_holds_the_same_rows(rows, gaps):
    """one row an entity stands for all of its hours, also after the newest days are parted from it."""
    dense = grid.dense_grid(gaps, "e", "ts", "v", last_days=14)
    folded = grid.dense_grid(gaps, "e", "ts", "v", last_days=14, folded=True)
    want = rows(dense, "e", "ts", "v")
    assert folded.count() == 7 and len(want) == 7 * 14 * 24 and rows(grid.opened(folded, "e", "ts", "v")) == want
    assert grid.span_hours(folded, "ts").count() == 14 * 24
    for part, other in zip(features.hold_out(dense, "ts", 5), features.hold_out(folded, "ts", 5), strict=True):
        assert rows(grid.opened(other, "e", "ts", "v")) == rows(part, "e", "ts", "v") != []
    with pytest.raises(ValueError):
        grid.dense_grid(gaps, "e", "ts", "v", drop_dst=True, folded=True)


def test_a_fit_of_folded_rows_is_that_of_all_rows(rows, gaps):
    """lookups, cells and trees of rows that are never opened."""
    dense = features.calendar(grid.dense_grid(gaps, "e", "ts", "v", last_days=14), "ts")
    train, test = features.hold_out(dense, "ts", 5)
    folded, _ = features.hold_out(grid.dense_grid(gaps, "e", "ts", "v", last_days=14, folded=True), "ts", 5)
    served, other = (features.serving_features(test, t, "e", "v") for t in (train, folded))
    assert rows(served, "e", "ts", "station_mean", "profile_mean") == rows(other, "e", "ts", "station_mean", "profile_mean")
    kept = features.serving_features(folded, folded, "e", "v")
    a = models.fit_log_trees(features.serving_features(train, train, "e", "v"), features.SERVING, "v", maxIter=4, maxDepth=4)
    b = models.fit_log_trees(kept, features.SERVING, "v", maxIter=4, maxDepth=4)
    first = models.predict(a, served, features.SERVING, True)
    both = models.predict(b, first, features.SERVING, True, "other").agg(F.max(F.abs(F.col("prediction") - F.col("other"))).alias("off"), F.max("prediction").alias("most")).first()
    assert both.off < 1e-9 < both.most
    # All rows are in the cells, with their labels.
    with models._crossed_cells(kept, features.SERVING, models.BINS, "l") as (_, cells):
        total = cells.agg(F.sum("_n").alias("n"), F.sum(F.col("_n") * F.col("l")).alias("l")).first()
    assert total.n == train.count() and total.l == pytest.approx(train.agg(F.sum(F.log1p("v"))).first()[0])


def test_threshold_rows_of_a_folded_grid(rows, gaps):
    """all rows while they are few, else rows of which each has the same chance, the same in any layout."""
    folded = grid.dense_grid(gaps, "e", "ts", "v", last_days=14, folded=True)
    kept = features.serving_features(folded, folded, "e", "v")
    everything = rows(kept.sample(7 * 14 * 24, 1), "e", "_at")
    assert everything == rows(grid.opened(folded, "e", "ts", "v"), "e", "ts")
    some = rows(kept.sample(200, 1), "e", "_at")
    assert 190 < len(some) < 320 and len(set(some)) == len(some) and set(some) < set(everything)
    moved = features.serving_features(folded.repartition(3, "_found"), folded, "e", "v")
    assert rows(moved.sample(200, 1), "e", "_at") == some


def test_training_opens_only_the_days_held_out(spark, tmp_path, gaps, monkeypatch):
    """neither of the two fits gets a row for each hour."""
    from tidemark.plans import train

    fact = gaps.select(F.col("e").alias(train.ENTITY), F.col("ts").alias(train.TS), F.col("v").alias("ridership"))
    fitted, fit, openings, opened = [], models.fit_log_trees, [], grid.opened
    monkeypatch.setattr(models, "fit_log_trees", lambda rows, *a, **k: (fitted.append(rows), fit(rows, *a, **k))[1])
    monkeypatch.setattr(grid, "opened", lambda df, *a: (openings.append(opened(df, *a).count()), opened(df, *a))[1])
    registry = Registry(spark, str(tmp_path))
    train.train(fact, registry, days=14, hold_out_days=5, maxIter=2, maxDepth=2)
    assert [type(rows) for rows in fitted] == [features.Crossed] * 2 and openings == [7 * 5 * 24]
    row = registry.models().first()
    assert row.data_end - row.data_start == dt.timedelta(hours=14 * 24 - 1) and '"test_rows": 840' in row.metrics
    assert train.station_hours(fact, 14).count() == 7


def test_equal_rows_are_solved_as_one(spark, monkeypatch):
    """the solver reads each different row once in a round, and finds what it finds over all rows."""
    df = spark.range(4000).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("z"), F.lit(0.0).alias("profile_mean"))
    df = df.withColumn("v", F.floor(F.exp(F.col("x") * 0.3 - F.col("z") * 0.2)) + (F.col("x") % 2))
    read, few = [], models._few_cells
    monkeypatch.setattr(models, "_few_cells", lambda grouped, held: (read.append(grouped.count()), few(grouped, held))[1])
    model = models.fit_poisson(df, ["x", "z"], "v").stages[-1]
    assert read == [30]
    data = VectorAssembler(inputCols=["x", "z"], outputCol="f").transform(df)
    rows = GeneralizedLinearRegression(family="poisson", link="log", maxIter=25, regParam=1e-3, featuresCol="f", labelCol="v").fit(data)
    assert [*model.coefficients, model.intercept] == pytest.approx([*rows.coefficients, rows.intercept], rel=1e-6)


def test_metrics_of_equal_rows(spark):
    """rows that are equal count by their number."""
    df = spark.range(900).select(F.when(F.col("id") % 7 > 0, (F.col("id") % 5).cast("double")).alias("y"), (F.col("id") % 3 + 0.5).alias("p"))
    one = models.alike(df, ["y", "p"])
    assert one.count() == 18 and one.agg(F.sum("_n")).first()[0] == 900
    assert [*models.regression_metrics(one, "y", "p", "_n").first()] == pytest.approx([*models.regression_metrics(df, "y", "p").first()])
    for figure in (models.poisson_deviance, models.mean_error):
        assert one.agg(figure("y", "p", "_n")).first()[0] == pytest.approx(df.agg(figure("y", "p")).first()[0])
    assert [*models.regression_metrics(one.limit(0), "y", "p", "_n").first()] == [0] + [None] * 4 == [*models.regression_metrics(df.limit(0), "y", "p").first()]


def test_cells_of_stored_rows_persist_only_cells(spark, monkeypatch):
    """rows that can be read twice are not kept, and their cells are the same."""
    df = spark.range(3000).select((F.col("id") % 90).cast("double").alias("x"), (F.col("id") % 4).cast("double").alias("z"), (F.col("id") % 7).cast("double").alias("y"))
    found, kept, persist = [], [], type(df).persist
    monkeypatch.setattr(type(df), "persist", lambda self, *a: (kept.append(self.count()), persist(self, *a))[1])
    for stored in (False, True):
        kept.clear()
        with models._cells(df, ["x", "z"], 16, "y", stored=stored) as (_, cells):
            found.append(sorted((tuple(r["_x"]), r["_n"], round(r["y"], 9)) for r in cells.collect()))
        assert max(kept) == (len(found[0]) if stored else 3000)
    assert found[0] == found[1]
