import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import model
from tidemark.operators import marts, quality
from tidemark.operators.quality import QualityError

T = dt.datetime(2025, 3, 5, 8)
GOOD = dict(
    transit_timestamp=T, transit_mode="subway", station_complex_id="A", station_complex="Alpha", borough="Queens",
    payment_method="omny", fare_class_category="OMNY - Full Fare", ridership=5.0, transfers=1.0,
    latitude=40.7, longitude=-73.9, georeference="POINT (-73.9 40.7)",
)
# One way to violate each rule.
BROKEN = {
    "missing_value": dict(station_complex=None),
    "invalid_category": dict(borough="Hoboken"),
    "nonpositive_ridership": dict(ridership=0.0, transfers=0.0),
    "negative_transfers": dict(transfers=-2.0),
    "transfers_exceed_ridership": dict(transfers=9.0),
    "non_integer_count": dict(ridership=5.5),
    "outside_nyc": dict(latitude=41.5, georeference="POINT (-73.9 41.5)"),
    "not_on_hour": dict(transit_timestamp=dt.datetime(2025, 3, 5, 8, 30)),
    "fare_class_payment_mismatch": dict(payment_method="metrocard"),
    "station_mode_mismatch": dict(transit_mode="tram"),
    "georeference_mismatch": dict(georeference="POINT (-73.8 40.7)"),
    "dst_transition_hour": dict(transit_timestamp=dt.datetime(2025, 3, 9, 2)),
}


def frame(spark, changes):
    return spark.createDataFrame([tuple({**GOOD, **c}[n] for n in model.SOURCE_COLUMNS) for c in changes], model.SOURCE_SCHEMA)


def moded(df):
    mode = quality.dominant_value(df.where("station_complex_id IS NOT NULL"), "station_complex_id", "transit_mode", "station_mode")
    return quality.with_station_mode(df, mode)


def padded(*changes):
    return [{}, {}, {}, *changes]


@pytest.mark.parametrize("tag", BROKEN)
def test_each_rule_finds_its_row_only(spark, tag):
    got = {r.tag: r.rows for r in quality.counts_long(moded(frame(spark, padded(BROKEN[tag]))), quality.fact_rules()).collect()}
    assert got == {tag: 1}


def test_clean_rows_have_no_tags(spark):
    assert quality.flagged(moded(frame(spark, padded())), quality.fact_rules()).count() == 0


def test_two_rules_on_one_row_are_sorted(spark):
    df = moded(frame(spark, padded(dict(transfers=-1.5))))
    tags = quality.flagged(df, quality.fact_rules()).first().error_tags
    assert tags == ["negative_transfers", "non_integer_count"]


def test_null_station_is_counted(spark):
    """A NULL id joins no mode but must reach the gate."""
    df = moded(frame(spark, padded(dict(station_complex_id=None))))
    wide = quality.counts_wide(df, quality.fact_rules()).first()
    assert wide.missing_value == 1 and wide.station_mode_mismatch == 0


def test_gate_blocks_errors_and_lets_repairable_rows_pass(spark):
    rules = quality.fact_rules()
    repairable = padded(BROKEN["negative_transfers"], BROKEN["station_mode_mismatch"], BROKEN["dst_transition_hour"])
    assert quality.gate(moded(frame(spark, repairable)), rules)["negative_transfers"] == 1
    with pytest.raises(QualityError, match="outside_nyc"):
        quality.gate(moded(frame(spark, padded(BROKEN["outside_nyc"]))), rules)


def test_clean_repairs_and_marks(spark):
    df = moded(frame(spark, padded(BROKEN["negative_transfers"], BROKEN["station_mode_mismatch"], BROKEN["dst_transition_hour"])))
    out = quality.clean(df)
    assert dict(out.dtypes)["ridership"] == dict(out.dtypes)["transfers"] == "int"
    assert {r.transit_mode for r in out.collect()} == {"subway"}
    assert out.agg(F.min("transfers")).first()[0] == 0
    assert out.where("is_dst_transition").count() == 1
    after = out.withColumn("station_mode", F.col("transit_mode"))
    assert {r.tag for r in quality.counts_long(after, quality.fact_rules()).collect()} == {"dst_transition_hour"}


def test_month_table_keeps_zero_rows(spark):
    df = moded(frame(spark, padded(dict(transit_timestamp=dt.datetime(2025, 4, 1, 1), transfers=-1.0))))
    got = quality.counts_by_month(df, quality.fact_rules())
    assert got.count() == 2 * 12
    assert [(r.month, r.rows) for r in got.where("tag = 'negative_transfers'").orderBy("month").collect()] == [
        (dt.date(2025, 3, 1), 0),
        (dt.date(2025, 4, 1), 1),
    ]


def test_scores(spark, rows):
    df = moded(frame(spark, padded(BROKEN["missing_value"])))  # four rows with one key
    got = {r.dimension: (r.failing_rows, r.score_pct) for r in quality.dimension_scores(df, quality.fact_rules(), model.ROW_KEY).collect()}
    assert got["Completeness"] == (1, 75.0) and got["Uniqueness"] == (3, 25.0) and got["All row-level rules"] == (1, 75.0)


def test_before_after_totals(spark):
    df = frame(spark, padded(BROKEN["negative_transfers"]))
    r = quality.before_after_totals(df, quality.clean(moded(df))).first()
    assert (r.rows_before, r.rows_after, r.transfers_change, r.zeroed_transfers, r.only_negatives_changed) == (4, 4, 2.0, 2.0, True)


def test_post_checks_pass_and_fail(spark):
    keys = [dict(transit_timestamp=T + dt.timedelta(hours=i)) for i in range(3)]
    raw = frame(spark, keys)
    cleaned = quality.clean(moded(raw))
    hourly, daily = marts.hourly_by_method(cleaned), marts.daily_by_station(cleaned)
    assert all(r.passed for r in quality.post_checks(raw, cleaned, hourly, daily).collect())
    failed = {r.check for r in quality.post_checks(raw, cleaned.union(cleaned.limit(1)), hourly, daily).collect() if not r.passed}
    assert {"row count kept", "no duplicate keys", "hourly total equals clean"} <= failed


def test_dominant_value_ties_take_the_last_text(spark, rows):
    df = spark.createDataFrame([("k", "a"), ("k", "b"), ("j", "a"), ("j", "a"), ("j", "b")], "key string, c string")
    assert rows(quality.dominant_value(df, "key", "c", "m")) == [("j", "a"), ("k", "b")]


def test_counts_of_the_writing_pass_and_the_gate(spark, tmp_path):
    rules = quality.fact_rules()
    rows = moded(frame(spark, padded(BROKEN["negative_transfers"], BROKEN["station_mode_mismatch"], BROKEN["dst_transition_hour"])))
    counted = quality.write_gated(rows, rules, str(tmp_path / "clean"))
    assert counted.counts[""] == quality.counts_wide(rows, rules).first().asDict() and counted.value("rows") == rows.count()
    assert spark.read.parquet(str(tmp_path / "clean")).count() == rows.count()
    broken = moded(frame(spark, padded(BROKEN["outside_nyc"])))
    with pytest.raises(quality.QualityError, match="outside_nyc"):
        quality.write_gated(broken, rules, str(tmp_path / "stopped"))
    assert not (tmp_path / "stopped").exists() and not (tmp_path / "stopped-staged").exists()
