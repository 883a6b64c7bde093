"""The batch jobs end to end: idempotence, revisions, vanished days, gates, polls."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import model
from tidemark.operators.quality import QualityError
from tidemark.plans import batch, poll
from tidemark.sources.tables import MonthTable

SCHEMA = model.SOURCE_SCHEMA.simpleString()[7:-1].replace(":", " ") + ", source_updated_at timestamp_ntz"


def source(spark, days, revised=(), bad=()):
    data = []
    for day in days:
        for hour in (7, 8):
            for station, mode in (("1", "subway"), ("2", "tram")):
                t = dt.datetime.combine(day, dt.time(hour))
                r = 10.0 + day.day + (1.0 if day in revised else 0.0)
                lat = 99.0 if day in bad else 40.7
                data.append((t, mode, station, f"S{station}", "Queens", "omny", "OMNY - Full Fare", r, 2.0, lat, -73.9, f"POINT (-73.9 {lat})", t + dt.timedelta(days=6 if day in bad else 7)))
    return spark.createDataFrame(data, SCHEMA)


MARCH = [dt.date(2025, 3, d) for d in (1, 2, 3)]
APRIL = [dt.date(2025, 4, d) for d in (1, 2)]


@pytest.fixture
def lake(spark, tmp_path):
    return batch.Lake(spark, str(tmp_path / "lake"))


def runs(lake):
    return [(r.status, r.days_fetched, r.months_built) for r in lake.runs.read().orderBy("started_at").collect()]


def verified(lake):
    assert [r.failing for r in batch.verify(lake).collect()] == [0, 0, 0]


def test_batch_run_life_cycle(spark, lake):
    batch.run_batch(lake, source(spark, MARCH + APRIL))
    verified(lake)
    assert lake.daily_station.read().count() == 10 and lake.stations.read().count() == 2
    assert lake.dates.read().count() == 33  # gap-free span
    assert lake.quality.read().count() == 2 * 12

    batch.run_batch(lake, source(spark, MARCH + APRIL))  # nothing changed
    batch.run_batch(lake, source(spark, MARCH + APRIL, revised=[MARCH[1]]))  # one day revised
    verified(lake)
    assert lake.daily_station.read().where(F.col("day") == MARCH[1]).first().ridership == 26

    batch.run_batch(lake, source(spark, MARCH[:2] + APRIL, revised=[MARCH[1]]))  # one day vanished
    verified(lake)
    assert lake.daily_station.read().where(F.col("day") == MARCH[2]).count() == 0

    batch.run_batch(lake, source(spark, MARCH[:2], revised=[MARCH[1]]))  # a whole month vanished
    verified(lake)
    assert lake.daily_class.read().agg(F.max("day")).first()[0] == MARCH[1]
    assert [r.month for r in lake.versions.read().collect()] == [dt.date(2025, 3, 1)]
    assert runs(lake) == [
        ("success", 5, "2025-03, 2025-04"),
        ("success", 0, ""),
        ("success", 1, "2025-03"),
        ("success", 0, "2025-03"),
        ("success", 0, ""),
    ]
    assert {r.table: r.rows for r in batch.serving_summary(lake).collect()}["dim_station"] == 2


def test_gate_stops_before_any_month_is_written_and_the_month_stays_due(spark, lake):
    with pytest.raises(QualityError, match="2025-04 outside_nyc: 4"):
        batch.run_batch(lake, source(spark, MARCH + APRIL, bad=[APRIL[0]]))
    assert runs(lake)[0][0] == "failed" and lake.daily_station.read() is None
    failed = lake.runs.read().first()
    assert failed.stage == "gate" and "outside_nyc" in failed.message
    batch.run_batch(lake, source(spark, MARCH + APRIL))  # only April's bad day differs, both months are due
    verified(lake)
    assert runs(lake)[-1] == ("success", 1, "2025-03, 2025-04")


def test_limited_days_and_rebuild(spark, lake):
    batch.run_batch(lake, source(spark, MARCH + APRIL), limit_days=1)
    assert [r.day for r in lake.fingerprints.read().collect()] == [APRIL[1]]
    batch.run_batch(lake, source(spark, MARCH + APRIL))
    batch.run_batch(lake, source(spark, MARCH + APRIL), rebuild=True)
    verified(lake)
    assert runs(lake)[-1] == ("success", 0, "2025-03, 2025-04")


def test_etl_run(spark, lake):
    batch.run_etl(lake, source(spark, MARCH + APRIL))
    assert lake.dates.read().count() == 5  # observed days only
    assert "is_dst_transition" in lake.hourly.read().columns
    batch.run_etl(lake, source(spark, MARCH + APRIL))
    batch.run_etl(lake, source(spark, MARCH + APRIL, revised=[APRIL[0]]))
    assert runs(lake) == [("success", 5, "2025-03, 2025-04"), ("success", 0, ""), ("success", 2, "2025-04")]
    doubled = source(spark, MARCH)
    with pytest.raises(QualityError, match="no duplicate keys"):
        batch.run_etl(batch.Lake(spark, lake.path + "2"), doubled.union(doubled.limit(1)))


def test_incremental_cycles(spark, tmp_path):
    store = poll.Store(spark, str(tmp_path / "poll"))
    init = dt.datetime(2025, 1, 1)
    first = poll.cycle(source(spark, MARCH), store, batch.marts.TS, init)
    assert (first["rows_fetched"], first["rows_written"]) == (12, 12)
    doubled = source(spark, MARCH + APRIL)
    second = poll.cycle(doubled.union(source(spark, APRIL)), store, batch.marts.TS, init)
    assert (second["rows_fetched"], second["dup_in_batch"], second["dup_already_stored"], second["rows_written"]) == (16, 8, 0, 8)
    third = poll.cycle(doubled, store, batch.marts.TS, init)
    assert third["rows_fetched"] == 0 and third["watermark_after"] == second["watermark_after"]
    # After a lost watermark everything is fetched again and recognised.
    store.state.replace(store.state.read().limit(0))
    fourth = poll.cycle(doubled, store, batch.marts.TS, init)
    assert (fourth["dup_already_stored"], fourth["rows_written"], fourth["watermark_after"]) == (20, 0, second["watermark_after"])
    assert store.rows(doubled).count() == 20
    assert spark.read.json(f"{store.path}/log").count() == 4


def test_snapshot_months(spark, tmp_path):
    s = source(spark, MARCH + APRIL)
    expected = poll.expected_by_month(s, batch.marts.TS)
    short = expected.withColumn("expected_rows", F.when(F.month("month") == 4, 9).otherwise(F.col("expected_rows")))
    got = {r.month.month: (r.days, r.rows, r.complete) for r in poll.merge_months(s, str(tmp_path / "m"), batch.marts.TS, short).collect()}
    assert got == {3: (3, 12, True), 4: (2, 8, False)}


def test_row_flow(spark):
    s = source(spark, MARCH)
    assert [(r.stage, r.rows) for r in batch.row_flow({"extract": s, "marts": s.limit(2)}).orderBy("step").collect()] == [("extract", 12), ("marts", 2)]


def test_short_months_are_read_again_a_bounded_number_of_times(spark, tmp_path):
    rows = source(spark, MARCH + APRIL).select("transit_timestamp", "station_complex_id")
    expected = poll.expected_by_month(rows, "transit_timestamp")
    asked = []

    def read(months, attempt):
        asked.append((attempt, [m.month for m in months]))
        inside = rows.where(F.trunc("transit_timestamp", "MM").isin(months))
        # April never comes whole, March at the second attempt.
        return inside.where("month(transit_timestamp) = 3" if attempt > 1 else "day(transit_timestamp) = 1 AND month(transit_timestamp) = 3")

    store = MonthTable(spark, str(tmp_path), "transit_timestamp")
    log = poll.fetch_pieces(read, expected, store, attempts=3)
    got = sorted((r.attempt, r.month.month, r.expected_rows, r.fetched_rows) for r in log.collect())
    assert got == [(1, 3, 12, 4), (1, 4, 8, 0), (2, 3, 12, 12), (2, 4, 8, 0), (3, 4, 8, 0)]
    assert asked == [(1, [3, 4]), (2, [3, 4]), (3, [4])]
    assert [(r.month.month, r.attempts, r.fetched_rows) for r in poll.short_pieces(log).collect()] == [(4, 3, 0)]
    nothing = MonthTable(spark, str(tmp_path / "none"), "transit_timestamp")
    assert poll.fetch_pieces(lambda months, attempt: rows.limit(0), expected, nothing, attempts=1).count() == 2
