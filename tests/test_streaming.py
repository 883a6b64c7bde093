"""Hand-made snapshots: every rule of the delay job, batch against stream, replays."""

import datetime as dt
import json
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidemark.sources import feeds
from tidemark.sources.schedule import Schedule, load_schedule, scheduled_seconds, services_by_day
from tidemark.streaming import keyed, microbatch, records, replay

NY = ZoneInfo("America/New_York")
DAY = dt.date(2025, 7, 2)  # a Wednesday
T0 = int(dt.datetime(2025, 7, 2, 8, 0, tzinfo=NY).timestamp())
KEY = "084600_A..N"


def trip(trip_id=KEY, route="A", start="20250702", direction="NORTH"):
    return (trip_id, route, start, direction)


def update(stops, **kw):
    """Trip update of (stop, arrival, departure) triples."""
    return ("t", None, (trip(**kw), [tuple(s) for s in stops]), None)


def vehicle(status, **kw):
    return ("v", (trip(**kw), status), None, None)


def alert(id_, header, informed):
    return (id_, None, None, (header, informed))


def messages(spark, *rows):
    return spark.createDataFrame([(feed, t, i, ents) for i, (feed, t, ents) in enumerate(rows)], feeds.MESSAGE)


@pytest.fixture(scope="module")
def schedule(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("schedule")
    bom = "﻿"
    (folder / "trips.txt").write_text(f"{bom}route_id,trip_id,service_id\nA,W_{KEY}74R,wk\nA,X_{KEY}01R,extra\nA,nokey,wk\n", encoding="utf-8")
    (folder / "stop_times.txt").write_text(
        f"{bom}trip_id,stop_id,arrival_time\nW_{KEY}74R,101N,08:00:00\nW_{KEY}74R,101N,09:00:00\nW_{KEY}74R,102N,08:05:00\nW_{KEY}74R,103N,25:10:00\nW_{KEY}74R,104N,\n"
        f"X_{KEY}01R,101N,07:00:00\nX_{KEY}01R,105N,08:30:00\n",
        encoding="utf-8",
    )
    flags = "monday,tuesday,wednesday,thursday,friday,saturday,sunday"
    (folder / "calendar.txt").write_text(
        f"{bom}service_id,{flags},start_date,end_date\nwk,1,1,1,1,1,0,0,20250601,20250731\nextra,0,0,0,0,0,0,1,20250601,20250731\n", encoding="utf-8"
    )
    (folder / "calendar_dates.txt").write_text(
        f"{bom}service_id,date,exception_type\nwk,20250704,2\nextra,20250704,1\nextra,20250702,1\nonce,20250703,1\n", encoding="utf-8"
    )
    (folder / "stops.txt").write_text(f"{bom}stop_id,stop_name\n101N,First\n102N,Second\n", encoding="utf-8")
    return load_schedule(spark, str(folder))


def test_services(schedule):
    got = services_by_day(schedule).where("day BETWEEN date'2025-07-02' AND date'2025-07-06'")
    listed = {(r.day.day, r.service_id) for r in got.collect()}
    assert listed == {(2, "wk"), (2, "extra"), (3, "wk"), (3, "once"), (4, "extra"), (6, "extra")}


def test_scheduled_seconds_takes_the_first_service_and_the_first_listing(spark, schedule):
    keys = spark.createDataFrame(
        [(DAY, KEY, s) for s in ("101N", "103N", "104N", "105N")] + [(dt.date(2025, 7, 4), KEY, "101N")], "service_day date, trip_key string, stop_id string"
    )
    got = {(r.service_day.day, r.stop_id): r.seconds for r in scheduled_seconds(keys, schedule).collect()}
    # Both services run on the 2nd; the calendar one comes first. On the 4th only the added one runs.
    assert got == {(2, "101N"): 28800, (2, "103N"): 90600, (2, "105N"): 30600, (4, "101N"): 25200}


def run(spark, schedule, *rows):
    return replay.run(messages(spark, *rows), schedule)


def test_repeated_and_older_snapshots_are_skipped(spark, schedule):
    u = [update([("101N", T0 + 60, None)])]
    out = run(spark, schedule, ("f", T0, u), ("f", T0, u), ("f", T0 - 30, u), ("g", T0 - 30, u), ("f", T0 + 30, u))
    assert {r.offset: r.repeated for r in out["marks"].collect()} == {0: False, 1: True, 2: True, 3: False, 4: False}
    assert out["observations"].count() == 3


@pytest.mark.parametrize("late", [300, 301, 10_800, 10_801, -10_800])
def test_delay_bounds(spark, schedule, late):
    out = run(spark, schedule, ("f", T0 - 20_000, [update([("101N", T0 + late, None)])]))
    row = out["observations"].first()
    assert row.delay_s == (float(late) if abs(late) <= 10_800 else None)
    m = out["minute"].first()
    assert (m.observations, m.delay_observations, m.late_observations) == (1, int(abs(late) <= 10_800), int(300 < late <= 10_800))
    assert m.max_delay_s == row.delay_s and m.sum_delay_s == (row.delay_s or 0.0)


def test_next_stop_past_cutoff_departure_and_directions(spark, schedule):
    out = run(
        spark,
        schedule,
        ("f", T0, [
            update([("100N", T0 - 31, None), ("101N", T0 - 30, None), ("102N", T0 + 90, None)]),
            update([("100N", T0 - 31, None)], trip_id="085000_A..S"),  # all past: no observation
            update([("102N", None, T0 + 10)], trip_id="085100_B..S", route="B", direction=None),
            update([("102S", 0, T0 + 20)], trip_id="odd", route="B", direction=None),
            update([("102S", T0, None)], trip_id="085200_B..N", route="B", direction="SOUTH"),
        ]),
    )
    got = {r.trip_id: (r.stop_id, r.stop, r.predicted - T0, r.direction, r.trip_key) for r in out["observations"].collect()}
    assert got == {
        KEY: ("101N", "101", -30, "N", KEY),
        "085100_B..S": ("102N", "102", 10, "S", "085100_B..S"),
        "odd": ("102S", "102", 20, "N", None),
        "085200_B..N": ("102S", "102", 0, "S", "085200_B..N"),
    }


def test_stopped_trains_alone_make_a_minute_row(spark, schedule):
    out = run(spark, schedule, ("f", T0 + 7, [vehicle("STOPPED_AT"), vehicle(None), vehicle("IN_TRANSIT_TO"), vehicle("STOPPED_AT", trip_id="x..S", direction=None)]))
    got = {r.direction: (r.observations, r.stopped_at, r.max_delay_s) for r in out["minute"].collect()}
    assert got == {"N": (0, 1, None), "S": (0, 1, None)}


def test_arrival_needs_a_new_stop_and_a_due_prediction(spark, schedule):
    out = run(
        spark,
        schedule,
        ("f", T0, [update([("101N", T0 + 100, None), ("102N", T0 + 300, None)]), update([("101N", T0 + 500, None)], trip_id="early")]),
        ("f", T0 + 40, [update([("102N", T0 + 310, None)]), update([("102N", T0 + 900, None)], trip_id="early")]),
        ("f", T0 + 80, [update([("102N", T0 + 320, None)])]),
    )
    docs = out["arrivals"].collect()
    assert [(d.arrival_id, d.stop_name, d.delay_s) for d in docs] == [(f"20250702|{KEY}|101N", "First", 100.0)]
    assert docs[0].arrived_at.timestamp() == T0 + 100 and docs[0].observed_at.timestamp() == T0 + 40


def test_alerts(spark, schedule):
    first = alert("a", [("hola", "es"), ("hi", "en")], [("", "B", "t2"), ("A", "", ""), ("A", None, "t1")])
    second = alert("a", [("hola", "es")], [(None, "C", "")])
    out = run(spark, schedule, ("f", T0, [first]), ("f", T0 + 30, [alert("b", [("plain", "")], []), second]))
    got = {r.alert_id: (r.header, r.routes, r.trips) for r in out["alerts"].collect()}
    assert got == {"a": ("", ["C"], []), "b": ("plain", [], [])}
    alone = run(spark, schedule, ("f", T0, [first]))["alerts"].first()
    assert (alone.header, alone.routes, alone.trips) == ("hi", ["A", "B"], ["t1", "t2"])


# --- the job over several batches ---------------------------------------------------


def traffic():
    """Forty snapshots of two feeds; a train moves one stop every fourth snapshot."""
    out = []
    for i in range(40):
        t = T0 + 30 * (i // 2) + (0 if i % 7 else -30)
        stop = 101 + (i // 8)
        ents = [
            update([(f"{stop}N", t + 20 + i, None), (f"{stop + 1}N", t + 400, None)]),
            update([(f"{stop}S", t + 3 * i, None)], trip_id=f"09{i % 3}000_B..S", route="B", direction=None),
            vehicle("STOPPED_AT" if i % 3 == 0 else None),
        ]
        if i % 5 == 0:
            ents.append(alert(f"al{i % 10}", [(f"text {i}", "en")], [("A", "", f"trip{i}")]))
        out.append(("f" if i % 2 else "g", t, ents))
    return out


def land(spark, path, per_file):
    """One Parquet file per batch of messages, in time order of their names."""
    m = messages(spark, *traffic())
    for b in range(0, 40, per_file):
        part = m.where((F.col("offset") >= b) & (F.col("offset") < b + per_file)).coalesce(1)
        part.write.mode("append").parquet(str(path))
    return m


@pytest.mark.parametrize("per_file", [10])
def test_stream_equals_batch_and_replays_change_nothing(spark, schedule, tmp_path, per_file):
    m = land(spark, tmp_path / "in", per_file)
    want = replay.run(m, schedule)
    store = microbatch.BatchStore(spark, str(tmp_path / "store"))
    stream = feeds.file_stream(spark, str(tmp_path / "in"), max_files=1)
    microbatch.start(stream, store, lambda: schedule, str(tmp_path / "cp"), every=None).awaitTermination()
    assert store.batches("log") == [0, 1, 2, 3]

    def same(a, b):
        assert a.select(*b.columns).exceptAll(b).count() == 0 and b.exceptAll(a.select(*b.columns)).count() == 0

    def all_same():
        same(store.minutes(), want["minute"])
        same(store.hours(), want["hour"])
        same(store.arrivals().drop("batch_id"), want["arrivals"])
        same(store.alerts().drop("batch_id"), want["alerts"])

    all_same()
    assert want["arrivals"].count() > 3

    # Batch 3 runs again with the same id, as after a lost commit.
    again = m.where("offset >= 30")
    microbatch.process(again, 3, store, schedule)
    all_same()

    log = store.batch_log().orderBy("batch_id").collect()
    assert [(r.offset_from, r.offset_to) for r in log] == [(0, 9), (10, 19), (20, 29), (30, 39)]
    metrics = microbatch.batch_metrics(store.batch_log()).first()
    assert metrics.batches == 4 and metrics.unique_ids and metrics.contiguous and metrics.messages == 40
    assert microbatch.lag_behind(store.batch_log(), 45).first().lag == 5

    # Folding finished batches keeps every total.
    store.fold(keep=1)
    assert store.batches("minute") == [3]
    all_same()
    microbatch.process(again, 3, store, schedule)
    store.fold(keep=1)
    all_same()

    compared = replay.compare_minutes(want["minute"], store.minutes())
    assert compared.count() > 0 and compared.where("different").count() == 0
    full = replay.full_minutes(want["minute"])
    found = replay.arrivals_found(want["arrivals"], store.arrivals(), full).first()
    assert found.expected == found.found


def test_a_batch_that_died_between_two_outputs_is_not_seen(spark, schedule, tmp_path, monkeypatch):
    m = messages(spark, *traffic())
    store = microbatch.BatchStore(spark, str(tmp_path / "store"))
    microbatch.process(m.where("offset < 20"), 0, store, schedule)
    before = {name: getattr(store, name)().count() for name in ("minutes", "hours", "arrivals", "alerts")}
    write = store.write

    def broken(table, batch_id, df):
        if table == "log":
            raise OSError("lost")
        write(table, batch_id, df)

    monkeypatch.setattr(store, "write", broken)
    with pytest.raises(OSError):
        microbatch.process(m.where("offset >= 20"), 1, store, schedule)
    assert {name: getattr(store, name)().count() for name in before} == before and store.batches("minute") == [0]
    monkeypatch.setattr(store, "write", write)
    microbatch.process(m.where("offset >= 20"), 1, store, schedule)
    want = replay.run(m, schedule)
    assert store.minutes().exceptAll(want["minute"].select(*store.minutes().columns)).count() == 0 and store.minutes().count() == want["minute"].count()


def test_upkeep_prunes_old_minutes_and_log_rows_but_no_hours(spark, tmp_path):
    store = microbatch.BatchStore(spark, str(tmp_path / "store"))
    start = dt.datetime(2025, 1, 1, 12, tzinfo=dt.UTC)
    for n in range(24):
        at = start + dt.timedelta(days=n)
        minute = [(at, "A", "N", 1, 1, 0, 5.0, 0, 5.0)]
        store.write("minute", n, spark.createDataFrame(minute, "minute timestamp, route_id string, direction string, observations long, delay_observations long, late_observations long, sum_delay_s double, stopped_at long, max_delay_s double"))
        store.write("hour", n, spark.createDataFrame([(at, "S1", "A", 1, 1, 5.0)], "hour timestamp, stop string, route_id string, observations long, delay_observations long, sum_delay_s double"))
        store.write("arrivals", n, spark.createDataFrame([(f"a{n % 5}", n)], "arrival_id string, v int"))
        store.write("alerts", n, spark.createDataFrame([(f"b{n % 5}", n)], "alert_id string, v int"))
        for table, kinds in microbatch.STATE_SCHEMAS.items():
            store.write(table, n, spark.createDataFrame([], kinds))
        store.write("log", n, spark.createDataFrame([(1, at)], "messages long, processed_at timestamp"))
        store.upkeep(n, every=8)
    assert store.batches("minute") == [23] and store.batches("log") == [23] and store.batches("trips") == [21, 22, 23]
    assert store.hours().count() == 24 and store.minutes().count() == 16 and store.batch_log().count() == 16
    assert sorted(r.v for r in store.arrivals().collect()) == [19, 20, 21, 22, 23] == sorted(r.v for r in store.alerts().collect())
    store.write("minute", 23, spark.createDataFrame(minute, store.minutes().schema).select(*store.minutes().columns))
    assert store.minutes().agg({"observations": "sum"}).first()[0] == 16


def test_window_after_priming_equals_the_whole_run(spark, schedule):
    m = messages(spark, *traffic())
    whole = replay.run(m, schedule)
    part = replay.replay(m, schedule, (0, 20), (20, 40))
    assert part["observations"].count() == whole["observations"].where("offset >= 20").count()
    a = {r.arrival_id for r in part["arrivals"].collect()}
    assert a and a <= {r.arrival_id for r in whole["arrivals"].collect()}


def test_idle_trips_leave_the_state(spark, schedule):
    obs = run(spark, schedule, ("f", T0, [update([("101N", T0 + 10, None)])]), ("f", T0 + 7201, [update([("101N", T0 + 9000, None)], trip_id="b")]))["observations"]
    assert [r.trip_id for r in records.next_trip_state(obs, None).collect()] == ["b"]


def test_stream_checks(spark, schedule):
    m = messages(spark, *traffic())
    out = replay.run(m, schedule)
    assert all(r.passed for r in replay.stream_checks(out, records.message_profile(m)).collect())


def test_records_round_trip(spark, tmp_path):
    m = messages(spark, *traffic())
    feeds.write_records(feeds.encode(m, F.lit(T0)), "parquet", path=str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert json.loads(bytes(back.first()["value"]))["entities"]
    assert bytes(back.first().headers[0].value) == str(T0).encode()
    decoded = feeds.decode(back.withColumn("offset", F.lit(1).cast("bigint")))
    assert decoded.select("feed", "feed_time", "entities").exceptAll(m.select("feed", "feed_time", "entities")).count() == 0
    assert feeds.read_offsets(spark, 3, 6, path=str(_landed(spark, m, tmp_path))).count() == 3


def _landed(spark, m, tmp_path):
    m.write.parquet(str(tmp_path / "topic"))
    return tmp_path / "topic"


def test_average_and_route_delays(spark, schedule):
    out = run(spark, schedule, ("f", T0 - 20_000, [update([("101N", T0 + 100, None)]), update([("900N", T0 + 100, None)], trip_id="x", route="Z")]))
    got = {r.route_id: r.avg_delay_s for r in records.average_delay(out["minute"]).collect()}
    assert got == {"A": 100.0, "Z": None}
    assert {r.route_id: r.median_s for r in records.route_delays(out["observations"]).collect()} == {"A": 100.0, "Z": None}


def test_schedule_type():
    assert set(Schedule.__dataclass_fields__) == {"trips", "stop_times", "calendar", "calendar_dates", "stops", "first", "services"}


# --- the job with its state in the engine ---------------------------------------------


def start_all(spark, schedule, tmp_path, live_seconds=records.STATE_SECONDS, totals=True):
    """Land what is there and bring every other query up to date; starting again goes on from the checkpoints."""
    store = microbatch.BatchStore(spark, str(tmp_path / "store"))
    stream = feeds.file_stream(spark, str(tmp_path / "in"), max_files=1)
    keyed.start_landing(stream, store, lambda: schedule, str(tmp_path / "cp-landing"), every=None).awaitTermination()
    facts = keyed.fact_stream(spark, store.path)
    keyed.start_arrivals(facts, store, schedule.stops, str(tmp_path / "cp-arrivals"), every=None, live_seconds=live_seconds).awaitTermination()
    for name in keyed.TOTALS if totals else ():
        keyed.start_totals(name, facts, store, str(tmp_path / f"cp-{name}"), every=None).awaitTermination()
    return store


def same(a, b):
    assert a.select(*b.columns).exceptAll(b).count() == 0 and b.exceptAll(a.select(*b.columns)).count() == 0


def test_keyed_stream_equals_batch_over_a_restart(spark, schedule, tmp_path):
    m = messages(spark, *traffic())
    for b in range(0, 20, 10):
        m.where((F.col("offset") >= b) & (F.col("offset") < b + 10)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    with keyed.logged(spark, str(tmp_path / "progress")):
        start_all(spark, schedule, tmp_path)
        for b in range(20, 40, 10):
            m.where((F.col("offset") >= b) & (F.col("offset") < b + 10)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        store = start_all(spark, schedule, tmp_path)
    want = replay.run(m, schedule)
    same(keyed.newest(store, "minutes"), want["minute"])
    same(keyed.newest(store, "hours"), want["hour"])
    same(keyed.newest(store, "arrivals"), want["arrivals"])
    assert want["arrivals"].count() > 3

    log = sorted((r.batch_id, r.messages, r.offset_from, r.offset_to) for r in store.batch_log().collect())
    assert log == [(k, 10, 10 * k, 10 * k + 9) for k in range(4)]
    assert sum(r.skipped for r in store.batch_log().collect()) == want["marks"].where("repeated").count()

    # The engine's own report: a row for each query and batch, offsets and state included.
    rows = keyed.progress(spark, str(tmp_path / "progress")).collect()
    landed = sorted((r.batch_id, r.input_rows) for r in rows if r.query == "landing" and r.input_rows)
    assert landed == [(k, 10) for k in range(4)]
    assert {r.query for r in rows} == {"landing", "arrivals", "minutes", "hours"}
    assert all(r.seconds > 0 and r.offset_to for r in rows if r.input_rows)
    assert max(r.state_rows for r in rows if r.query == "arrivals") >= 2 and max(r.watermark.year for r in rows if r.watermark) == 2025


def test_a_batch_that_runs_again_changes_nothing(spark, schedule, tmp_path):
    land(spark, tmp_path / "in", 20)
    store = start_all(spark, schedule, tmp_path)
    before = {name: keyed.newest(store, name).collect() for name in ("minutes", "hours", "arrivals")}
    files = sorted(f.name for f in (tmp_path / "store" / "facts").glob("*/*.parquet"))
    # The commit of the last batch of every query is lost, as in a crash before it was written.
    for query in ("landing", "arrivals", "minutes", "hours"):
        commits = tmp_path / f"cp-{query}" / "commits"
        last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
        (commits / str(last)).unlink()
        (commits / f".{last}.crc").unlink(missing_ok=True)
    start_all(spark, schedule, tmp_path)
    for name, rows in before.items():
        assert sorted(map(str, keyed.newest(store, name).collect())) == sorted(map(str, rows))
    assert sorted(f.name for f in (tmp_path / "store" / "facts").glob("*/*.parquet")) == files
    assert store.batch_log().count() == 2
    # Folding the older batches keeps every key's last row; a second fold finds nothing to do.
    for name, rows in before.items():
        store.write(name, 7, spark.read.parquet(f"{store.path}/{name}/batch_id=0").limit(0))
        keyed.fold(store, name)
        keyed.fold(store, name)
        assert store._folders(name) == [7] and store._base(name) is not None
        assert sorted(map(str, keyed.newest(store, name).collect())) == sorted(map(str, rows))
    keyed.drop_facts(store, 1)
    assert sorted(f.name for f in (tmp_path / "store" / "facts").iterdir()) == ["batch_id=000000000001"]


def test_a_landing_that_died_half_way_runs_again(spark, schedule, tmp_path, monkeypatch):
    m = messages(spark, *traffic())
    store = microbatch.BatchStore(spark, str(tmp_path / "store"))
    keyed.land(m.where("offset < 20"), 0, store, schedule)
    write = store.write

    def broken(table, batch_id, df):
        if table == "feeds":
            raise OSError("lost")
        write(table, batch_id, df)

    monkeypatch.setattr(store, "write", broken)
    with pytest.raises(OSError):
        keyed.land(m.where("offset >= 20"), 1, store, schedule)
    monkeypatch.setattr(store, "write", write)
    # The facts are there already; the second run adds none.
    keyed.land(m.where("offset >= 20"), 1, store, schedule)
    keyed.land(m.where("offset >= 20"), 1, store, schedule)
    facts = spark.read.schema(keyed.FACTS).parquet(f"{store.path}/facts/batch_id=*")
    want = replay.run(m, schedule)
    assert facts.where("kind = 'observation'").count() == want["observations"].count() and store.batches("log") == [0, 1]


def test_state_lives_for_two_hours_after_the_trip_was_seen(spark, schedule, tmp_path):
    """A train with a new next stop that is due each time: after just two hours, one second more, six hours; another train in between."""
    hour = 3600
    seen = [("a", 0), ("a", 2 * hour), ("a", 4 * hour + 1), ("b", 9 * hour), ("a", 10 * hour + 1), ("a", 10 * hour + 60), ("b", 16 * hour), ("b", 16 * hour + 30)]
    names = [c.split()[0] for c in keyed.FACTS.split(", ")]
    for i, (trip_id, t) in enumerate(seen):
        row = dict.fromkeys(names) | {"kind": "observation", "feed": "f", "feed_time": T0 + t, "offset": i, "pos": 0, "at": dt.datetime.fromtimestamp(T0 + t), "trip_id": trip_id, "stop_id": f"{200 + i}N", "predicted": T0 + t}
        keyed.publish(spark.createDataFrame([tuple(row.values())], keyed.FACTS).coalesce(1), f"{tmp_path}/facts/batch_id={i:012d}")
    store = microbatch.BatchStore(spark, str(tmp_path))
    with keyed.logged(spark, str(tmp_path / "progress")):
        keyed.start_arrivals(keyed.fact_stream(spark, store.path, 1), store, schedule.stops, str(tmp_path / "cp"), every=None, live_seconds=2 * hour).awaitTermination()
    assert sorted(r.stop_id for r in keyed.newest(store, "arrivals").collect()) == ["200N", "204N", "206N"]
    rows = keyed.progress(spark, str(tmp_path / "progress")).orderBy("batch_id").collect()
    # A timer took away the state of the train that was not seen any more.
    assert rows[-1].state_rows < max(r.state_rows for r in rows)


def test_state_that_stays_loses_no_arrival(spark, schedule, tmp_path):
    """The same train after six hours and, in a batch of its own, a feed far behind: both arrivals are there."""
    hour, names = 3600, [c.split()[0] for c in keyed.FACTS.split(", ")]
    for i, (trip_id, t) in enumerate([("a", 0), ("b", 0), ("a", 6 * hour), ("b", hour)]):
        row = dict.fromkeys(names) | {"kind": "observation", "feed": trip_id, "feed_time": T0 + t, "offset": i, "pos": 0, "at": dt.datetime.fromtimestamp(T0 + t), "trip_id": trip_id, "stop_id": f"{200 + i}N", "predicted": T0 + t}
        keyed.publish(spark.createDataFrame([tuple(row.values())], keyed.FACTS).coalesce(1), f"{tmp_path}/facts/batch_id={i:012d}")
    store = microbatch.BatchStore(spark, str(tmp_path))
    keyed.start_arrivals(keyed.fact_stream(spark, store.path, 1), store, schedule.stops, str(tmp_path / "cp"), every=None, live_seconds=None).awaitTermination()
    assert sorted(r.stop_id for r in keyed.newest(store, "arrivals").collect()) == ["200N", "201N"]


def test_two_rows_of_a_trip_in_one_batch_are_taken_in_order(spark, schedule, tmp_path):
    rows = [("f", T0 + 30 * i, [update([(f"{300 + i}N", T0 + 30 * i, None)])]) for i in range(6)]
    m = messages(spark, *rows)
    m.orderBy(F.desc("offset")).coalesce(1).write.parquet(str(tmp_path / "in"))
    store = start_all(spark, schedule, tmp_path, totals=False)
    assert sorted(r.stop_id for r in keyed.newest(store, "arrivals").collect()) == [f"{300 + i}N" for i in range(5)]


def test_a_prepared_schedule_is_not_made_again(spark):
    """F12 to F15: each start of the landing query prepares the schedule it is given."""
    from tidemark.sources.schedule import DailySchedule, Schedule

    one = lambda schema, *row: spark.createDataFrame([row], schema)
    days = "monday string, tuesday string, wednesday string, thursday string, friday string, saturday string, sunday string"
    raw = Schedule(
        one("trip_id string, service_id string", "AFA_000001_A..N", "A"),
        one("trip_id string, stop_id string, arrival_time string, _order long", "AFA_000001_A..N", "001N", "01:00:00", 1),
        one(f"service_id string, {days}, start_date string, end_date string, _order long", "A", *["1"] * 7, "20240101", "20240107", 1),
        spark.createDataFrame([], "service_id string, date string, exception_type string, _order long"),
        one("stop_id string, stop_name string", "001N", "First"),
    )
    plan = DailySchedule(lambda: raw).current()
    assert plan.first is not None and plan.services.count() == 7
    again = DailySchedule(lambda: plan).current()
    assert again.first is plan.first and again.services is plan.services and again.stops is plan.stops


def test_state_grows_with_the_events():
    """the facts of many events don't pass four tasks."""
    from tidemark.workload import feeds as workload

    assert [workload.state_partitions(n) for n in (0, 100_000, 2_000_001, 36_000_000)] == [4, 4, 5, 72]


def event_table(spark, path, rows):
    """``events`` of (event_id, ts, user_id, event_type, value, k) below ``path``."""
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame([(*r[:5], json.dumps({"k": r[5]})) for r in rows], kinds).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_first_arrivals_are_kept_in_place(spark, tmp_path):
    """the least place of a group was found by sorting all planned stops. A missing id comes first, ids may be as large as they get."""
    from tidemark.sources.schedule import first_arrivals
    from tidemark.workload import feeds as workload

    at = lambda minute: dt.datetime(2024, 1, 1, 10, minute)
    big = (1 << 63) - 1
    rows = [(big, at(0), 2, "view", 1.0, 15), (big - 1, at(40), 2, "view", 1.0, 17), (None, at(0), 4, "view", 1.0, 13), (-big, at(40), 4, "view", 1.0, 13)]
    found = first_arrivals(workload.schedule(spark, event_table(spark, tmp_path, rows)))
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    # 10:00 and 10:30 UTC, sixty days on, are 5:00 and 5:30 in New York; an odd k leaves the plan as it is.
    assert sorted((r.trip_key, r.stop_id, r.seconds) for r in found.collect()) == sorted(
        (f"00000{u}_V..N", f"00{1 + i}N", t + 40 * i) for u, t in ((2, 5 * 3600 + 1800), (4, 5 * 3600)) for i in range(3)
    )


def test_landing_makes_nothing_of_repeated_messages(spark, schedule, tmp_path):
    """messages were made of all rows of a batch, with all that is in them, and kept."""
    m = messages(spark, *[("f", T0 + 30 * min(i, 3), [update([(f"{300 + i}N", T0 + 30 * i, None)])]) for i in range(20)])
    m.coalesce(1).write.parquet(str(tmp_path / "in"))

    def read(df):
        # Making the entities of a repeated message divides by zero.
        return df.withColumn("entities", F.when(F.lit(1) / F.when(F.col("offset") < 4, 1).otherwise(0) > 0, F.col("entities")))

    store = microbatch.BatchStore(spark, str(tmp_path / "store"))
    stream = feeds.file_stream(spark, str(tmp_path / "in"))
    keyed.start_landing(stream, store, lambda: schedule, str(tmp_path / "cp"), every=None, read=read).awaitTermination()
    facts = spark.read.schema(keyed.FACTS).parquet(f"{store.path}/facts/batch_id=*")
    assert sorted(r.offset for r in facts.collect()) == [0, 1, 2, 3]
    assert [(r.messages, r.skipped) for r in store.batch_log().collect()] == [(20, 16)]


def test_a_landed_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    """five files of a batch were five tasks, however long."""
    import pyarrow.parquet as pq

    from tidemark.workload import feeds as workload

    start = dt.datetime(2024, 1, 1)
    folder = event_table(spark, tmp_path / "t", [(i, start + dt.timedelta(seconds=i), i % 97, "view", i * 0.37, i % 100) for i in range(12_000)])
    monkeypatch.setattr(workload, "ROW_GROUP", 4096)
    monkeypatch.setattr(workload, "FILES", 2)
    names = workload.landed_files(spark, folder, str(tmp_path / "landed"))
    files = [f for n in names for f in (tmp_path / "landed" / "aside" / n).glob("*.parquet")]
    assert len(files) == 2 and all(pq.ParquetFile(f).num_row_groups > 1 for f in files)
