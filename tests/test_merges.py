import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import model
from tidemark.operators import compare, dedup, incremental, releases, upsert
from tidemark.sources import digests as index_module
from tidemark.sources import files
from tidemark.sources.digests import DigestIndex
from tidemark.sources.tables import BucketTable, MonthTable, Table, bucketed

KV = "k string, n bigint, s double, m double"


def test_upsert_and_documents(spark, rows):
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert rows(upsert.upsert(stored, spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int"), ["k"])) == [("a", 1), ("b", 9), ("c", 3)]
    docs = spark.createDataFrame([("b", 5), ("b", 7)], "k string, v int")
    assert rows(upsert.document_upsert(stored, docs, ["k"], ["v"])) == [("a", 1), ("b", 7)]


def test_additive_upsert_skips_null_maxima(spark, rows):
    stored = spark.createDataFrame([("a", 1, 2.0, 5.0), ("b", 1, 1.0, None)], KV)
    delta = spark.createDataFrame([("a", 2, 3.0, None), ("b", 1, 1.0, None), ("c", 1, 1.0, 4.0)], KV)
    assert rows(upsert.additive_upsert(stored, delta, ["k"], ["n", "s"], ["m"])) == [("a", 3, 5.0, 5.0), ("b", 2, 2.0, None), ("c", 1, 1.0, 4.0)]


def test_deletes_and_retention(spark, rows):
    df = spark.createDataFrame([("g", i, dt.datetime(2025, 1, i)) for i in range(1, 21)], "g string, i int, ts timestamp_ntz")
    assert upsert.retain_days(df, "ts", 14).count() == 15
    assert rows(upsert.newest_per_group(df, "g", "ts", 2), "i") == [(19,), (20,)]
    assert rows(upsert.delete_missing(df, df.where("i > 18"), ["i"]), "i") == [(19,), (20,)]
    assert rows(upsert.insert_if_absent(df.where("i < 20"), df, "i"), "i") == [(20,)]


def test_table_versions(spark, tmp_path, rows):
    t = Table(spark, str(tmp_path / "t"), "k string, v int", keep=1)
    assert t.read().count() == 0
    for i in range(4):
        t.upsert(spark.createDataFrame([("a", i), (str(i), i)], "k string, v int"), ["k"])
    assert rows(t.read()) == [("0", 0), ("1", 1), ("2", 2), ("3", 3), ("a", 3)]
    assert len(t.versions()) == 2
    # A version without the commit marker does not count.
    (tmp_path / "t" / "version=000000000099").mkdir()
    assert t.read().count() == 5


def test_month_table(spark, tmp_path, rows):
    t = MonthTable(spark, str(tmp_path / "m"), "day")
    assert t.read() is None
    df = spark.createDataFrame([(dt.date(2025, m, d), m * 100 + d) for m in (1, 2) for d in (1, 2)], "day date, v int")
    t.replace_months(df)
    t.replace_months(df.where("month(day) = 2 AND day(day) = 1"))
    assert rows(t.read(), "v") == [(101,), (102,), (201,)]
    t.delete_month(dt.date(2025, 1, 1))
    assert rows(t.read(), "v") == [(201,)]


FP = "day date, rows bigint, ridership double, transfers double, source_updated_at timestamp_ntz"


def fp(day, rows=1, r=1.0, t=1.0, u=1):
    return (day, rows, r, t, dt.datetime(2025, 1, u))


def test_changes_in_every_field(spark, rows):
    d = [dt.date(2025, 1, i) for i in range(1, 6)] + [dt.date(2025, 2, 1), dt.date(2025, 3, 1)]
    old = spark.createDataFrame([fp(d[0]), fp(d[1]), fp(d[2]), fp(d[3]), fp(d[4]), fp(d[5])], FP)
    new = spark.createDataFrame([fp(d[0]), fp(d[1], rows=2), fp(d[2], r=2.0), fp(d[3], t=2.0), fp(d[4], u=2), fp(d[6])], FP)
    changes = incremental.changed_days(new, old)
    assert rows(changes) == sorted([(d[1], "changed"), (d[2], "changed"), (d[3], "changed"), (d[4], "changed"), (d[5], "removed"), (d[6], "new")], key=repr)
    actions = {r.month.month: r.action for r in incremental.months_to_rebuild(changes, new).collect()}
    assert actions == {1: "build", 2: "delete", 3: "build"}
    assert {r.day for r in incremental.days_to_fetch(new, changes).collect()} == {*d[:5], d[6]}
    status = {r.day.day: r.status for r in incremental.day_status(new, old).where("month(day) = 1").collect()}
    assert status == {1: "up to date", 2: "rows or totals differ", 3: "rows or totals differ", 4: "rows or totals differ", 5: "revised on the server"}


def test_dedup(spark, rows):
    ts = [dt.datetime(2025, 1, 1, h) for h in range(4)]
    batch = spark.createDataFrame([(ts[0], 1), (ts[0], 1), (ts[1], 2), (ts[2], 3)], "t timestamp_ntz, v int")
    stored = spark.createDataFrame([(ts[1], 2), (ts[1], 2), (ts[3], 9)], "t timestamp_ntz, v int")
    assert rows(dedup.not_stored(batch, stored, "t"), "v") == [(1,), (3,)]
    assert tuple(dedup.dedup_report(batch, stored, "t").first()) == (4, 1, 1, 2)
    assert tuple(dedup.symmetric_difference(batch, stored).first()) == (3, 2)
    assert dedup.hashed_excess_rows(batch, ["t", "v"]).first().excess_rows == 1
    assert tuple(dedup.key_summary(batch, ["t"]).first()) == (3, 1, 1, 2)
    assert dedup.hashed_excess_rows(batch.distinct(), ["t", "v"]).first().excess_rows == 0


def test_compare_treats_null_as_a_value(spark):
    a = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0)], "k int, v double")
    b = spark.createDataFrame([(1, None), (2, 5.1), (4, 1.0)], "k int, v double")
    assert compare.differing_keys(a, b, ["k"], "v").first().differing == 2
    got = {r.k: (r.origin, r.v_differs) for r in compare.outer_compare(a, b, ["k"], ["v"]).collect()}
    assert got == {1: ("both", False), 2: ("both", True), 3: ("left_only", True), 4: ("right_only", True)}
    near = {r.k: r.different for r in compare.tolerant_compare(a, b, ["k"], {"v": 0.2}).collect()}
    assert near == {1: True, 2: False, 3: True, 4: True}  # a missing value counts as different


def test_late_rows_and_releases(spark):
    r = [dt.datetime(2025, 1, 8), dt.datetime(2025, 1, 15), dt.datetime(2025, 1, 22)]
    data = [(r[0], r[0], dt.datetime(2025, 1, 7))] * 10 + [(r[1], r[1], dt.datetime(2025, 1, 14))] * 9 + [(r[1], r[2], dt.datetime(2025, 1, 7))]
    data += [(r[2], r[2], dt.datetime(2025, 1, 21))] * 10
    df = spark.createDataFrame(data, "c timestamp_ntz, u timestamp_ntz, ts timestamp_ntz")
    late = releases.late_rows(df, "c", "ts")
    assert {x.created_at: (x.rows, x.late_rows) for x in late.collect()} == {r[0]: (10, 0), r[1]: (10, 1), r[2]: (10, 0)}
    s = releases.late_summary(late).first()
    assert (s.releases, s.late_rows, s.releases_over_threshold) == (3, 1, 1)
    rev = releases.revisions(df, "c", "u", "ts").collect()
    assert [(x.updated_at, x.rows, x.span_days) for x in rev] == [(r[2], 1, 0)]
    summary = releases.release_summary(releases.load_batches(df, "c", "ts")).first()
    assert (summary.releases, summary.gap_days_min, summary.gap_days_max, summary.weekdays) == (2, 7.0, 7.0, "Wednesday")


def fact_row(i):
    return (dt.datetime(2025, 1, 1, i), "subway", str(i), "S", "Queens", "omny", "OMNY - Full Fare", 3.0, None, 40.7, -73.9, "POINT (-73.9 40.7)")


def test_csv_schema_and_header(spark, tmp_path, rows):
    df = spark.createDataFrame([fact_row(i) for i in range(3)], model.SOURCE_SCHEMA)
    good = str(tmp_path / "good")
    files.export_csv(df, good, model.ROW_KEY)
    back = files.read_csv(spark, good)
    assert back.schema == model.SOURCE_SCHEMA and rows(back) == rows(df)  # the empty field is NULL
    assert files.read_csv(spark, good, columns=["ridership"]).columns == ["ridership"]
    assert files.read_csv_strict(spark, good).count() == 3
    bad = str(tmp_path / "bad")
    df.withColumnRenamed("borough", "district").write.option("header", True).csv(bad)
    with pytest.raises(files.HeaderError):
        files.read_csv_strict(spark, bad)
    empty = tmp_path / "empty.csv"
    empty.write_text(",".join(model.SOURCE_COLUMNS) + "\n")
    assert files.read_csv(spark, str(empty)).count() == 0


def test_records(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"transit_timestamp":"2025-01-01T05:00:00.000","ridership":"7","transfers":"x","latitude":"40.7","longitude":"-73.9","georeference":{"type":"Point","coordinates":[-73.9,40.7]}}\n'
    )
    r = files.read_records(spark, str(tmp_path / "r.json")).first()
    assert (r.transit_timestamp, r.ridership, r.transfers, r.georeference, r.borough) == (dt.datetime(2025, 1, 1, 5), 7.0, None, "POINT (-73.9 40.7)", None)


def test_month_files_replace_only_their_months(spark, tmp_path):
    path = str(tmp_path / "months")
    rows = [(dt.datetime(2025, m, 1, 5), *fact_row(1)[1:]) for m in (1, 2)]
    files.write_months(spark.createDataFrame(rows, model.SOURCE_SCHEMA), path)
    files.write_months(spark.createDataFrame(rows[1:] * 2, model.SOURCE_SCHEMA), path)
    got = {r.month: r["count"] for r in spark.read.parquet(path).groupBy("month").count().collect()}
    assert got == {1: 1, 2: 2}
    assert "month" not in files.read_parquet(spark, path, folders_as_columns=False).columns
    assert files.months_of(spark.read.parquet(path)).count() == 2
    assert spark.read.parquet(path).where(F.col("month") == 2).count() == 2


def bucket_files(path):
    return {str(f.relative_to(path)) for f in (path / "data").glob("*/bucket=*/*.parquet")}


def test_a_merge_rewrites_only_its_buckets(spark, tmp_path, rows):
    t = BucketTable(spark, str(tmp_path), "k string, n bigint, m double", ["k"], buckets=16, keep=1)
    assert t.read().count() == 0
    t.replace(spark.range(200).selectExpr("concat('k', id) k", "id n", "cast(id as double) m"))
    before, manifest = bucket_files(tmp_path), t.manifest()
    assert len(manifest) == 16 and t.read().count() == 200
    t.upsert(spark.createDataFrame([("k7", 700, 1.0), ("new", 1, None)], t.schema))
    after = t.manifest()
    touched = {k for k in after if after[k] != manifest[k]}
    assert 1 <= len(touched) <= 2
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert kept < bucket_files(tmp_path) and len(kept) == 16 - len(touched)
    assert t.read().count() == 201 and t.read().where("k = 'k7'").first().n == 700
    # What no manifest names is gone.
    assert len(bucket_files(tmp_path)) == 16

    t.add(spark.createDataFrame([("k7", 5, None), ("k8", 1, 99.0), ("x", 2, 3.0)], t.schema), ["n"], ["m"])
    assert rows(t.read().where("k IN ('k7', 'k8', 'x')")) == [("k7", 705, 1.0), ("k8", 9, 99.0), ("x", 2, 3.0)]
    t.delete(spark.createDataFrame([("k7",), ("x",), ("absent",)], "k string"))
    assert t.read().count() == 200 and t.read().where("k IN ('k7', 'x')").count() == 0
    assert rows(t.lookup(spark.createDataFrame([("k8",), ("k8",), ("k7",)], "k string"))) == [("k8", 9, 99.0)]


def test_a_merge_without_its_manifest_is_not_seen(spark, tmp_path, rows, monkeypatch):
    t = BucketTable(spark, str(tmp_path), "k string, n bigint", ["k"], buckets=4)
    t.replace(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], t.schema))
    monkeypatch.setattr(t, "MANIFEST", "no schema at all")
    with pytest.raises(Exception):
        t._merge(spark.createDataFrame([("a", 9)], t.schema), lambda stored, new: new)
    monkeypatch.undo()
    assert rows(t.read()) == [("a", 1), ("b", 2), (None, 3)]
    t.upsert(spark.createDataFrame([("a", 9)], t.schema))
    assert rows(t.read()) == [("a", 9), ("b", 2), (None, 3)]


def test_digest_index_reads_only_months_with_hits(spark, tmp_path, rows):
    ts = lambda month, day: dt.datetime(2025, month, day)
    kinds = "ts timestamp_ntz, v int"
    stored = spark.createDataFrame([(ts(m, d), d % 3) for m in range(1, 7) for d in range(1, 11)] + [(ts(2, 1), 1)] * 3, kinds)
    history = MonthTable(spark, str(tmp_path / "rows"), "ts")
    history.replace_months(stored)
    index = DigestIndex(spark, str(tmp_path / "digests"), "ts", ["ts", "v"])
    index.replace_months(stored)
    asked = []

    def read(months):
        asked.append([m.month for m in months])
        return history.read_months(months)

    batch = spark.createDataFrame([(ts(2, 1), 1), (ts(2, 1), 1), (ts(5, 5), 2), (ts(5, 5), 0), (ts(9, 9), 9), (ts(9, 9), 9), (None, None)], kinds)
    for listed in (1000, 0):
        index_module.LISTED = listed
        got = index.not_stored(batch, read)
        want = batch.dropDuplicates().exceptAll(stored)
        assert rows(got) == rows(want) and got.count() == 3
    index_module.LISTED = 1000
    assert asked == [[2, 5], [2, 5]]
    assert rows(index.not_stored(batch.where("v = 9"), read)) == [(ts(9, 9), 9)] and len(asked) == 2
    assert index.not_stored(batch.limit(0), read).count() == 0
    index.delete_month(dt.date(2025, 5, 1))
    assert index.not_stored(batch.where("v = 2"), read).count() == 1


def test_digest_collisions_change_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(DigestIndex, "digest", lambda self: F.lit(7).cast("bigint"))
    stored = spark.createDataFrame([(dt.datetime(2025, 1, 1), 1)], "ts timestamp_ntz, v int")
    index = DigestIndex(spark, str(tmp_path / "digests"), "ts", ["ts", "v"])
    index.replace_months(stored)
    batch = spark.createDataFrame([(dt.datetime(2025, 1, 1), 1), (dt.datetime(2025, 1, 1), 2)], "ts timestamp_ntz, v int")
    assert [r.v for r in index.not_stored(batch, lambda months: stored).collect()] == [2]


def test_variant_records_of_any_shape(spark, tmp_path):
    lines = [
        '{"transit_timestamp":"2025-01-01T05:00:00.000","ridership":"12.5","transfers":3,"georeference":{"type":"Point","coordinates":[-73.9,40.7]}}',
        '{"ridership":7,"georeference":"POINT (-73.9 40.7)","extra":[1,2]}',
        '{"ridership":"many","georeference":null}', '{"ridership":', "[1, 2]", "17",
    ]
    (tmp_path / "records.json").write_text("\n".join(lines))
    got = files.typed_variants(files.read_variant_records(spark, str(tmp_path / "records.json"))).collect()
    assert [(r.ridership, r.transfers, r.georeference, r.bad) for r in got] == [
        (12.5, 3.0, "POINT (-73.9 40.7)", False), (7.0, None, "POINT (-73.9 40.7)", False), (None, None, None, False),
        (None, None, None, True), (None, None, None, True), (None, None, None, True),
    ]
    assert got[0].transit_timestamp == dt.datetime(2025, 1, 1, 5) and got[1].transit_timestamp is None


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    a = bucketed(spark.range(1000).selectExpr("id % 50 AS k", "id AS v"), "tidemark_test_a", f"{tmp_path}/a", ["k"], 4)
    b = bucketed(spark.range(50).selectExpr("id AS k", "id * 2 AS w"), "tidemark_test_b", f"{tmp_path}/b", ["k"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE tidemark_test_a")
        spark.sql("DROP TABLE tidemark_test_b")
