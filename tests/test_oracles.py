"""Every registered query against its SQL twin in DuckDB, and its plan."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.workload import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# The training-data queries have tests of their own.
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES
# Queries that run a job of their own while they are built.
EAGER = {n for n in QUERIES if n.startswith(("stream_", "parts_"))} | {"replay_parity", "gated_rule_counts", "refetched_months", "except_all_history"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = table(df.collect(), df.columns)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == table(cursor.fetchall(), columns)


# Each takes minutes with the operators' defaults; ``test_learn`` runs their operators on less.
FITTED = {"model_registry", "permutation_importance", "peak_classifier", "next_day_forecast", "trees_log_metrics", "poisson_trees_metrics", "cluster_search"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - FITTED))
def test_query_without_twin_returns_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(set(ORACLES) - EAGER))
def test_plan_has_no_pair_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan, operator


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["month_replace_plan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    plan = QUERIES["key_compatibility"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in plan


def test_entry(spark):
    assert entry.entry(spark).columns == ["day", "station_complex_id", "ridership", "transfers", "omny_ridership"]


def test_every_query_names_the_lines_it_covers():
    assert set(registry.COVERS) == set(QUERIES) and all(registry.COVERS.values())
