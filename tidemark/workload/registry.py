"""Registration of queries with the inventory lines they cover and their SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}
MODULE_OF: dict[str, str] = {}

MODULES = ["rules", "marts", "planning", "profiling", "shapes", "feeds", "merges", "ordered", "scalars", "jobs", "learning"]


def query(name: str, covers: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; without ``sql`` only its rows are checked."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        COVERS[name] = covers
        MODULE_OF[name] = fn.__module__.rsplit(".", 1)[-1]
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    for m in MODULES:
        import_module(f"tidemark.workload.{m}")
