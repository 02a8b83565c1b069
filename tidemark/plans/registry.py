"""Named queries and their SQL twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
MODULES: tuple[str, ...] = ("asof_queries", "pit_queries", "state_queries", "state_rest_queries", "market_queries", "join_queries", "window_queries", "text_queries", "quality_queries", "audit_queries", "report_queries", "stream_queries", "recorder_queries", "source_queries", "small_queries")


def query(sql: str | None = None):
    """Registers a function (spark, folder) -> DataFrame under its own name, with its SQL twin if there is one."""

    def add(f):
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(spark, sf_dir)

        call.__name__, call.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = call
        if sql:
            SQL[f.__name__] = sql
        return call

    return add


def _load():
    for m in MODULES:
        importlib.import_module(f"tidemark.plans.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
