"""Named queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(tables)`` under ``name``; ``tables`` gives access to the inputs."""

    def register(f):
        from corpusloom.plans.tables import Tables

        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return f

    return register
