"""Queries by name with the SQL each is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL if it has one."""

    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return queries()["story_figures"](spark, folder)


def _load() -> None:
    from parallax.plans import dealt, extras, graph, measuring, runs, stories, views  # noqa: F401


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
