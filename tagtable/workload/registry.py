"""Pairs of a Spark query and, where there is one, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagtable.workload.tables import Tables, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str, *tables: str) -> Callable:
    """Register a function of ``Tables`` under a name, with its SQL over the named logical tables."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        SQL[name] = with_tables(sql, *tables) if tables else sql
        return build

    return register
