"""JDBC sources. Addresses and credentials come from the caller, who also ships the driver jar."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSpec:
    """What to read and, with ``column``, how to split it into parallel reads."""

    table: str
    column: str | None = None
    lower_bound: int = 0
    upper_bound: int = 4
    partitions: int = 4


def subquery(sql: str, alias: str = "tmp") -> str:
    """A query as the table of a read, run by the database."""
    return f"({sql.strip().rstrip(';')}) {alias}"


def read_jdbc(spark: SparkSession, url: str, spec: JdbcSpec, properties: Mapping[str, str]) -> DataFrame:
    if spec.column is None:
        return spark.read.jdbc(url, spec.table, properties=dict(properties))
    return spark.read.jdbc(
        url,
        spec.table,
        column=spec.column,
        lowerBound=spec.lower_bound,
        upperBound=spec.upper_bound,
        numPartitions=spec.partitions,
        properties=dict(properties),
    )


def read_jdbc_slices(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: Mapping[str, str]
) -> DataFrame:
    """One parallel read per predicate, such as those of ``functions.columns.date_slices``."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))
