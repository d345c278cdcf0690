"""File and connector sources."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan parquet; a schema spares inference and keeps folder columns in their declared type."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


POINTERS = "_current"  # a folder with a folder of markers for each version of a snapshot or day of a table
DATE_COLUMN = "DATA_DATE"
_MARKER = re.compile(r"(\d{12})\.(run-[0-9a-f]{32})")


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and what makes paths for it."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    return path_of(path).getFileSystem(spark._jsc.hadoopConfiguration()), path_of


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's entries, none if there is no such folder."""
    files, path_of = file_system(spark, folder)
    if not files.exists(path_of(folder)):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(path_of(folder)))


def markers(spark: SparkSession, folder: str, name: str) -> list[tuple[int, str]]:
    """Numbers and runs of the markers of a version or day, from the oldest to the newest.

    A marker is an empty file whose name says everything: it is there or not, and can't be read half written. A file
    of any other name is refused.
    """
    found = []
    for marker in names_in(spark, f"{folder}/{POINTERS}/{name}"):
        match = _MARKER.fullmatch(marker)
        if not match:
            raise ValueError(f"{folder}/{POINTERS}/{name}/{marker} does not name a run")
        found.append((int(match[1]), match[2]))
    return sorted(found)


def current_runs(spark: SparkSession, folder: str) -> dict[str, str]:
    """The run that each version or day is read by."""
    newest = {}
    for name in names_in(spark, f"{folder}/{POINTERS}"):
        if runs := markers(spark, folder, name):
            newest[name] = runs[-1][1]
    return newest


def read_snapshot(spark: SparkSession, base: str, table: str, version: str | None = None) -> DataFrame:
    """Scan a named snapshot under a base folder, or one dated version of it.

    A table that ``sinks.files.refresh_snapshot`` has written is read by the runs that its newest markers name;
    without a version, the column ``version`` tells them apart. Any other folder is read as it is.
    """
    path = f"{base.rstrip('/')}/{table}"
    if POINTERS not in names_in(spark, path):
        return spark.read.parquet(f"{path}/version={version}" if version else path)
    current = current_runs(spark, path)
    runs = [f"{path}/{name}/{run}" for name, run in current.items() if version is None or name == f"version={version}"]
    if not runs:
        raise FileNotFoundError(f"{path} has no version {version}")
    return spark.read.parquet(*runs) if version else spark.read.option("basePath", path).parquet(*runs)


def read_dated(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan a table of days that ``sinks.files.replace_date`` writes, every day by the run that is current now.

    A day is always read whole, the old run or the new one, also while it is replaced. Days that were written
    without markers are read as they are. A filter on the day prunes folders.
    """
    base = path.rstrip("/")
    current = current_runs(spark, base)
    days = [name for name in names_in(spark, base) if name.startswith(f"{DATE_COLUMN}=")]
    runs = [f"{base}/{day}/{current[day]}" if day in current else f"{base}/{day}" for day in days]
    if not runs:
        raise FileNotFoundError(f"{base} has no days")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("basePath", base).parquet(*runs)


def read_format(
    spark: SparkSession, fmt: str, options: Mapping[str, str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Scan a table through any connector on the class path."""
    frame = spark.read.format(fmt).options(**options).load()
    return frame.select(*columns) if columns else frame
