"""File sinks. What a sink replaces stays until all new rows are written."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagtable.operators.skew import place_of
from tagtable.sources.files import DATE_COLUMN, POINTERS, file_system, markers, names_in, read_snapshot


def write_new(frame: DataFrame, path: str) -> None:
    """Write parquet; fail if the path is there already."""
    frame.write.mode("errorifexists").parquet(path)


def write_compact(frame: DataFrame, path: str, file_rows: int = 1_000_000) -> None:
    """Overwrite with files of about ``file_rows`` rows: one file for fewer rows, several for more.

    The number of files follows from a count of the rows alone, not from settings of the session. Rows are dealt
    out by a hash, so that no single task writes a large result.
    """
    files = max(1, -(-frame.count() // file_rows))
    dealt = frame.coalesce(1) if files == 1 else frame.repartition(files, place_of(frame))
    dealt.write.mode("overwrite").parquet(path)


def replace_date(frame: DataFrame, path: str, data_date: str, keep: int = 0) -> None:
    """Put the rows of one day in place of that day's rows, also when there are none.

    Other days stay as they are, so a rerun for a day has the effect of a single run. Executors write the rows to the
    day's folder, in a folder of this run; then a marker makes it the day's current run, by which ``read_dated`` reads.
    Nothing is moved or copied; readers see the old day or the new one, never parts of either, and a run that fails
    leaves the day as it was. The frame may read what it replaces. If it has a date column, a row of another day
    fails the run.

    The ``keep`` runs before the current one stay for readers that have begun with them. With none, all other files of
    the day go at once, so that between runs a plain scan of the table finds the same rows.
    """
    if DATE_COLUMN in frame.columns:
        wrong = F.concat(F.lit(f"a row is not of {data_date} but of "), F.coalesce(F.col(DATE_COLUMN).cast("string"), F.lit("no day")))
        right = F.col(DATE_COLUMN).cast("string").eqNullSafe(F.lit(data_date))
        frame = frame.where(F.when(right, F.lit(True)).otherwise(F.raise_error(wrong).cast("boolean"))).drop(DATE_COLUMN)
    base, day, run = path.rstrip("/"), f"{DATE_COLUMN}={data_date}", _new_run()
    _written_or_gone(frame, f"{base}/{day}/{run}")
    _publish(frame.sparkSession, base, day, run, keep)


def replace_dates(frame: DataFrame, path: str, keep: int = 0) -> None:
    """Put the rows of every day in the frame in place of those days' rows, each day like ``replace_date``.

    All days are written in one job to a hidden folder; then each moves to its place and gets its marker.
    """
    spark, base, run = frame.sparkSession, path.rstrip("/"), _new_run()
    staging = f"{base}/_staging-{uuid.uuid4().hex}"  # plain scans skip names that start with an underscore
    try:
        frame.write.mode("errorifexists").partitionBy(DATE_COLUMN).parquet(staging)
        files, path_of = file_system(spark, base)
        for day in names_in(spark, staging):
            if day.startswith(f"{DATE_COLUMN}="):
                files.mkdirs(path_of(f"{base}/{day}"))
                if not files.rename(path_of(f"{staging}/{day}"), path_of(f"{base}/{day}/{run}")):
                    raise OSError(f"could not move {staging}/{day} to its day")
                _publish(spark, base, day, run, keep)
    finally:
        _remove(spark, staging)


def refresh_snapshot(frame: DataFrame, base: str, table: str, version: str, keep: int = 1) -> DataFrame:
    """Write a dated version of a snapshot and read it back, which also cuts the lineage.

    Executors write the rows once, to a folder of this run; then a marker names the run as the version's. Nothing is
    moved or copied, readers always find a complete version, the frame may read what it replaces, and a run that
    fails leaves nothing. The ``keep`` runs before the current one stay for readers that have begun with them.
    """
    folder, run = f"{base.rstrip('/')}/{table}", _new_run()
    _written_or_gone(frame, f"{folder}/version={version}/{run}")
    _publish(frame.sparkSession, folder, f"version={version}", run, keep)
    return read_snapshot(frame.sparkSession, base, table, version)


def _new_run() -> str:
    return f"run-{uuid.uuid4().hex}"


def _written_or_gone(frame: DataFrame, folder: str) -> None:
    """Write a new folder; a write that fails leaves none."""
    try:
        write_new(frame, folder)
    except Exception:
        _remove(frame.sparkSession, folder)
        raise


def _remove(spark: SparkSession, folder: str) -> None:
    files, path_of = file_system(spark, folder)
    files.delete(path_of(folder), True)


def _publish(spark: SparkSession, base: str, name: str, run: str, keep: int) -> None:
    """Make a complete run the current one of a version or day, then drop runs that are out of date.

    A version or day has one writer at a time.
    """
    files, path_of = file_system(spark, base)
    known = markers(spark, base, name)
    number = known[-1][0] + 1 if known else 0
    files.create(path_of(f"{base}/{POINTERS}/{name}/{number:012d}.{run}"), False).close()
    known.append((number, run))
    for old_number, old_run in known[: -1 - keep]:
        _remove(spark, f"{base}/{name}/{old_run}")
        _remove(spark, f"{base}/{POINTERS}/{name}/{old_number:012d}.{old_run}")
    if not keep:
        for entry in names_in(spark, f"{base}/{name}"):
            if entry != run:
                _remove(spark, f"{base}/{name}/{entry}")
    spark.catalog.refreshByPath(base)


def preview(frame: DataFrame, order: Sequence[str], rows: int = 20) -> DataFrame:
    """The first rows in a total order; planned as a per-task top-n, not as a full sort."""
    return frame.orderBy(*order).limit(rows)


def row_count(frame: DataFrame, name: str = "row_count") -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias(name))
