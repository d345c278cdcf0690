"""Days and snapshots while they are replaced: readers see one whole run."""

import threading

import pytest
from pyspark.sql import functions as F

from tagtable.session import work_folder
from tagtable.sinks import files as sinks
from tagtable.sources import files

DAY = "2024-01-01"


def run_of(spark, n, rows=400):
    """A run's rows, all of which carry its number, in several files."""
    return spark.range(0, rows, 1, 4).select("id", F.lit(n).alias("n"))


def test_a_reader_in_a_loop_sees_whole_days(spark):
    path = work_folder(spark)
    sinks.replace_date(run_of(spark, 0), path, DAY, keep=1)
    sinks.replace_date(run_of(spark, 99), path, "2024-01-02", keep=1)
    seen, wrong, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                day = files.read_dated(spark, path).where(F.col(sinks.DATE_COLUMN) == DAY)
                found = [tuple(r) for r in day.groupBy("n").count().collect()]
                if len(found) != 1 or found[0][1] != 400:
                    wrong.append(found)
                seen.update(n for n, _ in found)
            except Exception as error:  # noqa: BLE001 - kept for the assertion
                wrong.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 7):
        sinks.replace_date(run_of(spark, n), path, DAY, keep=1)
    stop.set()
    reader.join()
    assert wrong == [] and len(seen) > 1
    assert {r["n"]: r["count"] for r in files.read_dated(spark, path).groupBy("n").count().collect()} == {6: 400, 99: 400}


@pytest.mark.parametrize("keep", [0, 1, 2])
def test_runs_before_the_current_one_stay_as_asked(spark, keep):
    path = work_folder(spark)
    begun = []
    for n in range(5):
        sinks.replace_date(run_of(spark, n), path, DAY, keep=keep)
        begun.append(files.read_dated(spark, path))
    for n in range(4, 3 - keep, -1):
        assert {r.n for r in begun[n].collect()} == {n}
    assert len(files.names_in(spark, f"{path}/{sinks.DATE_COLUMN}={DAY}")) == keep + 1
    assert len(files.markers(spark, path, f"{sinks.DATE_COLUMN}={DAY}")) == keep + 1


def test_between_runs_a_plain_scan_finds_the_same_rows(spark, rows):
    path = work_folder(spark)
    run_of(spark, 7, 5).write.parquet(f"{path}/{sinks.DATE_COLUMN}=2023-12-31")  # a day from before markers
    for n in range(3):
        sinks.replace_date(run_of(spark, n, 9), path, DAY)
    assert rows(spark.read.parquet(path)) == rows(files.read_dated(spark, path))
    sinks.replace_date(run_of(spark, 8, 6), path, "2023-12-31")
    assert rows(spark.read.parquet(path)) == rows(files.read_dated(spark, path)) and spark.read.parquet(path).count() == 15


def test_several_days_are_replaced_each_as_a_whole(spark):
    path = work_folder(spark)
    days = lambda n, *names: run_of(spark, n, 30).select("*", F.element_at(F.array(*map(F.lit, names)), (F.col("id") % len(names) + 1).cast("int")).alias(sinks.DATE_COLUMN))
    sinks.replace_dates(days(0, "2024-01-01", "2024-01-02", "2024-01-03"), path, keep=1)
    before = files.read_dated(spark, path)
    sinks.replace_dates(days(1, "2024-01-02", "2024-01-03"), path, keep=1)
    count = lambda frame: {(str(r[0]), r[1]): r[2] for r in frame.groupBy(sinks.DATE_COLUMN, "n").count().collect()}
    assert count(files.read_dated(spark, path)) == {("2024-01-01", 0): 10, ("2024-01-02", 1): 15, ("2024-01-03", 1): 15}
    assert count(before) == {(f"2024-01-0{i}", 0): 10 for i in (1, 2, 3)}
    broken = days(2, "2024-01-01").withColumn("n", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_dates(broken, path)
    assert count(files.read_dated(spark, path))["2024-01-01", 0] == 10
    assert not [name for name in files.names_in(spark, path) if name.startswith("_staging")]


def test_a_file_that_does_not_name_a_run_is_refused(spark):
    base = work_folder(spark)
    sinks.refresh_snapshot(spark.range(5), base, "t", "v1")
    fs, path_of = files.file_system(spark, base)
    folder = f"{base}/t/{files.POINTERS}/version=v1"
    (marker,) = files.names_in(spark, folder)
    for bad in ("", ".run-", ".run-12", marker[12:-1], "x"):
        torn = path_of(f"{folder}/{int(marker[:12]) + 1:012d}{bad}")
        fs.create(torn, False).close()
        with pytest.raises(ValueError, match="does not name a run"):
            files.read_snapshot(spark, base, "t", "v1")
        fs.delete(torn, True)
    assert files.read_snapshot(spark, base, "t", "v1").count() == 5


def test_a_run_that_was_never_marked_is_not_read(spark):
    base = work_folder(spark)
    sinks.refresh_snapshot(spark.range(5), base, "t", "v1")
    spark.range(100).write.parquet(f"{base}/t/version=v1/run-{'0' * 32}")  # its driver was lost
    assert files.read_snapshot(spark, base, "t", "v1").count() == files.read_snapshot(spark, base, "t").count() == 5
    with pytest.raises(FileNotFoundError):
        files.read_snapshot(spark, base, "t", "v2")
    with pytest.raises(FileNotFoundError):
        files.read_dated(spark, work_folder(spark))


def test_a_reader_of_the_run_before_finishes(spark):
    base = work_folder(spark)
    old = sinks.refresh_snapshot(run_of(spark, 1), base, "t", "v1")
    everything = files.read_snapshot(spark, base, "t")
    sinks.refresh_snapshot(run_of(spark, 2), base, "t", "v1")
    assert {r.n for r in old.collect()} == {r.n for r in everything.collect()} == {1}
    assert {r.n for r in files.read_snapshot(spark, base, "t", "v1").collect()} == {2}


def test_days_are_pruned_by_folder(spark):
    path = work_folder(spark)
    for day in ("2024-01-01", "2024-01-02"):
        sinks.replace_date(spark.range(5), path, day, keep=1)
    text = files.read_dated(spark, path).where(F.col(sinks.DATE_COLUMN) == "2024-01-02")
    text = text._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DATA_DATE" in text
