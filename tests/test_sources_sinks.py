"""Dictionary rules, JDBC read plans, and file sinks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tagtable.functions import columns as C
from tagtable.session import size_shuffles, work_folder
from tagtable.sinks import files as sinks
from tagtable.sinks.jdbc import append_jdbc
from tagtable.sources import files, jdbc
from tagtable.sources.dictionary import read_dictionary


def lines(tmp_path, text):
    path = tmp_path / "dictionary.txt"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_dictionary_rules(spark, tmp_path, rows):
    path = lines(tmp_path, "1,first\n2,kept blank \n3,name,extra,more\n1,second\n 4,x\n5,, \n1,last\n")
    assert rows(read_dictionary(spark, path)) == [
        (" 4", "x"), ("1", "last"), ("2", "kept blank "), ("3", "name"), ("5", ""),
    ]
    assert ("2", "kept blank") in rows(read_dictionary(spark, path, trim=True))


@pytest.mark.parametrize("line", ["no comma", "A,", ""])
def test_dictionary_line_without_name_fails(spark, tmp_path, line):
    path = lines(tmp_path, f"1,one\n{line}\n2,two\n")
    with pytest.raises(Exception, match="dictionary line without a name"):
        read_dictionary(spark, path).collect()


def test_dictionary_last_line_wins_across_splits(spark, tmp_path, rows):
    path = lines(tmp_path, "".join(f"{i % 50},name{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = dict(rows(read_dictionary(spark, path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(i % 50): f"name{i}" for i in range(5000)}


class Recorder:
    """Takes the place of a session or writer and keeps the arguments of its JDBC call."""

    def __init__(self):
        self.calls = []
        self.read = self.write = self

    def mode(self, mode):
        self.calls.append(mode)
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self


def test_jdbc_reads():
    session = Recorder()
    jdbc.read_jdbc(session, "jdbc:x", jdbc.JdbcSpec("dim"), {"user": "u"})
    query = jdbc.subquery("select a, b % 4 as part from t;", "tmp")
    jdbc.read_jdbc(session, "jdbc:x", jdbc.JdbcSpec(query, "part"), {})
    jdbc.read_jdbc_slices(session, "jdbc:x", "t", C.date_slices("d", [("2024-01-01", "2024-01-15")]), {})
    split = {"column": "part", "lowerBound": 0, "upperBound": 4, "numPartitions": 4, "properties": {}}
    first = "cast(d as date) >= date '2024-01-01' AND cast(d as date) <= date '2024-01-15'"
    slices = [first, f"cast(d as date) IS NULL OR NOT (({first}))"]
    assert session.calls == [
        ("jdbc:x", "dim", {"properties": {"user": "u"}}),
        ("jdbc:x", "(select a, b % 4 as part from t) tmp", split),
        ("jdbc:x", "t", {"predicates": slices, "properties": {}}),
    ]


def test_jdbc_append():
    writer = Recorder()
    append_jdbc(writer, "jdbc:x", "tags", {"driver": "d"})
    assert writer.calls == ["append", ("jdbc:x", "tags", {"properties": {"driver": "d"}})]


def test_write_new_fails_on_existing_path(spark):
    path = work_folder(spark)
    sinks.write_new(spark.range(3), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_new(spark.range(3), path)


def test_compact_write_is_one_file_when_small(spark, tmp_path):
    path = tmp_path / "compact"
    sinks.write_compact(spark.range(0, 5000, 1, 16), str(path))
    assert len(list(path.glob("*.parquet"))) == 1
    assert spark.read.parquet(str(path)).count() == 5000


def test_compact_write_splits_a_large_result(spark, tmp_path):
    path = tmp_path / "compact"
    sinks.write_compact(spark.range(0, 50000, 1, 16), str(path), file_rows=10_000)
    assert len(list(path.glob("*.parquet"))) == 5
    assert spark.read.parquet(str(path)).count() == 50000


def test_rerun_of_a_day_equals_one_run(spark, rows):
    path = work_folder(spark)
    schema = StructType([StructField(c, StringType()) for c in ("id", sinks.DATE_COLUMN)])
    first = spark.createDataFrame([("a",), ("b",)], "id string")
    for day, frame in (("2024-01-01", first), ("2024-01-02", first), ("2024-01-01", first)):
        sinks.replace_date(frame.withColumn(sinks.DATE_COLUMN, F.lit(day)), path, day)
    assert len(rows(files.read_parquet(spark, path, schema))) == 4
    sinks.replace_date(first.limit(0), path, "2024-01-01")
    assert rows(files.read_parquet(spark, path, schema)) == [("a", "2024-01-02"), ("b", "2024-01-02")]


def test_snapshot_versions(spark):
    base = work_folder(spark)
    sinks.refresh_snapshot(spark.range(5), base, "dim", "2024-01-01")
    sinks.refresh_snapshot(spark.range(7), base, "dim", "2024-01-02")
    again = sinks.refresh_snapshot(spark.range(6), base, "dim", "2024-01-01")
    assert again.count() == 6
    assert files.read_snapshot(spark, base, "dim", "2024-01-02").count() == 7
    own = sinks.refresh_snapshot(again.where("id < 4"), base, "dim", "2024-01-01")
    assert own.count() == 4
    assert files.read_snapshot(spark, base, "dim").groupBy("version").count().count() == 2


def test_work_folder_is_in_the_shared_folder(spark):
    assert work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_folder(spark) != work_folder(spark)


def test_shuffles_are_sized_upwards_only(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 1000 << 20, 100 << 20) == 10
        assert size_shuffles(spark, 1) == 10
        assert spark.conf.get("spark.sql.shuffle.partitions") == "10"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scalar_functions(frame):
    values = frame("id,time,flag", [("1", "2024-03-01 23:59:59", "1"), ("2", "not a date", "0"), ("3", None, None)])
    got = values.select(
        "id",
        C.safe_date(F.col("time")).alias("day"),
        C.previous_day(C.safe_date(F.col("time"))).alias("before"),
        C.yes_no_label(F.col("flag").cast("int"), "y", "n").alias("label"),
        C.contains_flag(F.col("time"), "date").alias("has"),
    ).orderBy("id")
    assert [tuple(r)[1:] for r in got.collect()] == [
        (dt.date(2024, 3, 1), dt.date(2024, 2, 29), "y", 0),
        (None, None, "n", 1),
        (None, None, None, 0),
    ]


def test_java_hash(frame):
    ids = ["", "a", "abc", "customer-0001", "polygenelubricants", "zzzzzzzzzzzz"]
    def model(text):
        h = 0
        for char in text:
            h = (h * 31 + ord(char)) % (1 << 32)
        return abs(h - (1 << 32) if h >= 1 << 31 else h) % 9
    got = frame("id,x", [(i, "") for i in ids]).select("id", C.java_hash_bucket(F.col("id"), 9).alias("b")).collect()
    assert {r["id"]: r["b"] for r in got} == {i: model(i) for i in ids}
