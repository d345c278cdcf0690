"""What must not change with size: types of columns, numbers of keys and codes, failing runs."""

import pytest
from pyspark.sql import functions as F

from tagtable.functions import columns as C, decode
from tagtable.operators import copies, skew
from tagtable.operators.joins import enrich, lookup_default
from tagtable.operators.perkey import limit_by
from tagtable.plans.extract import customer_extract
from tagtable.plans.relation import matched_source
from tagtable.session import work_folder
from tagtable.sinks import files as sinks
from tagtable.sources import files
from tagtable.sources.dictionary import CodeBook


def test_frames_with_maps_can_be_split(spark):
    kinds = ["map('a', id) as m", "array(map(1, id)) as am", "named_struct('x', map(1, 2)) as sm", "array(id) as a", "named_struct('y', id) as s"]
    left = spark.range(300).selectExpr("'hot' as key", "id", *kinds)
    right = spark.createDataFrame([("hot", "x")], "key string, b string")
    plain, split = enrich(left, [right], "key"), enrich(left, [right], "key", {"hot": 7})
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert limit_by(left, ["key"], [F.col("id")], 3).count() == 3
    assert limit_by(left.crossJoin(spark.range(8).select("id")).toDF(*left.columns, "n"), ["key"], [F.col("id"), F.col("n")], 1001).count() == 1001
    maps_only = left.select("key", "m")
    assert skew.join_chain(maps_only, [right], "key", "inner", {"hot": 3}).count() == 300


def test_all_hot_keys_are_found(spark):
    rows = spark.range(400 * 12).selectExpr("concat('k', id % 400) as key", "id as a")
    found = skew.hot_keys({"rows": (rows, "key")}, rows_per_task=10)["rows"]
    assert found == {f"k{i}": 2 for i in range(400)}


def test_helper_names_give_way(spark):
    left = spark.range(50).selectExpr("'hot' as key", "id as _left_split", "id as _LEFT_SPLIT_")
    right = spark.createDataFrame([("hot", 1, 2)], "key string, _right_split int, _matched int")
    joined = skew.join_chain(left, [right], "key", "left", {"hot": 4}, [{"hot": 1}])
    assert joined.columns == ["key", "_left_split", "_LEFT_SPLIT_", "_right_split", "_matched"]
    assert joined.where("_matched = 2").count() == 50


@pytest.mark.parametrize("codes", [40, 1_001, 10_001, 50_000])
def test_dictionaries_of_any_size(spark, codes):
    book = CodeBook(spark.range(codes).selectExpr("concat('c', id) as code", "concat('name ', id) as name"))
    last, sep = codes - 1, "\u0002"
    lists = [f"c0{sep}c{last}", f"c1{sep}zz{sep}c2", f"zz{sep}c1", "", None]
    frame = spark.createDataFrame([(i, c, f"c{last}") for i, c in enumerate(lists)], "i int, list string, code string")
    for mode, wanted in (("truncate", [f"name 0,name {last}", "name 1,", "", "", ""]), ("skip", [f"name 0,name {last}", "name 1,name 2", "name 1", "", ""])):
        got = decode.with_code_list_names(frame, "list", book, "names", mode)
        assert [r.names for r in got.orderBy("i").collect()] == wanted
        decode.register_decoders(spark, book, book, mode)
        got = frame.selectExpr("i", "decode_codes(list) as names", "decode_code(code) as one").orderBy("i").collect()
        assert [r.names for r in got] == wanted
        assert {r.one for r in got} == {f"name {last}"}
    assert {r.name for r in lookup_default(frame, "code", book, "name").collect()} == {f"name {last}"}


def test_a_repeated_code_means_the_same_by_every_path(spark):
    twice = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "code string, name string")
    many = twice.unionByName(spark.range(10_001).selectExpr("concat('c', id) as code", "'n' as name"))
    for book in (CodeBook(twice), CodeBook(many)):
        rows = spark.createDataFrame([("a",), ("b",)], "code string")
        assert sorted((r.code, r.name) for r in lookup_default(rows, "code", book, "name").collect()) == [("a", "y"), ("b", "")]


def test_a_day_can_be_rewritten_from_its_own_table(spark):
    path = work_folder(spark)
    sinks.replace_date(spark.range(10), path, "2024-01-01")
    sinks.replace_date(spark.range(3), path, "2024-01-02")
    day = spark.read.parquet(path).where(F.col(sinks.DATE_COLUMN) == "2024-01-01")
    sinks.replace_date(day.where("id < 4").select("id", F.col(sinks.DATE_COLUMN).cast("string")), path, "2024-01-01")
    assert spark.read.parquet(path).count() == 7


def test_a_failing_rerun_keeps_the_day(spark):
    path = work_folder(spark)
    sinks.replace_date(spark.range(10), path, "2024-01-01")
    with pytest.raises(Exception, match="broken"):
        sinks.replace_date(spark.range(5).withColumn("id", F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long"))), path, "2024-01-01")
    assert spark.read.parquet(path).count() == 10
    fs, p = files.file_system(spark, path)
    assert [s.getPath().getName() for s in fs.listStatus(p(path)) if s.getPath().getName().startswith("_staging")] == []


def test_rows_of_another_day_are_refused(spark):
    path = work_folder(spark)
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-05")], f"id int, {sinks.DATE_COLUMN} string")
    with pytest.raises(Exception, match="2024-01-05"):
        sinks.replace_date(rows, path, "2024-01-01")


def test_a_failing_snapshot_leaves_the_version(spark):
    base = work_folder(spark)
    sinks.refresh_snapshot(spark.range(5), base, "t", "v1")
    bad = spark.range(5).withColumn("id", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        sinks.refresh_snapshot(bad, base, "t", "v1")
    assert files.read_snapshot(spark, base, "t", "v1").count() == 5
    fs, p = files.file_system(spark, base)
    assert len(fs.listStatus(p(f"{base}/t/version=v1"))) == 1


def test_slices_give_every_row_once(spark):
    days = ["2024-01-01", "1899-05-05", None, "2024-02-10", "2024-03-01"]
    rows = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.col("d").cast("date"))
    slices = C.date_slices("d", [("2024-01-01", "2024-01-31"), ("2024-02-05", "2024-02-28")])
    assert [rows.where(s).count() for s in slices] == [1, 1, 3]
    assert len(C.date_slices("d", [("2024-01-01", "2024-01-31")], remainder=False)) == 1


def test_copies_of_one_row_come_from_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(copies, "COPIES_PER_CHUNK", 10)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these partitions are tiny
    dim = spark.range(0, 1000, 1, 2).selectExpr("'c' as cust_id")
    relation = spark.createDataFrame([("c", "e", "t", "n")], "custId string, entId string, createTime string, custName string")
    made = matched_source(dim, relation).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in made) == 1000 and len(made) > 4
    master = spark.createDataFrame([("c", "n", "d")], "custId string, custNameCn string, createDate string")
    got = customer_extract(dim.toDF("custId"), master, relation).groupBy(F.spark_partition_id()).count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in got) == 1000 and len(got) > 4
