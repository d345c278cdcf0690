"""Large dictionaries: one join for all columns, and columns of any name."""

import re

import pytest
from pyspark.sql import functions as F

from tagtable.functions import decode
from tagtable.operators.joins import lookup_default
from tagtable.operators.tags import emit_tags
from tagtable.sources.dictionary import CodeBook
from tagtable.specs import TAGS

SEP = "\u0002"
SIZES = [1, 51, 60, 10_001]


def book_of(spark, size):
    """A dictionary of a size whose first entries have a name, none and an empty one."""
    named = spark.range(size).selectExpr("concat('c', id) AS code", "concat('name ', id) AS name")
    return CodeBook(named.unionByName(spark.createDataFrame([("e", ""), ("n", None)], "code string, name string")))


@pytest.mark.parametrize("size", SIZES)
def test_columns_of_any_name(spark, size):
    """The names that the joins use inside, as names of the list column, of other columns and of the result."""
    book = book_of(spark, size)
    names = ["code", "name", "key", "_codes", "_code", "_name", "_pos", "_found", "_key0", "_other", "_left_split", "value", "place", "piece", "is_list"]
    lists = [f"c0{SEP}e{SEP}c0", f"c0{SEP}zz", "", f"{SEP}{SEP}", None, "c0"]
    wanted = ["name 0,name 0", "name 0,", "", "", "", "name 0"]
    for column in names:
        others = [n for n in names if n != column]
        data = [(i, t, *["x"] * len(others)) for i, t in enumerate(lists)]
        frame = spark.createDataFrame(data, f"i int, `{column}` string, " + ", ".join(f"`{n}` string" for n in others))
        got = decode.with_code_list_names(frame, column, book, "made")
        assert got.columns == [*frame.columns, "made"]
        assert [r.made for r in got.orderBy("i").collect()] == wanted
        single = lookup_default(frame, column, book, "made")
        assert [r.made for r in single.orderBy("i").collect()] == ["", "", "", "", "", "name 0"]
        assert set(single.columns) == {*frame.columns, "made"}
    frame = spark.createDataFrame([(0, "c0", "x")], "i int, codes string, made string")
    for got in (decode.with_code_list_names(frame, "codes", book, "made"), lookup_default(frame, "codes", book, "made")):
        assert [r.made for r in got.collect()] == ["name 0"] and got.columns.count("made") == 1


@pytest.mark.parametrize("mode", ["truncate", "skip"])
def test_several_columns_at_once(spark, mode):
    large, other = book_of(spark, 60), book_of(spark, 70)
    frame = spark.createDataFrame([(0, f"c1{SEP}zz{SEP}c65", "c65", "c65"), (1, None, "zz", None), (2, "c65", "c2", "c2")], "i int, a string, b string, c string")
    got = decode.with_names(frame, [("a", large, True, "an"), ("b", large, False, "bn"), ("c", other, False, "cn")], mode)
    rows = [(r.an, r.bn, r.cn) for r in got.orderBy("i").collect()]
    assert rows == [("name 1," if mode == "truncate" else "name 1", "", "name 65"), ("", "", ""), ("", "name 2", "name 2")]


def wide_of(spark):
    columns = ", ".join(f"`{s.column}` {'int' if s.column in {'t1', 't2', 't3', 't4', 't5', 't6'} else 'string'}" for s in TAGS)
    codes = {"cnei_code": f"c0{SEP}c1", "cnei_sec_code": "zz", "province_code": "c0", "city_code": "zz", "county_code": None}
    row = lambda f: tuple(1 if s.column in {"t1", "t2", "t3", "t4", "t5", "t6"} else f(s.column) for s in TAGS)
    data = [("a", *row(lambda c: codes.get(c, "v"))), ("b", *row(lambda c: None)), ("c", *row(lambda c: codes.get(c, "v")))]
    return spark.createDataFrame(data, f"cust_id string, {columns}")


@pytest.mark.parametrize("size", [51, 10_001])
def test_tags_of_dictionaries_of_any_size_are_the_same(spark, rows, size):
    wide = wide_of(spark)
    small = book_of(spark, 2)
    entries = small.entries()
    more = CodeBook(spark.createDataFrame([*entries.items(), *[(f"other{i}", "n") for i in range(size)]], "code string, name string"))
    wanted = rows(emit_tags(wide, "cust_id", "2024-01-01", small, small))
    assert len(wanted) == 3 * len(TAGS)
    for books in ((more, more), (more, small), (small, more)):
        assert rows(emit_tags(wide, "cust_id", "2024-01-01", *books)) == wanted


def test_one_dictionary_join_for_all_tags(spark):
    book = book_of(spark, 10_001)
    tags = emit_tags(wide_of(spark), "cust_id", "2024-01-01", book, book)
    text = tags._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("Join ", text)) == 2  # distinct values with the dictionary, rows with their names


def test_no_value_at_all(spark):
    book = book_of(spark, 60)
    frame = spark.createDataFrame([(0, None)], "i int, codes string")
    assert [r.made for r in decode.with_code_list_names(frame, "codes", book, "made").collect()] == [""]
    assert decode.with_code_list_names(frame.limit(0), "codes", book, "made").count() == 0
    assert frame.select(F.col("i")).count() == 1
