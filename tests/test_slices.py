"""Many codes of large dictionaries are named in slices, which hold less disk than one plan."""

import pathlib

import pytest
from test_decode import CASES, NAMES, model

from tagtable.functions import decode
from tagtable.sources import dictionary
from tagtable.sources.dictionary import CodeBook


@pytest.fixture
def sliced(monkeypatch):
    monkeypatch.setattr(decode, "INLINE_CODES", 2)
    monkeypatch.setattr(dictionary, "BROADCAST_CODES", 2)
    monkeypatch.setattr(decode, "SLICE_CODES", 9)
    monkeypatch.setattr(decode, "SLICES", 2)


def book_of(frame):
    return CodeBook(frame("code,name", list(NAMES.items())))


@pytest.mark.parametrize("on_unknown", ["truncate", "skip"])
def test_slices_give_the_same_names(frame, rows, sliced, on_unknown):
    data = [(i, c, ["A", "?", None][i % 3], {"m": i}) for i, c in enumerate(CASES * 2)]
    codes = frame("`i d` int, slice string, `c.1` string, c0 map<string,int>", data)
    got = decode.with_names(codes, [("slice", book_of(frame), True, "made"), ("c.1", book_of(frame), False, "C0_")], on_unknown)
    assert got.columns == ["i d", "slice", "c.1", "c0", "made", "C0_"]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    wanted = sorted((i, model(c, on_unknown), NAMES.get(code, ""), m) for i, c, code, m in data)
    assert sorted((r[0], r[4], r[5], r[3]) for r in got.collect()) == wanted


def test_slices_of_one_list_and_of_a_replaced_column(spark, frame, sliced):
    codes = spark.range(40).selectExpr("id", "'A\u0002?\u0002B' AS names")
    got = decode.with_code_list_names(codes, "names", book_of(frame), "names")
    assert got.columns == ["id", "names"] and {r.names for r in got.collect()} == {"nameA,"} and got.count() == 40


def test_rows_of_done_slices_are_dropped(spark, frame, sliced):
    codes = spark.range(40).selectExpr("id", "concat('A\u0002', id) AS codes")
    got = decode.with_code_list_names(codes, "codes", book_of(frame), "names")
    paths = {pathlib.Path(p.removeprefix("file:")).parent.parent.parent for p in got.inputFiles()}
    assert len(paths) == 1 and not list(paths.pop().glob("rows/slice=*"))


def test_frames_that_can_not_be_written_stay_in_one_plan(spark, frame, sliced):
    codes = spark.range(40).selectExpr("id", "'A' AS codes", "NULL AS nothing")
    got = decode.with_code_list_names(codes, "codes", book_of(frame), "names")
    assert {r.names for r in got.collect()} == {"nameA"} and got.count() == 40


@pytest.mark.parametrize("on_unknown", ["truncate", "skip"])
def test_sql_function_joins_its_groups_once(spark, frame, sliced, on_unknown):
    """The groups of lists are joined to the rows, not to the distinct lists before."""
    decode.register_decoders(spark, book_of(frame), book_of(frame), on_unknown)
    got = frame("id string, codes string", [(str(i), c) for i, c in enumerate(CASES)] * 2).selectExpr("id", "decode_codes(codes) AS n")
    assert sorted((r.id, r.n) for r in got.collect()) == sorted([(str(i), model(c, on_unknown)) for i, c in enumerate(CASES)] * 2)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
