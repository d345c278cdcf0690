"""Decoding against a plain model, inlined and joined."""

import pytest
from hypothesis import given, settings, strategies as st

from tagtable.functions import decode
from tagtable.operators.joins import lookup_default
from tagtable.session import work_folder
from tagtable.sources import dictionary
from tagtable.sources.dictionary import CodeBook

SEP = "\u0002"
NAMES = {"A": "nameA", "B": "nameB", "C": "it's \\ C", "E": "", "T": "tail "}


def model(codes, on_unknown):
    """What a code list decodes to, step by step."""
    if codes is None:
        return ""
    pieces = codes.split(SEP)
    while len(pieces) > 1 and pieces[-1] == "":
        pieces.pop()
    if codes and pieces == [""]:
        pieces = []
    names, cut = [], False
    for piece in pieces:
        if piece not in NAMES:
            if on_unknown == "truncate":
                cut = True
                break
            continue
        if NAMES[piece]:
            names.append(NAMES[piece])
    text = ",".join(names)
    return text + "," if cut and text else text


CASES = [None, "", "A", "?", SEP, SEP * 3, f"A{SEP}B", f"A{SEP}?{SEP}B", f"?{SEP}A", f"A{SEP}?", f"{SEP}A"]
CASES += [f"A{SEP}", f"A{SEP}{SEP}B", f"E{SEP}A", "E", f"E{SEP}?", f"A{SEP}E{SEP}T{SEP}C", f"A{SEP}B{SEP}{SEP}"]


@pytest.fixture
def book(frame):
    return CodeBook(frame("code,name", list(NAMES.items())))


@pytest.mark.parametrize("on_unknown", ["truncate", "skip"])
@pytest.mark.parametrize("joined", [False, True])
def test_code_lists(frame, book, monkeypatch, on_unknown, joined):
    if joined:
        monkeypatch.setattr(decode, "INLINE_CODES", 2)
    codes = frame("id string, codes string", [(str(i), c) for i, c in enumerate(CASES)] * 2)
    got = decode.with_code_list_names(codes, "codes", book, "names", on_unknown)
    assert got.columns == ["id", "codes", "names"]
    result = {r["id"]: r["names"] for r in got.collect()}
    assert result == {str(i): model(c, on_unknown) for i, c in enumerate(CASES)}
    assert got.count() == 2 * len(CASES)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ABCET?" + SEP, max_size=8), min_size=20, max_size=60))
def test_code_lists_property(spark, lists):
    codes = spark.createDataFrame([(c,) for c in lists], "codes string")
    for on_unknown in ("truncate", "skip"):
        got = codes.select("codes", decode.decode_codes("codes", NAMES, on_unknown).alias("n")).collect()
        assert [r["n"] for r in got] == [model(r["codes"], on_unknown) for r in got]


def test_empty_code_in_the_dictionary(frame):
    named = {"": "blank", "A": "nameA"}
    codes = frame("id string, codes string", [("1", ""), ("2", SEP), ("3", f"{SEP}A"), ("4", None)])
    got = {r["id"]: r["n"] for r in codes.select("id", decode.decode_codes("codes", named).alias("n")).collect()}
    assert got == {"1": "blank", "2": "", "3": "blank,nameA", "4": ""}


def test_unknown_mode_is_refused(frame):
    with pytest.raises(ValueError):
        decode.decode_codes("codes", NAMES, "keep")


@pytest.mark.parametrize("small", [True, False])
def test_lookup_default(frame, rows, book, monkeypatch, small):
    if not small:
        monkeypatch.setattr(dictionary, "BROADCAST_CODES", 2)
    codes = frame("id,code", [("1", "A"), ("2", None), ("3", "?"), ("4", ""), ("5", "T"), ("6", "A")])
    got = lookup_default(codes, "code", book, "name")
    assert book.fits() == small or not small
    assert rows(got, "id", "name") == [
        ("1", "nameA"), ("2", ""), ("3", ""), ("4", ""), ("5", "tail "), ("6", "nameA"),
    ]


def test_sql_functions(spark, frame, book):
    decode.register_decoders(spark, book, book)
    codes = frame("codes,code", [(f"A{SEP}?{SEP}B", "C")])
    got = codes.selectExpr("decode_codes(codes) as a", "decode_code(code) as b", "decode_code(codes) as c").first()
    assert tuple(got) == ("nameA,", "it's \\ C", "")
    decode.register_decoders(spark, book, book, "skip")
    assert codes.selectExpr("decode_codes(codes) as a").first()["a"] == "nameA,nameB"


def test_sql_function_of_a_large_dictionary_is_a_join(spark, frame, rows, book, monkeypatch):
    monkeypatch.setattr(decode, "INLINE_CODES", 2)
    decode.register_decoders(spark, book, book)
    codes = frame("id,code", [("1", "A"), ("2", None), ("3", "?"), ("4", "E"), ("5", "T")])
    got = codes.selectExpr("id", "decode_code(code) as name")
    assert rows(got) == [("1", "nameA"), ("2", ""), ("3", ""), ("4", ""), ("5", "tail ")]
    assert "Join" in got._jdf.queryExecution().executedPlan().toString()


def test_large_dictionary_is_not_inlined(book, monkeypatch):
    with pytest.raises(ValueError):
        book.entries(2)


def test_long_name_counts_as_large(frame):
    book = CodeBook(frame("code,name", [("A", "x" * 1001)]))
    assert not book.fits()


def plain_joins(frame):
    """Joins with the dictionary are by merge or in place; the others may be broadcast."""
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("SortMergeJoin")


def test_large_dictionaries_are_not_broadcast(spark, rows):
    """Files of many short codes are small, and what Spark would take for small enough to broadcast is not."""
    path = work_folder(spark)
    spark.range(12_000).selectExpr("concat('c', id) AS code", "concat('name ', id) AS name").write.parquet(path)
    book = CodeBook(spark.read.parquet(path))
    codes = spark.range(300).selectExpr("id", "concat_ws('\u0002', concat('c', id), concat('c', 2 * id)) AS codes", "concat('c', id) AS code")
    decode.register_decoders(spark, book, book)
    by_join = lookup_default(decode.with_code_list_names(codes, "codes", book, "names"), "code", book, "name").select("id", "names", "name")
    by_sql = codes.selectExpr("id", "decode_codes(codes) AS names", "decode_code(code) AS name")
    assert rows(by_join) == rows(by_sql) and by_join.where("id = 7").first()[1:] == ("name 7,name 14", "name 7")
    for frame in (by_join, by_sql):
        assert plain_joins(frame) >= 2
