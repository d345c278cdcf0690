"""Turning codes into names by a dictionary.

The expressions are SQL text so that one definition serves both DataFrame expressions and SQL functions.
A dictionary is inlined as a map literal only up to ``INLINE_CODES`` entries; beyond that the joins at
the end of this module (or of ``operators.joins``) do the same work.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tagtable.operators.skew import free_name, spread_join
from tagtable.session import drop_folder, shuffles_dropped, work_folder
from tagtable.sources.dictionary import CodeBook
from tagtable.specs import CODE_SEPARATOR

INLINE_CODES = 50  # a map literal is searched from the front for every code
SLICE_CODES = 5_000_000  # codes of a table from which large dictionaries name it in slices
SLICES = 6


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _map_sql(entries: Mapping[str, str]) -> str:
    if not entries:
        return "cast(map() as map<string,string>)"
    return f"map({', '.join(sql_text(t) for pair in entries.items() for t in pair)})"


def _pieces_sql(code: str) -> str:
    """The pieces of a code list: trailing empty ones do not count, leading ones do."""
    separator = sql_text(CODE_SEPARATOR)
    stripped = f"trim(TRAILING {separator} FROM {code})"
    return f"if({code} <> '' AND {stripped} = '', CAST(array() AS array<string>), split({stripped}, {separator}))"


def _check_mode(on_unknown: str) -> None:
    if on_unknown not in ("truncate", "skip"):
        raise ValueError(f"on_unknown must be 'truncate' or 'skip', not {on_unknown!r}")


def decode_code_sql(code: str, entries: Mapping[str, str]) -> str:
    """Name of one code; ``''`` for NULL and unknown codes."""
    return f"coalesce(try_element_at({_map_sql(entries)}, {code}), '')"


def decode_codes_sql(code: str, entries: Mapping[str, str], on_unknown: str = "truncate") -> str:
    """Comma-joined names of a separated code list; ``''`` for NULL.

    ``on_unknown="truncate"`` stops at the first unknown code and keeps a closing comma if any name came
    before it; ``"skip"`` leaves out only the unknown codes. Entries with an empty name add nothing.
    """
    _check_mode(on_unknown)
    name = f"try_element_at({_map_sql(entries)}, c)"
    if on_unknown == "truncate":
        # an unknown code leaves a mark that no name contains, and the joined text is cut there
        used = set("".join(entries.values()))
        mark = sql_text(next(char for char in map(chr, range(1, 0xD800)) if char not in used and char != ","))
        name = f"coalesce({name}, {mark})"
    joined = f"array_join(filter(transform({_pieces_sql(code)}, c -> {name}), n -> n <> ''), ',')"
    if on_unknown == "truncate":
        joined = f"substring_index({joined}, {mark}, 1)"
    return f"coalesce({joined}, '')"


def decode_code(column: str, entries: Mapping[str, str]) -> Column:
    return F.expr(decode_code_sql(f"`{column}`", entries))


def decode_codes(column: str, entries: Mapping[str, str], on_unknown: str = "truncate") -> Column:
    return F.expr(decode_codes_sql(f"`{column}`", entries, on_unknown))


def register_decoders(
    spark: SparkSession, multi: CodeBook, single: CodeBook, on_unknown: str = "truncate"
) -> None:
    """Make ``decode_codes(code)`` and ``decode_code(code)`` usable in SQL text, without Python or Scala UDFs.

    A dictionary too large to inline, of whatever size, is a subquery of the function, which Spark plans as a join;
    a bulk of code lists is decoded with less work by ``with_code_list_names``, once for each distinct list.
    """
    _check_mode(on_unknown)
    if multi.fits(INLINE_CODES):
        names = {"decode_codes": decode_codes_sql("code", multi.entries(INLINE_CODES), on_unknown)}
    else:
        _unsent(multi).createOrReplaceTempView("decode_codes_names")
        names = {"decode_codes": _joined_codes_sql("decode_codes.code", "decode_codes_names", on_unknown)}
    if single.fits(INLINE_CODES):
        names["decode_code"] = decode_code_sql("code", single.entries(INLINE_CODES))
    else:
        _unsent(single).createOrReplaceTempView("decode_code_names")
        names["decode_code"] = (
            "coalesce((SELECT max(n.name) FROM decode_code_names n WHERE n.code = decode_code.code), '')"
        )
    for name, body in names.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(code STRING) RETURNS STRING RETURN {body}")


def _unsent(book: CodeBook) -> DataFrame:
    """The frame of a dictionary; a large one is not broadcast, whatever Spark takes the size of its files for."""
    return book.frame if book.fits() else book.frame.hint("merge")


def _joined_codes_sql(code: str, names: str, on_unknown: str) -> str:
    """Names of a code list by a subquery over a view of the dictionary."""
    return f"""coalesce((
        SELECT {_found_names_sql(on_unknown)}
        FROM (SELECT array_sort(collect_list(if(n.name <> '', named_struct('_pos', p._pos, 'name', n.name), NULL))) AS _found,
                     min(if(n.name IS NULL, p._pos, NULL)) AS _unknown
              FROM (SELECT posexplode({_pieces_sql(code)}) AS (_pos, c)) p LEFT JOIN {names} n ON n.code = p.c
              GROUP BY 'list')), '')"""


def with_code_list_names(
    frame: DataFrame, column: str, book: CodeBook, name: str, on_unknown: str = "truncate"
) -> DataFrame:
    """Add the decoded name list of ``column``, inlining a small dictionary and joining a large one."""
    if book.fits(INLINE_CODES):
        return frame.withColumn(name, decode_codes(column, book.entries(INLINE_CODES), on_unknown))
    return with_names(frame, [(column, book, True, name)], on_unknown)


def with_names(
    frame: DataFrame, coded: Sequence[tuple[str, CodeBook, bool, str]], on_unknown: str = "truncate"
) -> DataFrame:
    """Add names of several coded columns, each given as ``(column, dictionary, whether it is a list, name)``.

    The dictionaries are joined once, however many columns there are. Where a column has a name of the added ones, it
    is replaced. Large dictionaries name many codes in slices of the rows, one after another, whose shuffle files are gone
    when the next begins; the rows with their names are then written and read.
    """
    if not all(book.fits() for _, book, *_ in coded) and not re.search(r"\b(void|interval)\b|struct<>", frame.schema.simpleString()):
        slices = min(SLICES, _codes(frame, coded) // SLICE_CODES + 1)
        if slices > 1:
            return _named_in_slices(frame, coded, on_unknown, slices)
    return _named(frame, coded, on_unknown)


def _codes(frame: DataFrame, coded: Sequence[tuple[str, CodeBook, bool, str]]) -> int:
    """How many codes the coded columns have, those of a list counted by its separators."""
    columns = [(F.col(f"`{column}`").cast("string"), is_list) for column, _, is_list, _ in coded]
    counts = [F.length(c) - F.length(F.translate(c, CODE_SEPARATOR, "")) + 1 if is_list else F.when(c.isNotNull(), 1) for c, is_list in columns]
    return frame.agg(F.sum(sum(F.coalesce(n, F.lit(0)).cast("long") for n in counts))).first()[0] or 0


def _named_in_slices(frame: DataFrame, coded: Sequence[tuple[str, CodeBook, bool, str]], on_unknown: str, slices: int) -> DataFrame:
    """``_named`` of the rows by hash of their codes, a slice at a time; equal codes are in one slice."""
    spark, path = frame.sparkSession, work_folder(frame.sparkSession)
    place = F.pmod(F.xxhash64(*[F.col(f"`{column}`") for column, *_ in coded]), F.lit(slices)).cast("int")
    plain = lambda schema: StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])
    kept = plain(frame.schema)
    with shuffles_dropped(spark):
        rows = frame.select("*", place).toDF(*kept.names, "slice")
        rows.write.partitionBy("slice").parquet(f"{path}/rows", compression="zstd")
        for i in range(slices):
            rows = spark.read.schema(StructType([*kept.fields, StructField("slice", IntegerType())])).parquet(f"{path}/rows")
            rows = rows.where(F.col("slice") == i).drop("slice").toDF(*frame.columns)
            named = _named(rows, coded, on_unknown)
            named.toDF(*plain(named.schema).names).write.parquet(f"{path}/named/{i}", compression="zstd")
            drop_folder(spark, f"{path}/rows/slice={i}")
    written = spark.read.schema(plain(named.schema)).parquet(*[f"{path}/named/{i}" for i in range(slices)])
    return written.toDF(*named.columns)


def _named(frame: DataFrame, coded: Sequence[tuple[str, CodeBook, bool, str]], on_unknown: str) -> DataFrame:
    """The frame with its names, as a plan of joins."""
    keys = [free_name(f"_key{i}", frame) for i in range(len(coded))]
    keyed = frame.withColumns({key: code_key(coded, i, F.col(f"`{coded[i][0]}`")) for i, key in enumerate(keys)})
    names = code_names(frame, coded, on_unknown)
    for key, (*_, name) in zip(keys, coded, strict=True):
        other, found = (free_name(n, keyed) for n in ("_other", "_name"))
        keyed = spread_join(keyed, names.toDF(other, found), key, other)
        kept = [F.col(f"`{c}`") for c in keyed.columns if c not in (key, other, found) and c.lower() != name.lower()]
        keyed = keyed.select(*kept, F.coalesce(found, F.lit("")).alias(name))
    return keyed


def code_key(coded: Sequence[tuple[str, CodeBook, bool, str]], i: int, value: Column) -> Column:
    """What ``code_names`` knows a value of the i-th coded column by; NULL for NULL."""
    _, book, is_list, _ = coded[i]
    own = next(j for j, (_, other, *_) in enumerate(coded) if other is book)
    return F.concat(F.lit(f"{own}{'l' if is_list else 'c'}"), value)


def code_names(
    frame: DataFrame, coded: Sequence[tuple[str, CodeBook, bool, str]], on_unknown: str = "truncate"
) -> DataFrame:
    """``key, name`` of all distinct codes and code lists in the coded columns, by one join to the dictionaries.

    Every distinct list is decoded once; a group here holds the pieces of a single list. Values without a name are
    left out.
    """
    _check_mode(on_unknown)
    books: list[CodeBook] = []
    for _, book, *_ in coded:
        if not any(book is known for known in books):
            books.append(book)
    tag = lambda book: next(str(i) for i, (_, other, *_) in enumerate(coded) if other is book)
    entries = reduce(DataFrame.unionAll, [b.frame.select(F.concat(F.lit(tag(b)), "code").alias("code"), "name") for b in books])
    entries = entries if all(b.fits() for b in books) else entries.hint("merge")
    values = F.array(*[code_key(coded, i, F.col(f"`{column}`")) for i, (column, *_) in enumerate(coded)])
    values = frame.select(F.explode(values).alias("key")).where("key IS NOT NULL").distinct()
    # a key is its dictionary's number, a letter for a list or a code, and the value
    place = F.regexp_extract("key", "^[0-9]+", 0)
    value = F.expr("substr(key, length(place) + 2)")
    values = values.withColumn("place", place).withColumn("value", value)
    is_list = F.substr("key", F.length("place") + 1, F.lit(1)) == "l"
    pieces = F.when(is_list, F.expr(_pieces_sql("value"))).otherwise(F.array("value"))
    pieces = values.select("key", is_list.alias("is_list"), "place", F.posexplode(pieces).alias("_pos", "piece"))
    pieces = pieces.withColumn("code", F.concat("place", "piece"))
    found = F.when(F.col("name") != "", F.struct("_pos", "name"))
    return (
        pieces.join(entries, "code", "left")
        .groupBy("key")
        .agg(
            F.array_sort(F.collect_list(found)).alias("_found"),
            F.min(F.when(F.col("name").isNull(), F.col("_pos"))).alias("_unknown"),
            F.first("is_list").alias("is_list"),
        )
        .select("key", F.expr(f"if(is_list, {_found_names_sql(on_unknown)}, get(_found, 0).name)").alias("name"))
    )


def _found_names_sql(on_unknown: str) -> str:
    """Names from the sorted ``_found`` pieces and the place of the first ``_unknown`` one."""
    if on_unknown == "skip":
        return "array_join(transform(_found, p -> p.name), ',')"
    before = "transform(filter(_found, p -> _unknown IS NULL OR p._pos < _unknown), p -> p.name)"
    return f"concat(array_join({before}, ','), if(get(_found, 0)._pos < _unknown, ',', ''))"
