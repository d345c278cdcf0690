"""Wide tag columns to long, labelled tag rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tagtable.functions.decode import INLINE_CODES, code_key, code_names, decode_code, decode_codes, sql_text
from tagtable.operators.joins import lookup_default
from tagtable.operators.skew import free_name, spread_join
from tagtable.sources.dictionary import CodeBook
from tagtable.specs import FREE, MULTI_CODE, SINGLE_CODE, TAG_SCHEMA, TAGS, YES_NO, TagSpec


def tag_code(column: Column, specs: Sequence[TagSpec] = TAGS) -> Column:
    """Tag code of a tag column's name; NULL for other names."""
    return F.try_element_at(F.create_map(*[F.lit(v) for s in specs for v in (s.column, s.code)]), column)


def unpivot_tags(wide: DataFrame, customer: str, specs: Sequence[TagSpec] = TAGS) -> DataFrame:
    """One row per customer row and tag, NULL values kept, in a single pass over the wide table."""
    columns = [f"CAST(`{s.column}` AS STRING) AS `{s.code}`" for s in specs]
    renamed = wide.selectExpr(f"CAST(`{customer}` AS STRING) AS CUST_ID", *columns)
    return renamed.unpivot("CUST_ID", [s.code for s in specs], "TAG_CODE", "TAG_VALUE")


def emit_tags(
    wide: DataFrame,
    customer: str,
    data_date: str,
    industries: CodeBook | None = None,
    regions: CodeBook | None = None,
    specs: Sequence[TagSpec] = TAGS,
    on_unknown: str = "truncate",
) -> DataFrame:
    """The long tag table of one day.

    Yes/no tags get their words, code tags the names of their codes, free values no label. ``industries``
    names the codes of code lists, ``regions`` single codes. All tags are emitted in one pass, with their labels
    where those follow from the row or from a dictionary of a size to broadcast. Other coded values are emitted first,
    all in one column, and get their names by one join; the first of them brings the row's other tags along.
    """
    coded = []
    plain = []
    for spec in specs:
        column = F.col(f"`{spec.column}`")
        if spec.kind in (MULTI_CODE, SINGLE_CODE):
            is_list = spec.kind == MULTI_CODE
            book = industries if is_list else regions
            if book.fits(INLINE_CODES):
                entries = book.entries(INLINE_CODES)
                label = decode_codes(spec.column, entries, on_unknown) if is_list else decode_code(spec.column, entries)
            elif book.fits() and not is_list:
                name = free_name(f"_label{len(plain)}", wide)
                wide, label = lookup_default(wide, spec.column, book, name), F.col(name)
            else:
                coded.append((spec.column, book, is_list, spec.code))
                continue
        elif spec.kind in YES_NO:
            yes, no = YES_NO[spec.kind]
            label = F.when(column == 1, yes).when(column == 0, no)
        elif spec.kind == FREE:
            label = F.lit(None)
        else:
            raise ValueError(f"unknown tag kind: {spec.kind}")
        plain.append(_tag(F.lit(spec.code), column, label))
    owner = F.col(f"`{customer}`").cast("string").alias("CUST_ID")
    others = F.array(*plain).cast(_TAGS)
    if coded:
        first = lambda i: others if i == 0 else F.array().cast(_TAGS)
        items = [
            F.struct(F.lit(code).alias("code"), F.col(f"`{c}`").cast("string").alias("value"), code_key(coded, i, F.col(f"`{c}`")).alias("key"), first(i).alias("others"))
            for i, (c, _, _, code) in enumerate(coded)
        ]
        rows = wide.select(owner, F.explode(F.array(*items)).alias("t")).select("CUST_ID", "t.*")
        names = code_names(wide, coded, on_unknown).toDF("known", "name")
        rows = spread_join(rows, names, "key", "known")
        others = F.concat(F.array(_tag(F.col("code"), F.col("value"), F.coalesce("name", F.lit("")))).cast(_TAGS), F.col("others"))
    else:
        rows, others = wide.select(owner, others.alias("others")), F.col("others")
    emitted = rows.select("CUST_ID", F.inline(others))
    return emitted.select(*TAG_SCHEMA.fieldNames()[:-1], F.lit(data_date).alias(TAG_SCHEMA.fieldNames()[-1]))


_TAGS = "array<struct<TAG_CODE: string, TAG_VALUE: string, TAG_VALUE_NAME: string>>"


def _tag(code: Column, value: Column, label: Column) -> Column:
    return F.struct(code.alias("TAG_CODE"), value.cast("string").alias("TAG_VALUE"), label.cast("string").alias("TAG_VALUE_NAME"))
