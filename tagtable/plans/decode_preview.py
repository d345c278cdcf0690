"""Decoded attributes of enterprises whose industry name holds a text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagtable.operators.joins import lookup_default
from tagtable.sinks.files import preview
from tagtable.sources.dictionary import CodeBook
from tagtable.specs import MANUFACTURING_TEXT, PREVIEW_SCHEMA

# decoded column: its code column
INDUSTRY_NAMES = {"cnei": "cnei_code", "cnei_sec": "cnei_sec_code"}
REGION_NAMES = {"province": "province_code", "city": "city_code", "county": "county_code"}


def with_name_containing(frame: DataFrame, code: str, book: CodeBook, text: str) -> DataFrame:
    """Rows whose single code has a name that contains ``text``.

    With a small dictionary the matching codes are known beforehand, so the filter is on the code itself
    and reaches the scan.
    """
    if book.fits():
        codes = [c for c, name in book.entries().items() if text in name]
        # an empty text is in the '' of unknown codes too
        return frame if text == "" else frame.where(F.col(code).isin(codes))
    named = lookup_default(frame, code, book, "_name")
    return named.where(F.instr("_name", text) >= 1).drop("_name")


def decode_names(frame: DataFrame, industries: CodeBook, regions: CodeBook) -> DataFrame:
    """Replace the code columns by names, in the declared schema."""
    for book, names in ((industries, INDUSTRY_NAMES), (regions, REGION_NAMES)):
        for name, code in names.items():
            frame = lookup_default(frame, code, book, name)
    return frame.select(*PREVIEW_SCHEMA.fieldNames()).to(PREVIEW_SCHEMA)


def decode_preview(
    frame: DataFrame,
    industries: CodeBook,
    regions: CodeBook,
    text: str = MANUFACTURING_TEXT,
    rows: int = 20,
) -> DataFrame:
    """The first decoded rows, by enterprise, whose first-level industry name contains ``text``."""
    picked = with_name_containing(frame, "cnei_code", industries, text)
    decoded = decode_names(picked, industries, regions)
    return preview(decoded, ["ent_id", *[c for c in decoded.columns if c != "ent_id"]], rows)
