"""Scalar functions, all native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def presence_flag(column: Column) -> Column:
    return F.when(column.isNotNull(), 1).otherwise(0)


def contains_flag(column: Column, text: str) -> Column:
    """1 where ``text`` occurs in the column; NULL gives 0."""
    return F.when(F.instr(column, text) > 0, 1).otherwise(0)


def yes_no_label(flag: Column, yes: str, no: str) -> Column:
    """Label of a 1/0 flag; any other value, NULL among them, has none."""
    return F.when(flag == 1, yes).when(flag == 0, no)


def not_blank(column: Column) -> Column:
    return column.isNotNull() & (column != "")


def safe_date(column: Column) -> Column:
    """The day of a date or timestamp, or of its text; NULL where the text is no date."""
    return column.try_cast("date")


def days_between(column: Column, first: str, last: str) -> Column:
    """Whether the column's day lies in an inclusive range of ISO days."""
    return column.cast("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def previous_day(run_date: Column) -> Column:
    return F.date_sub(run_date.cast("date"), 1)


def format_timestamp(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def java_hash_bucket(column: Column, buckets: int) -> Column:
    """``abs(java string hash) % buckets`` of an ASCII id, as a database computes it for a split read."""
    unsigned = F.aggregate(
        F.split(column, ""),
        F.lit(0).cast("bigint"),
        lambda acc, char: (acc * 31 + F.ascii(char)) % F.lit(1 << 32),
    )
    signed = F.when(unsigned >= 1 << 31, unsigned - (1 << 32)).otherwise(unsigned)
    return (F.abs(signed) % buckets).cast("int")


def date_slices(column: str, ranges: Sequence[tuple[str, str]], remainder: bool = True) -> list[str]:
    """One SQL predicate per inclusive day range, for a read split by predicates.

    The last predicate takes all other rows, those without a day among them, so that the slices of ranges that do
    not overlap give every row once. ``remainder=False`` reads the ranges alone.
    """
    slices = [
        f"cast({column} as date) >= date '{first}' AND cast({column} as date) <= date '{last}'"
        for first, last in ranges
    ]
    if remainder:
        inside = " OR ".join(f"({s})" for s in slices) or "1 = 0"
        slices.append(f"cast({column} as date) IS NULL OR NOT ({inside})")
    return slices
