"""Copies of rows: counted before a join, so that they do not meet in it, and made after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagtable.operators.skew import free_name, place_of

COPIES = "_copies"
COPIES_PER_CHUNK = 100_000


def counted(frame: DataFrame, *columns: str) -> DataFrame:
    """The distinct values of some columns and how often each occurs, NULL being a value."""
    return frame.groupBy(*columns).agg(F.count(F.lit(1)).alias(COPIES))


def is_repeated(counts: DataFrame, copies: str = COPIES) -> bool:
    """Whether a row of ``counted`` stands for more than one chunk of copies."""
    most = counts.agg(F.max(F.expr(copies))).first()[0]
    return (most or 0) > COPIES_PER_CHUNK


def copied(frame: DataFrame, copies: str, repeated: bool) -> DataFrame:
    """Every row as often as an expression says, without the count.

    Copies are made in chunks; where a row stands for several of them (``repeated``), the chunks are dealt out to
    all tasks first.
    """
    n, chunk, copy = (free_name(name, frame) for name in ("_n", "_chunk", "_copy"))
    chunks = frame.selectExpr("*", f"{copies} AS {n}").selectExpr(
        "*", f"explode(sequence(0, ({n} - 1) div {COPIES_PER_CHUNK})) AS {chunk}"
    )
    if repeated:
        chunks = chunks.repartition(place_of(chunks))
    size = f"least({COPIES_PER_CHUNK}, {n} - {chunk} * {COPIES_PER_CHUNK})"
    return chunks.selectExpr("*", f"explode(sequence(1, {size})) AS {copy}").drop(n, chunk, copy, COPIES)
