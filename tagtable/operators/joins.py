"""Join operators. All are equi-joins; Spark picks the physical join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tagtable.operators.skew import Grid, Splits, free_name, join_chain, spread_join
from tagtable.sources.dictionary import CodeBook

_MASK_BITS = 62


def matched(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_splits: Splits | None = None,
    right_splits: Splits | None = None,
    grid: Grid | None = None,
) -> DataFrame:
    """Rows of both sides that share a key; a measured ``grid`` cuts keys with many pairs of rows."""
    return join_chain(left, [right], key, "inner", left_splits, [right_splits], grid)


def presence_masks(facts: Mapping[str, DataFrame], key: str) -> tuple[DataFrame, dict[str, Column]]:
    """One row per key that occurs in any of the fact frames, and the 0/1 flag expression of each fact.

    Every fact is one bit. The bits of a key are combined before the shuffle, so repeated keys cost nothing
    there, and however many facts there are, the flags need one aggregation and later one join.
    """
    masks = [f"_mask{i}" for i in range(-(-len(facts) // _MASK_BITS))]
    tagged, flags = [], {}
    for i, (name, frame) in enumerate(facts.items()):
        own, bit = divmod(i, _MASK_BITS)
        marks = [f"{1 << bit if m == own else 0}L AS {mask}" for m, mask in enumerate(masks)]
        tagged.append(frame.where(F.col(key).isNotNull()).selectExpr(f"`{key}`", *marks))
        flags[name] = F.expr(f"CAST(coalesce(shiftright({masks[own]}, {bit}) & 1, 0) AS INT)")
    union = reduce(DataFrame.unionAll, tagged)
    return union.groupBy(key).agg(*[F.bit_or(m).alias(m) for m in masks]), flags


def presence_flags(
    left: DataFrame, facts: Mapping[str, DataFrame], key: str, left_splits: Splits | None = None
) -> DataFrame:
    """Add a 0/1 column per fact frame: whether the row's key occurs in it."""
    masks, flags = presence_masks(facts, key)
    joined = join_chain(left, [masks], key, "left", left_splits)
    return joined.select(*left.columns, *[flag.alias(name) for name, flag in flags.items()])


def enrich(
    left: DataFrame,
    rights: Sequence[DataFrame],
    key: str,
    left_splits: Splits | None = None,
    right_splits: Sequence[Splits | None] | None = None,
    grid: Grid | None = None,
) -> DataFrame:
    """Chained left joins on one key; several right rows of a key multiply the left row.

    A measured ``grid`` cuts keys whose rows of all sides make many.
    """
    joined = join_chain(left, rights, key, "left", left_splits, right_splits, grid)
    added = [c for right in rights for c in right.columns if c != key]
    return joined.select(*left.columns, *added)


def lookup_default(frame: DataFrame, code: str, book: CodeBook, name: str) -> DataFrame:
    """Add the dictionary name of a single code, ``''`` for NULL and unknown codes.

    A dictionary of a checked small size is broadcast. A larger one is joined by shuffle, spread so that
    neither a popular code nor the rows without one end up in a single task.
    """
    known, named = free_name("_code", frame), free_name("_name", frame)
    names = book.frame.select(F.col("code").alias(known), F.col("name").alias(named))
    if book.fits():
        joined = frame.join(F.broadcast(names), F.col(f"`{code}`") == F.col(known), "left")
    else:
        joined = spread_join(frame, names.hint("merge"), code, known)  # over the checked size, so never broadcast
    kept = [F.col(f"`{c}`") for c in frame.columns if c.lower() != name.lower()]
    return joined.select(*kept, F.coalesce(named, F.lit("")).alias(name))
