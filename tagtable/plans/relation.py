"""The enterprise of each customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tagtable.functions.columns import not_blank
from tagtable.operators.joins import matched
from tagtable.operators.perkey import limit_by
from tagtable.operators.copies import COPIES, copied, counted, is_repeated


def pick_relation(
    rows: DataFrame, tie_break: Sequence[Column | str] = ("entId", "createTime", "custName")
) -> DataFrame:
    """The oldest relation row of every customer, among rows that name an enterprise.

    ``rows`` holds ``custId, entId, createTime, custName, updateTime``. Rows without an update time come
    last. The result has one row per customer.
    """
    named = rows.where(not_blank(F.col("entId")))
    order = [F.asc_nulls_last("updateTime"), *[F.col(c) if isinstance(c, str) else c for c in tie_break]]
    return limit_by(named, ["custId"], order).select("custId", "entId", "createTime", "custName")


def matched_source(
    dimension: DataFrame, relation: DataFrame, partitions: int | None = None
) -> DataFrame:
    """Customers of the dimension that have an enterprise, as ``cust_id, ent_id, createDate, custNameCn``.

    Customers are counted before the join and copied after it, so one that occurs many times takes one row there.
    ``partitions`` deals the rows out evenly.
    """
    related = relation.where(F.col("entId").isNotNull()).select(
        F.col("custId").alias("cust_id"),
        F.col("entId").alias("ent_id"),
        F.col("createTime").alias("createDate"),
        F.col("custName").alias("custNameCn"),
    )
    customers = counted(dimension.where(F.col("cust_id").isNotNull()), "cust_id")
    source = copied(matched(customers, related, "cust_id"), COPIES, is_repeated(customers))
    source = source.select("cust_id", "ent_id", "createDate", "custNameCn")
    return source.repartition(partitions) if partitions else source


def build_matched_source(
    dimension: DataFrame, relation_rows: DataFrame, partitions: int | None = None
) -> DataFrame:
    """``matched_source`` from the relation's raw rows."""
    return matched_source(dimension, pick_relation(relation_rows), partitions)
