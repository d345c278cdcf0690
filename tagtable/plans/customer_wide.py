"""One wide row per customer: flags and attributes of its enterprise."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tagtable.functions.columns import contains_flag, not_blank
from tagtable.operators.copies import copied, counted, is_repeated
from tagtable.operators.joins import presence_masks
from tagtable.operators.skew import ROWS_PER_TASK, Grid, Splits, hot_keys, join_chain, measure_grid
from tagtable.plans.relation import pick_relation
from tagtable.specs import IMPORT_EXPORT_TEXT

COPIES_SQUARED = "if(_has, _copies * _copies, _copies)"
BASE_COLUMNS = ("estimate_date", "cnei_code", "cnei_sec_code", "province_code", "city_code", "county_code")


def customer_wide(
    dimension: DataFrame,
    relation: DataFrame,
    facts: Mapping[str, DataFrame],
    capital: DataFrame,
    base_info: DataFrame,
    scope_text: str = IMPORT_EXPORT_TEXT,
    grid: Grid | None = None,
) -> DataFrame:
    """Every dimension row with the flags and attributes of its customer's enterprise, NULL if it has none.

    ``relation`` has one row per customer (``pick_relation``), ``facts`` one frame per flag column. Several
    capital values or base rows of an enterprise multiply its customers' rows, and a customer that occurs
    ``n`` times in the dimension gets its rows ``n * n`` times.

    The dimension is counted per customer before the join and the copies are made after it, so repeated
    customers do not meet in a join; whether any are so many that the copies have to be dealt out is one number that
    is counted here. ``grid`` cuts enterprises with many rows (``measure_enterprises``). The relation is joined once; customers without an enterprise go on under a
    key that starts with a NUL, as no enterprise's id does. Rows without a customer skip all joins.
    """
    known = dimension.select("cust_id").where(F.col("cust_id").isNotNull())
    customers = counted(known, "cust_id")
    related = relation.where(F.col("entId").isNotNull())
    on_customer = F.col("cust_id") == F.col("custId")

    masks, flags = presence_masks(facts, "ent_id")
    rights = [
        masks,
        capital.where(F.col("ent_id").isNotNull()).select("ent_id", "reg_caps2").distinct(),
        base_info.where(F.col("ent_id").isNotNull()).select("ent_id", *BASE_COLUMNS, "oper_scope"),
    ]
    # customers without an enterprise stay in the chain under a key of their own, which joins nothing
    located = customers.join(related, on_customer, "left").withColumn("_has", F.col("entId").isNotNull())
    located = located.withColumn("ent_id", F.coalesce("entId", F.concat(F.lit("\0"), "cust_id"))).drop("entId")
    enriched = join_chain(located, rights, "ent_id", "left", grid=grid or Grid(None))
    only = lambda column: F.when(F.col("_has"), column)
    rows = copied(enriched, COPIES_SQUARED, is_repeated(customers, "_copies * _copies"))
    found = rows.select(
        "cust_id",
        F.expr("createTime AS createDate"),
        F.expr("custName AS custNameCn"),
        *[only(flag).alias(name) for name, flag in flags.items()],
        only(contains_flag(F.col("oper_scope"), scope_text)).alias("t6"),
        "reg_caps2",
        *BASE_COLUMNS,
    )
    unknown = dimension.select("cust_id").where(F.col("cust_id").isNull())
    return found.unionByName(unknown, allowMissingColumns=True)


def measure_enterprises(
    relation_rows: DataFrame, capital: DataFrame, base_info: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> Grid:
    """How to cut enterprises whose customers, capital values and base rows make many rows together.

    The relation is measured before one row per customer is picked; that only means some parts too many. Distinct
    capital values are counted only if the enterprises would be cut by all values.
    """
    related = relation_rows.where(not_blank(F.col("entId"))).select(F.col("entId").alias("ent_id"))
    values = capital.select("ent_id", "reg_caps2")
    for capitals in (values, values.distinct()):
        grid = measure_grid(related, [None, capitals, base_info], "ent_id", rows_per_task)
        if not grid:
            break
    return grid


def measure_splits(
    dimension: DataFrame,
    relation_rows: DataFrame,
    capital: DataFrame,
    base_info: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
) -> dict[str, Splits]:
    """Hot customers and enterprises of each input of ``customer_wide``, to look at before a run."""
    keyed = {
        "relation": (relation_rows.where(not_blank(F.col("entId"))), "entId"),
        "capital": (capital.where(F.col("ent_id").isNotNull()).select("ent_id", "reg_caps2").distinct(), "ent_id"),
        "base_info": (base_info, "ent_id"),
    }
    # a customer that occurs n times comes out n * n times
    squared = hot_keys({"dimension": (dimension, "cust_id")}, math.isqrt(rows_per_task))
    return hot_keys(keyed, rows_per_task) | squared


def build_customer_wide(
    dimension: DataFrame,
    relation_rows: DataFrame,
    facts: Mapping[str, DataFrame],
    capital: DataFrame,
    base_info: DataFrame,
    scope_text: str = IMPORT_EXPORT_TEXT,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``customer_wide`` from the relation's raw rows, with large enterprises measured and cut."""
    grid = measure_enterprises(relation_rows, capital, base_info, rows_per_task)
    return customer_wide(dimension, pick_relation(relation_rows), facts, capital, base_info, scope_text, grid)
