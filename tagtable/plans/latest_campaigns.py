"""Promotions of each customer's most recent promotion day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tagtable.functions.columns import not_blank, safe_date
from tagtable.operators.joins import matched
from tagtable.operators.perkey import latest_rows, string_set
from tagtable.operators.skew import ROWS_PER_TASK, Grid, Splits, hot_keys, measure_grid
from tagtable.plans.customer_tags import data_date_of
from tagtable.plans.relation import pick_relation
from tagtable.sinks.files import replace_date
from tagtable.specs import CAMPAIGN_SCHEMA

CAMPAIGN = ("popu_plat", "popu_type", "sem_url", "modify_time")


def enterprise_campaigns(promotion: DataFrame, splits: Splits | None = None) -> DataFrame:
    """Campaigns of each enterprise's latest day, with their distinct keywords as ``_keywords``."""
    dated = promotion.where(F.col("ent_id").isNotNull()).select(
        "ent_id",
        "popu_plat",
        "popu_type",
        "sem_url",
        "popu_keyword",
        safe_date(F.col("modify_time")).alias("modify_time"),
    )
    recent = latest_rows(dated, "ent_id", "modify_time", splits)
    return string_set(recent, ["ent_id", *CAMPAIGN], "popu_keyword", "_keywords")


def latest_campaigns(
    source: DataFrame,
    promotion: DataFrame,
    run_date: str,
    one_enterprise: bool = False,
    splits: Mapping[str, Splits] | None = None,
    grid: Grid | None = None,
) -> DataFrame:
    """Campaigns of the latest day per customer, each with its distinct keywords as one sorted list.

    ``source`` holds ``cust_id, ent_id``. Campaigns are first reduced to the latest day of every
    enterprise and grouped there, so the work on promotions is done once per enterprise, however many
    customers share it, and on one shuffle. ``one_enterprise`` says that no customer has two enterprises; without
    it, a customer's latest day is picked among its enterprises' days, of which there is one each, and only
    enterprises with that day meet their campaigns. ``grid`` (``measure_links``) cuts enterprises whose customers
    and campaigns make many rows.
    """
    splits = splits or {}
    campaigns = enterprise_campaigns(promotion, splits.get("promotion"))
    links = source.select("cust_id", "ent_id").distinct()
    if not one_enterprise:
        days = campaigns.groupBy("ent_id").agg(F.max("modify_time").alias("_day"))
        dated = matched(links, days, "ent_id", splits.get("source"))
        links = latest_rows(dated, "cust_id", "_day", splits.get("customer")).drop("_day")
    found = matched(links, campaigns, "ent_id", splits.get("source"), grid=grid)
    if not one_enterprise:
        found = found.withColumn("_keyword", F.explode_outer("_keywords"))
        found = string_set(found, ["cust_id", *CAMPAIGN], "_keyword", "_keywords")
    return found.select(
        F.col("cust_id").alias("CUST_ID"),
        F.col("popu_plat").alias("POPU_PLAT"),
        F.col("popu_type").alias("POPU_TYPE"),
        F.col("sem_url").alias("SEM_URL"),
        F.col("modify_time").alias("RELEASE_TIME"),
        F.array_join("_keywords", ",").alias("POPU_KEYWORD_LIST"),
        F.lit(data_date_of(run_date)).alias("DATA_DATE"),
    ).select(*CAMPAIGN_SCHEMA.fieldNames())


def measure_links(
    links: DataFrame, promotion: DataFrame, splits: Splits | None = None, rows_per_task: int = ROWS_PER_TASK
) -> Grid:
    """How to cut enterprises (``ent_id``) whose customers and campaigns make many rows together.

    Enterprises are looked for by the number of their promotions, which is at least that of their campaigns; only
    of those found are the campaigns grouped and counted.
    """
    grid = measure_grid(links, [promotion], "ent_id", rows_per_task)
    if not grid:
        return grid
    large = [grid.marked(frame, "ent_id", "_g").where(F.col("_g").isNotNull()).drop("_g") for frame in (links, promotion)]
    return measure_grid(large[0], [enterprise_campaigns(large[1], splits)], "ent_id", rows_per_task)


def build_latest_campaigns(
    dimension: DataFrame,
    relation_rows: DataFrame,
    promotion: DataFrame,
    run_date: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``latest_campaigns`` from the relation's raw rows, with large enterprises measured and cut."""
    splits = hot_keys({"promotion": (promotion, "ent_id")}, rows_per_task)
    named = relation_rows.where(not_blank(F.col("entId"))).select(F.col("entId").alias("ent_id"))
    grid = measure_links(named, promotion, splits["promotion"], rows_per_task)
    related = pick_relation(relation_rows).select(
        F.col("custId").alias("cust_id"), F.col("entId").alias("ent_id")
    )
    source = dimension.select("cust_id").distinct().join(related, "cust_id")
    return latest_campaigns(source, promotion, run_date, one_enterprise=True, splits=splits, grid=grid)


def load_latest_campaigns(
    dimension: DataFrame, relation_rows: DataFrame, promotion: DataFrame, run_date: str, path: str, keep: int = 0
) -> None:
    """Compute the campaigns of a day and put them in place of that day in the table at ``path``.

    ``keep`` runs before it stay for readers (``sources.files.read_dated``) that have begun with them.
    """
    rows = build_latest_campaigns(dimension, relation_rows, promotion, run_date)
    replace_date(rows, path, data_date_of(run_date), keep)
