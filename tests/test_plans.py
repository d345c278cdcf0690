"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from bench import presence_by_chained_joins
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tagtable.plans.decode_preview import with_name_containing
from tagtable.session import work_folder
from tagtable.sinks.files import preview
from tagtable.sources.dictionary import CodeBook

WRITERS = {"snk_", "src_dictionary", "phy_persist", "job_extract", "job_campaigns_from_snapshots"}


@pytest.fixture
def fixed(spark):
    """Plans without broadcast and adaptive execution, as for tables too large to broadcast."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def count(pattern, text):
    return len(re.findall(pattern, text))


def query_plan(spark, name):
    return plan(spark_entry.queries()[name](spark, SMALL))


@pytest.mark.parametrize("name", sorted(n for n in spark_entry.queries() if not n.startswith(tuple(WRITERS))))
def test_no_cross_join_and_no_row_udf(fixed, name):
    text = query_plan(fixed, name)
    assert not re.search("CartesianProduct|NestedLoop|EvalPython", text)
    assert ("Python" in text or "Pandas" in text) == (name == "udf_map_partitions")


def test_presence_flags_need_one_join(fixed):
    ours = query_plan(fixed, "join_presence_flags")
    assert (count("Exchange hash", ours), count("SortMergeJoin", ours)) == (2, 1)
    chained = plan(presence_by_chained_joins(fixed, SMALL))
    assert (count("Exchange hash", chained), count("SortMergeJoin", chained)) == (6, 5)


def test_first_and_latest_rows_are_cut_before_the_shuffle(fixed):
    for name in ("job_relation", "top_limit_by", "win_latest_rank"):
        text = query_plan(fixed, name)
        assert re.search(r"Exchange hash[^\n]*\n[^\n]*WindowGroupLimit[^\n]*", text), name
        assert count("Exchange", text) == 1


def test_promotions_are_shuffled_once(fixed):
    text = query_plan(fixed, "job_latest_campaigns")
    promotion = text[text.index("collect_list") :]
    assert count("Exchange hash", promotion) == 1
    # besides them the dimension, the relation and the link of the two
    assert count("Exchange hash", text) == 4


def test_wide_table_shuffles(fixed):
    text = query_plan(fixed, "job_customer_wide")
    base_join = 4  # the base table of the test data is itself a join
    # dimension, relation, their join, facts, capital (distinct pairs, then by enterprise), base
    assert count(r"(?<!Reused)Exchange hash", text) - count("ReusedExchange", text) == 7 + base_join
    assert len(re.findall(r"(?m)^[^\n\w]*(?:\*\(\d+\) )?Window \[", text)) == 1  # the relation is ranked once


def test_scans_read_only_needed_columns(fixed):
    text = query_plan(fixed, "join_presence_flags")
    read = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert read and all(len(columns.split(",")) <= 3 for columns in read)


def test_filter_on_a_decoded_name_reaches_the_scan(spark, frame):
    path = work_folder(spark)
    frame("ent_id,cnei_code", [("1", "M"), ("2", "S")]).write.parquet(path)
    book = CodeBook(frame("code,name", [("M", "food making"), ("S", "service"), ("T", "making")]))
    text = plan(with_name_containing(spark.read.parquet(path), "cnei_code", book, "making"))
    assert "PushedFilters: [In(cnei_code, [M,T])]" in text


def test_preview_is_a_top_n(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    assert "TakeOrderedAndProject" in plan(preview(orders, ["o_orderkey"]))


def test_dates_are_pruned_by_folder(spark):
    from tagtable.sinks.files import replace_date

    path = work_folder(spark)
    for day in ("2024-01-01", "2024-01-02"):
        replace_date(spark.range(5), path, day)
    text = plan(spark.read.parquet(path).where(F.col("DATA_DATE") == "2024-01-02"))
    assert re.search(r"PartitionFilters: \[[^\]]*DATA_DATE", text)
