"""The paths that only large tables take, over the test tables: few rows per task, and large dictionaries.

Each query has the SQL of the one that it repeats. The written jobs load two days and one of them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from tagtable.functions import decode
from tagtable.operators import joins
from tagtable.plans.customer_tags import customer_tags, load_customer_tags
from tagtable.plans.latest_campaigns import build_latest_campaigns, load_latest_campaigns
from tagtable.session import work_folder
from tagtable.sinks.files import DATE_COLUMN
from tagtable.sources.dictionary import CodeBook
from tagtable.sources.files import read_dated
from tagtable.specs import CAMPAIGN_SCHEMA, TAG_SCHEMA
from tagtable.workload import jobs, relational
from tagtable.workload.registry import QUERIES, SQL, query
from tagtable.workload.tables import RUN_DATE, Tables

FEW_ROWS = 6
EARLIER, EARLIER_RUN = "2024-01-30", "2024-01-31"


def _split(name: str, build: Callable[[Tables], DataFrame]) -> None:
    QUERIES[f"{name}_split"] = lambda spark, folder: build(Tables(spark, folder))
    SQL[f"{name}_split"] = SQL[name]


_split("join_left_using", lambda t: relational.join_left_using(t, 1))
_split("join_matched", lambda t: relational.join_matched(t, FEW_ROWS))
_split("join_enrich_chain", lambda t: relational.join_enrich_chain(t, FEW_ROWS))
_split("job_extract", lambda t: jobs.job_extract(t, FEW_ROWS))
_split("job_latest_campaigns_many", lambda t: jobs.job_latest_campaigns_many(t, FEW_ROWS))
_split("win_rank", lambda t: relational.win_rank(t, FEW_ROWS))
_split("win_latest_rank", lambda t: relational.win_latest_rank(t, FEW_ROWS))
_split("job_customer_wide", lambda t: relational.wide(t, FEW_ROWS))
_split(
    "job_latest_campaigns",
    lambda t: build_latest_campaigns(t.dim(), t.shared_relation_rows(), t.promotion(), RUN_DATE, FEW_ROWS),
)


def _large_book(t: Tables) -> CodeBook:
    """Names of all parts and orders, over 10,000 at most scales."""
    parts = t.read("part").select(F.concat(F.lit("P"), "p_partkey").alias("code"), F.concat(F.lit("part "), "p_name").alias("name"))
    orders = t.read("orders").select(F.concat(F.lit("O"), "o_orderkey").alias("code"), F.concat(F.lit("order "), "o_orderkey").alias("name"))
    return CodeBook(parts.unionByName(orders))


def _lists(t: Tables) -> DataFrame:
    """Code lists of one part and one order each, some with an unknown code between."""
    middle = F.when(F.col("l_linenumber") % 3 == 0, F.lit("zz")).otherwise(F.concat(F.lit("O"), "l_orderkey"))
    codes = F.concat_ws("\u0002", F.concat(F.lit("P"), "l_partkey"), middle, F.concat(F.lit("O"), "l_orderkey"))
    return t.read("lineitem").select("l_orderkey", "l_linenumber", codes.alias("codes"), F.concat(F.lit("O"), "l_orderkey").alias("code"))


LARGE = """
    SELECT l_orderkey, l_linenumber, 'part ' || p_name || CASE WHEN l_linenumber % 3 = 0 THEN ','
               ELSE ',order ' || l_orderkey || ',order ' || l_orderkey END AS names, 'order ' || l_orderkey AS name
    FROM lineitem JOIN part ON l_partkey = p_partkey"""


def job_customer_tags_large_dictionary(t: Tables) -> DataFrame:
    """The tags by a dictionary that also names all parts and orders; it is joined once for all coded tags."""
    book = CodeBook(t.dictionary().unionByName(_large_book(t).frame))
    return customer_tags(relational.wide(t), book, book, RUN_DATE)


QUERIES[job_customer_tags_large_dictionary.__name__] = lambda spark, folder: job_customer_tags_large_dictionary(Tables(spark, folder))
SQL[job_customer_tags_large_dictionary.__name__] = SQL["job_customer_tags"]


@query("tag_codes_large_dictionary", LARGE)
def tag_codes_large_dictionary(t: Tables) -> DataFrame:
    book = _large_book(t)
    named = decode.with_code_list_names(_lists(t), "codes", book, "names")
    return joins.lookup_default(named, "code", book, "name").select("l_orderkey", "l_linenumber", "names", "name")


@query("udf_decode_codes_large_dictionary", LARGE)
def udf_decode_codes_large_dictionary(t: Tables) -> DataFrame:
    book = _large_book(t)
    decode.register_decoders(t.spark, book, book)
    return _lists(t).selectExpr("l_orderkey", "l_linenumber", "decode_codes(codes) AS names", "decode_code(code) AS name")


def _two_days(sql: str) -> str:
    return f"""SELECT * FROM ({sql}) UNION ALL SELECT * REPLACE ('{EARLIER}' AS "{DATE_COLUMN}") FROM ({sql})"""


def _read_days(t: Tables, path: str, schema: T.StructType) -> DataFrame:
    return read_dated(t.spark, path, schema).select(*schema.fieldNames()).where(F.col(DATE_COLUMN) >= EARLIER)


def job_load_customer_tags(t: Tables) -> DataFrame:
    path = work_folder(t.spark)
    for day in (EARLIER_RUN, RUN_DATE, RUN_DATE):
        load_customer_tags(relational.wide(t), t.book(), t.book(), day, path, keep=1)
    return _read_days(t, path, TAG_SCHEMA)


def job_load_latest_campaigns(t: Tables) -> DataFrame:
    path = work_folder(t.spark)
    for day in (EARLIER_RUN, RUN_DATE, RUN_DATE):
        load_latest_campaigns(t.dim(), t.shared_relation_rows(), t.promotion(), day, path, keep=1)
    return _read_days(t, path, CAMPAIGN_SCHEMA)


for _build, _of in ((job_load_customer_tags, "job_customer_tags"), (job_load_latest_campaigns, "job_latest_campaigns")):
    QUERIES[_build.__name__] = lambda spark, folder, build=_build: build(Tables(spark, folder))
    SQL[_build.__name__] = _two_days(SQL[_of])
