"""Scans, sinks, projections, filters and scalar functions."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tagtable.functions import columns as C
from tagtable.operators.batches import map_batches
from tagtable.operators.caching import persisted
from tagtable.operators.joins import enrich
from tagtable.operators.skew import hot_keys
from tagtable.plans.relation import pick_relation
from tagtable.session import shuffle_width, work_folder
from tagtable.sinks import files as sinks
from tagtable.sources import files as sources
from tagtable.sources.dictionary import read_dictionary
from tagtable.workload.registry import query
from tagtable.workload.tables import Tables

ORDER_SLICES = [("1900-01-01", "1994-12-31"), ("1995-01-01", "1997-12-31"), ("2101-01-01", "2200-12-31")]

# --- sources


@query("src_parquet", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_parquet(t: Tables) -> DataFrame:
    frame = sources.read_parquet(t.spark, f"{t.folder}/customer.parquet")
    return frame.select("c_custkey", "c_name", "c_acctbal")


@query("src_snapshot", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def src_snapshot(t: Tables) -> DataFrame:
    return sources.read_snapshot(t.spark, t.folder, "orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("src_format", "SELECT event_id, user_id, event_type, value FROM events")
def src_format(t: Tables) -> DataFrame:
    path = f"{t.folder}/events.parquet"
    return sources.read_format(
        t.spark, "parquet", {"path": path}, ["event_id", "user_id", "event_type", "value"]
    )


@query(
    "src_slice_predicates",
    """SELECT o_orderkey, CAST(CASE WHEN CAST(o_orderdate AS DATE) <= DATE '1994-12-31' THEN 0
                WHEN CAST(o_orderdate AS DATE) <= DATE '1997-12-31' THEN 1 ELSE 3 END AS INTEGER) AS slice
       FROM orders""",
)
def src_slice_predicates(t: Tables) -> DataFrame:
    """The predicates of a split read: over a table they give every row in exactly one slice.

    Days from 1998 on are in no range, but in the remainder.
    """
    orders = t.read("orders")
    slices = [
        orders.where(p).select("o_orderkey", F.lit(i).alias("slice"))
        for i, p in enumerate(C.date_slices("o_orderdate", ORDER_SLICES))
    ]
    return reduce(DataFrame.unionAll, slices)


@query(
    "src_dictionary",
    """SELECT p_brand AS code, MAX(p_type) AS name FROM part GROUP BY p_brand
       UNION ALL SELECT 'part-' || p_partkey, p_name || ' ' FROM part""",
)
def src_dictionary(t: Tables) -> DataFrame:
    """Text lines written from a table, with repeated codes and blanks at the end of names."""
    part = t.read("part")
    types = part.select("p_brand", "p_type").distinct().orderBy("p_brand", "p_type")
    repeated = types.select(F.concat_ws(",", "p_brand", "p_type", F.lit("more")).alias("value"))
    single = part.select(F.concat(F.lit("part-"), "p_partkey", F.lit(","), "p_name", F.lit(" ")).alias("value"))
    path = work_folder(t.spark)
    # the range sort of a few brands keeps the lines of a brand in order within the files' order
    repeated.write.text(f"{path}/repeated")
    single.write.text(f"{path}/single")
    return read_dictionary(t.spark, f"{path}/repeated").unionAll(read_dictionary(t.spark, f"{path}/single"))


# --- sinks


@query("snk_parquet", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def snk_parquet(t: Tables) -> DataFrame:
    path = work_folder(t.spark)
    sinks.write_new(t.read("supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    return t.spark.read.parquet(path)


@query("snk_compact", "SELECT p_partkey, p_name, p_brand FROM part")
def snk_compact(t: Tables) -> DataFrame:
    path = work_folder(t.spark)
    sinks.write_compact(t.read("part").select("p_partkey", "p_name", "p_brand"), path)
    return t.spark.read.parquet(path)


@query(
    "snk_replace_date",
    """SELECT o_orderkey, o_orderstatus, '2024-01-30' AS "DATA_DATE" FROM orders
       UNION ALL SELECT o_orderkey, 'rerun', '2024-01-31' FROM orders""",
)
def snk_replace_date(t: Tables) -> DataFrame:
    """Two days are loaded, then the second one again from the table itself, with another status."""
    path = work_folder(t.spark)
    rows = t.read("orders").select("o_orderkey", "o_orderstatus")
    sinks.replace_date(rows, path, "2024-01-30", keep=1)
    sinks.replace_date(rows, path, "2024-01-31", keep=1)
    schema = T.StructType(rows.schema.fields + [T.StructField(sinks.DATE_COLUMN, T.StringType())])
    own = sources.read_dated(t.spark, path, schema).where(F.col(sinks.DATE_COLUMN) == "2024-01-31")
    sinks.replace_date(own.withColumn("o_orderstatus", F.lit("rerun")), path, "2024-01-31", keep=1)
    return sources.read_dated(t.spark, path, schema)


@query(
    "snk_replace_dates",
    """SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 2 ELSE 1 END AS load,
              strftime(ts, '%Y-%m-%d') AS "DATA_DATE" FROM events""",
)
def snk_replace_dates(t: Tables) -> DataFrame:
    """All days are loaded, then the days of the second half again."""
    path = work_folder(t.spark)
    rows = t.read("events").select(
        "event_id", F.lit(1).alias("load"), F.date_format("ts", "yyyy-MM-dd").alias(sinks.DATE_COLUMN)
    )
    sinks.replace_dates(rows, path)
    sinks.replace_dates(
        rows.where(F.col(sinks.DATE_COLUMN) >= "2024-01-16").withColumn("load", F.lit(2)), path
    )
    return sources.read_dated(t.spark, path, rows.schema)


@query("snk_snapshot_refresh", "SELECT o_custkey, COUNT(*) AS orders FROM orders GROUP BY o_custkey")
def snk_snapshot_refresh(t: Tables) -> DataFrame:
    """A version is written twice; the second extract takes the place of the first."""
    base = work_folder(t.spark)
    sinks.refresh_snapshot(t.read("orders").select("o_custkey"), base, "customer_orders", "2024-01-31")
    counted = t.read("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return sinks.refresh_snapshot(counted, base, "customer_orders", "2024-01-31")


@query("snk_preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def snk_preview(t: Tables) -> DataFrame:
    orders = t.read("orders").select("o_orderkey", "o_totalprice")
    return sinks.preview(orders, [F.desc("o_totalprice"), F.col("o_orderkey")])


@query("snk_count", "SELECT COUNT(*) AS row_count FROM lineitem")
def snk_count(t: Tables) -> DataFrame:
    return sinks.row_count(t.read("lineitem"))


# --- projections


@query("prj_rename", "SELECT c_custkey AS cust_id, c_name AS cust_name, c_nationkey AS nation FROM customer")
def prj_rename(t: Tables) -> DataFrame:
    customer = t.read("customer")
    return customer.select(
        customer["c_custkey"].alias("cust_id"),
        customer["c_name"].alias("cust_name"),
        customer["c_nationkey"].alias("nation"),
    )


@query("prj_select_expr", "SELECT s_suppkey AS supp, s_acctbal > 0 AS solvent, upper(s_name) AS name FROM supplier")
def prj_select_expr(t: Tables) -> DataFrame:
    return t.read("supplier").selectExpr("s_suppkey as supp", "s_acctbal > 0 as solvent", "upper(s_name) as name")


@query(
    "prj_star_plus",
    "SELECT n.*, r_name AS region FROM nation n LEFT JOIN region ON n_regionkey = r_regionkey",
)
def prj_star_plus(t: Tables) -> DataFrame:
    nation, region = t.read("nation"), t.read("region")
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    return joined.select(nation["*"], region["r_name"].alias("region"))


@query("prj_literal", """SELECT o_orderkey, '2024-01-31' AS "DATA_DATE" FROM orders""")
def prj_literal(t: Tables) -> DataFrame:
    return t.read("orders").select("o_orderkey").withColumn("DATA_DATE", F.lit("2024-01-31"))


@query(
    "prj_column_list",
    """SELECT ent_id, estimate_date, cnei_code, province_code,
              CASE WHEN instr(oper_scope, 'BUILD') > 0 THEN 1 ELSE 0 END AS t6 FROM base_info""",
    "base_info",
)
def prj_column_list(t: Tables) -> DataFrame:
    names = ["ent_id", "estimate_date", "cnei_code", "province_code"]
    return t.base_info().select(*names, C.contains_flag(F.col("oper_scope"), "BUILD").alias("t6"))


@query(
    "prj_schema",
    "SELECT CAST(p_partkey AS VARCHAR) AS part, CAST(p_size AS BIGINT) AS size, p_name AS name FROM part",
)
def prj_schema(t: Tables) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("part", T.StringType()),
            T.StructField("size", T.LongType()),
            T.StructField("name", T.StringType()),
        ]
    )
    return t.read("part").selectExpr("p_name as name", "p_partkey as part", "p_size as size").to(schema)


# --- filters


@query("flt_not_null", 'SELECT "custId", "entId" FROM relation_rows WHERE "entId" IS NOT NULL', "relation_rows")
def flt_not_null(t: Tables) -> DataFrame:
    return t.relation_rows().where(F.col("entId").isNotNull()).select("custId", "entId")


@query(
    "flt_and",
    'SELECT "custId", "entId" FROM relation_rows WHERE "entId" IS NOT NULL AND "updateTime" IS NOT NULL',
    "relation_rows",
)
def flt_and(t: Tables) -> DataFrame:
    rows = t.relation_rows()
    return rows.where(rows["entId"].isNotNull() & rows["updateTime"].isNotNull()).select("custId", "entId")


@query(
    "flt_not_blank",
    """SELECT "custId", "entId" FROM relation_rows WHERE "entId" <> '' AND "entId" IS NOT NULL""",
    "relation_rows",
)
def flt_not_blank(t: Tables) -> DataFrame:
    return t.relation_rows().where(C.not_blank(F.col("entId"))).select("custId", "entId")


@query("flt_contains", "SELECT doc_id, lang FROM documents WHERE instr(text, 'the') >= 1")
def flt_contains(t: Tables) -> DataFrame:
    return t.read("documents").where(F.instr("text", "the") >= 1).select("doc_id", "lang")


@query(
    "flt_date_range",
    """SELECT event_id, event_type FROM events
       WHERE CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) <= DATE '2024-01-12'""",
)
def flt_date_range(t: Tables) -> DataFrame:
    days = C.days_between(F.col("ts"), "2024-01-10", "2024-01-12")
    return t.read("events").where(days).select("event_id", "event_type")


# --- scalar functions


@query("fn_presence", 'SELECT "custId", CASE WHEN "entId" IS NOT NULL THEN 1 ELSE 0 END AS flag FROM relation_rows', "relation_rows")
def fn_presence(t: Tables) -> DataFrame:
    return t.relation_rows().select("custId", C.presence_flag(F.col("entId")).alias("flag"))


@query(
    "fn_contains_flag",
    "SELECT ent_id, CASE WHEN instr(oper_scope, 'BUILD') > 0 THEN 1 ELSE 0 END AS t6 FROM base_info",
    "base_info",
)
def fn_contains_flag(t: Tables) -> DataFrame:
    return t.base_info().select("ent_id", C.contains_flag(F.col("oper_scope"), "BUILD").alias("t6"))


@query(
    "fn_case",
    """SELECT cust_id, t1, CASE t1 WHEN 1 THEN '有' WHEN 0 THEN '无' END AS label
       FROM (SELECT d.cust_id, CASE WHEN r."custId" IS NULL THEN NULL WHEN r."custName" = '5-LOW' THEN 1 ELSE 0 END AS t1
             FROM dim d LEFT JOIN relation r ON d.cust_id = r."custId") AS f""",
    "dim",
    "relation",
)
def fn_case(t: Tables) -> DataFrame:
    relation = pick_relation(t.relation_rows()).select(F.col("custId").alias("cust_id"), "custName")
    flag = F.when(F.col("custName") == "5-LOW", 1).when(F.col("custName").isNotNull(), 0)
    splits = hot_keys({"dim": (t.dim(), "cust_id")}, nulls=True)
    joined = enrich(t.dim(), [relation], "cust_id", splits["dim"])
    return joined.select("cust_id", flag.alias("t1")).withColumn("label", C.yes_no_label(F.col("t1"), "有", "无"))


@query(
    "fn_safe_date",
    "SELECT ent_id, modify_time, TRY_CAST(modify_time AS DATE) AS day FROM promotion",
    "promotion",
)
def fn_safe_date(t: Tables) -> DataFrame:
    return t.promotion().select("ent_id", "modify_time", C.safe_date(F.col("modify_time")).alias("day"))


@query(
    "fn_hash_bucket",
    """SELECT c_name, CAST(abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 4 AS INTEGER) AS bucket
       FROM (SELECT c_name, list_reduce(
                 list_prepend(CAST(0 AS BIGINT), list_transform(string_split(c_name, ''), lambda c: CAST(ord(c) AS BIGINT))),
                 lambda a, b: (a * 31 + b) % 4294967296) AS h FROM customer) AS s""",
)
def fn_hash_bucket(t: Tables) -> DataFrame:
    return t.read("customer").select("c_name", C.java_hash_bucket(F.col("c_name"), 4).alias("bucket"))


@query(
    "fn_split",
    """SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS lines,
              string_split(text, chr(10))[1] AS first_line FROM documents""",
)
def fn_split(t: Tables) -> DataFrame:
    lines = F.split("text", "\n")
    return t.read("documents").select(
        "doc_id", F.size(lines).alias("lines"), F.get(lines, F.lit(0)).alias("first_line")
    )


@query("fn_previous_day", "SELECT o_orderkey, CAST(o_orderdate AS DATE) - 1 AS day FROM orders")
def fn_previous_day(t: Tables) -> DataFrame:
    return t.read("orders").select("o_orderkey", C.previous_day(F.col("o_orderdate")).alias("day"))


@query("fn_format_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time FROM events")
def fn_format_ts(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", C.format_timestamp(F.col("ts")).alias("time"))


# --- batches, partitioning, reuse, SQL text


@query(
    "udf_map_partitions",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE '' END AS status
       FROM orders""",
)
def udf_map_partitions(t: Tables) -> DataFrame:
    names = {"F": "finished", "O": "open"}

    def decode(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {"o_orderkey": batch["o_orderkey"], "status": batch["o_orderstatus"].map(names).fillna("")}
        )

    orders = t.read("orders").select("o_orderkey", "o_orderstatus")
    return map_batches(orders, decode, "o_orderkey bigint, status string")


@query("phy_repartition", "SELECT o_custkey, COUNT(*) AS orders, CAST(1 AS BIGINT) AS places FROM orders GROUP BY o_custkey")
def phy_repartition(t: Tables) -> DataFrame:
    """Counts of a customer meet in one partition, so adding them up there needs no further shuffle.

    Orders are counted within each file part first, so that a customer with very many sends a few rows.
    """
    part = t.read("orders").select("o_custkey", F.spark_partition_id().alias("part"))
    counts = part.groupBy("o_custkey", "part").agg(F.count(F.lit(1)).alias("n"))
    placed = counts.repartition(shuffle_width(t.spark), "o_custkey").withColumn("place", F.spark_partition_id())
    return placed.groupBy("o_custkey").agg(F.sum("n").alias("orders"), F.countDistinct("place").alias("places"))


@query(
    "phy_persist",
    """SELECT 'status' AS kind, o_orderstatus AS value, COUNT(*) AS orders FROM orders GROUP BY o_orderstatus
       UNION ALL SELECT 'priority', o_orderpriority, COUNT(*) FROM orders GROUP BY o_orderpriority""",
)
def phy_persist(t: Tables) -> DataFrame:
    """Two results are written from one kept frame."""
    path = work_folder(t.spark)
    with persisted(t.read("orders").select("o_orderstatus", "o_orderpriority")) as orders:
        for kind, column in (("status", "o_orderstatus"), ("priority", "o_orderpriority")):
            counts = orders.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("orders"))
            sinks.write_new(counts.select(F.lit(kind).alias("kind"), "value", "orders"), f"{path}/{kind}")
    return t.spark.read.parquet(f"{path}/status", f"{path}/priority")


@query(
    "sql_view_cte",
    """WITH counted AS (SELECT o_custkey, COUNT(*) AS orders FROM orders GROUP BY o_custkey)
       SELECT orders, COUNT(*) AS customers FROM counted GROUP BY orders""",
)
def sql_view_cte(t: Tables) -> DataFrame:
    return t.spark.sql(
        """WITH counted AS (SELECT o_custkey, count(*) AS orders FROM {orders} GROUP BY o_custkey)
           SELECT orders, count(*) AS customers FROM counted GROUP BY orders""",
        orders=t.read("orders"),
    )
