"""The composed jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagtable.operators.skew import ROWS_PER_TASK, hot_keys
from tagtable.plans.customer_tags import customer_tags
from tagtable.plans.decode_preview import decode_names, decode_preview
from tagtable.plans.extract import load_customer_extract
from tagtable.plans.latest_campaigns import build_latest_campaigns, latest_campaigns, measure_links
from tagtable.plans.relation import build_matched_source, pick_relation
from tagtable.plans.snapshots import refresh_inputs
from tagtable.session import shuffle_width, work_folder
from tagtable.specs import FREE, HAS, IS, MULTI_CODE, SINGLE_CODE
from tagtable.workload.registry import query
from tagtable.workload.relational import tag_sql, wide
from tagtable.workload.tables import RUN_DATE, Tables

WIDE_COLUMNS = (
    'cust_id, "createDate", "custNameCn", t1, t2, t3, t4, t5, t6, reg_caps2, '
    "estimate_date, cnei_code, cnei_sec_code, province_code, city_code, county_code"
)


@query("job_relation", "SELECT * FROM relation", "relation")
def job_relation(t: Tables) -> DataFrame:
    return pick_relation(t.relation_rows())


@query("job_source", "SELECT * FROM source", "source")
def job_source(t: Tables) -> DataFrame:
    return build_matched_source(t.dim(), t.relation_rows(), partitions=shuffle_width(t.spark))


@query("job_customer_wide", f"SELECT {WIDE_COLUMNS} FROM wide", "wide")
def job_customer_wide(t: Tables) -> DataFrame:
    return wide(t)


@query(
    "job_customer_tags",
    " UNION ALL ".join(tag_sql(k) for k in (HAS, IS, MULTI_CODE, SINGLE_CODE, FREE)),
    "wide",
    "list_names",
    "dictionary",
)
def job_customer_tags(t: Tables) -> DataFrame:
    return customer_tags(wide(t), t.book(), t.book(), RUN_DATE)


CAMPAIGNS = """
    SELECT cust_id AS "CUST_ID", popu_plat AS "POPU_PLAT", popu_type AS "POPU_TYPE", sem_url AS "SEM_URL",
           day AS "RELEASE_TIME",
           COALESCE(string_agg(DISTINCT popu_keyword, ',' ORDER BY popu_keyword), '') AS "POPU_KEYWORD_LIST",
           '2024-01-31' AS "DATA_DATE"
    FROM (SELECT cust_id, popu_plat, popu_type, sem_url, popu_keyword, TRY_CAST(modify_time AS DATE) AS day,
                 rank() OVER (PARTITION BY cust_id ORDER BY TRY_CAST(modify_time AS DATE) DESC NULLS LAST) AS rk
          FROM {source} AS s JOIN promotion AS p ON s.ent_id = p.ent_id) AS r
    WHERE rk = 1 GROUP BY 1, 2, 3, 4, 5"""


@query("job_latest_campaigns", CAMPAIGNS.format(source="shared_source"), "shared_source", "promotion")
def job_latest_campaigns(t: Tables) -> DataFrame:
    return build_latest_campaigns(t.dim(), t.shared_relation_rows(), t.promotion(), RUN_DATE)


@query("job_latest_campaigns_many", CAMPAIGNS.format(source="many_source"), "many_source", "promotion")
def job_latest_campaigns_many(t: Tables, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Customers with several enterprises: the latest day is picked among all of them."""
    source = t.read("orders").selectExpr(
        "cast(o_custkey as string) as cust_id", "cast(o_orderkey as string) as ent_id"
    )
    promotion = t.promotion()
    keyed = {"source": (source, "ent_id"), "promotion": (promotion, "ent_id"), "customer": (source, "cust_id")}
    splits = hot_keys(keyed, rows_per_task)
    grid = measure_links(source, promotion, splits["promotion"], rows_per_task)
    return latest_campaigns(source, promotion, RUN_DATE, splits=splits, grid=grid)


@query("job_campaigns_from_snapshots", CAMPAIGNS.format(source="shared_source"), "shared_source", "promotion")
def job_campaigns_from_snapshots(t: Tables) -> DataFrame:
    """Customers with their enterprise, and promotions that name one, are extracted first."""
    inputs = {
        "source": build_matched_source(t.dim(), t.shared_relation_rows()),
        "promotion": t.promotion().where(F.col("ent_id").isNotNull()),
    }
    taken = refresh_inputs(inputs, work_folder(t.spark), "2024-01-31")
    splits = hot_keys({"promotion": (taken["promotion"], "ent_id")})
    grid = measure_links(taken["source"], taken["promotion"], splits["promotion"])
    return latest_campaigns(taken["source"], taken["promotion"], RUN_DATE, one_enterprise=True, splits=splits, grid=grid)


DECODED = """
    SELECT ent_id, t1, 0 AS t2, 0 AS t3, 0 AS t4, 0 AS t5, t6, reg_caps2, estimate_date,
           COALESCE((SELECT name FROM dictionary WHERE code = cnei_code), '') AS cnei,
           COALESCE((SELECT name FROM dictionary WHERE code = cnei_sec_code), '') AS cnei_sec,
           COALESCE((SELECT name FROM dictionary WHERE code = province_code), '') AS province,
           COALESCE((SELECT name FROM dictionary WHERE code = city_code), '') AS city,
           COALESCE((SELECT name FROM dictionary WHERE code = county_code), '') AS county
    FROM (SELECT CAST(o_orderkey AS VARCHAR) AS ent_id, CAST(o_orderstatus = 'F' AS INTEGER) AS t1,
                 CAST(o_orderpriority = '5-LOW' AS INTEGER) AS t6, o_orderpriority AS reg_caps2,
                 strftime(o_orderdate, '%Y-%m-%d') AS estimate_date,
                 'N' || c_nationkey AS cnei_code, 'X' || c_nationkey AS cnei_sec_code,
                 'R' || (SELECT n_regionkey FROM nation WHERE n_nationkey = c_nationkey) AS province_code,
                 'N' || c_nationkey AS city_code,
                 CASE WHEN c_mktsegment = 'BUILDING' THEN 'N' || c_nationkey END AS county_code
          FROM orders JOIN customer ON o_custkey = c_custkey) AS coded"""


def _coded(t: Tables) -> DataFrame:
    nation = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    return (
        t.read("orders")
        .join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("ent_id"),
            (F.col("o_orderstatus") == "F").cast("int").alias("t1"),
            *[F.lit(0).alias(f"t{i}") for i in range(2, 6)],
            (F.col("o_orderpriority") == "5-LOW").cast("int").alias("t6"),
            F.col("o_orderpriority").alias("reg_caps2"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("estimate_date"),
            nation.alias("cnei_code"),
            F.concat(F.lit("X"), F.col("c_nationkey").cast("string")).alias("cnei_sec_code"),
            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("province_code"),
            nation.alias("city_code"),
            F.when(F.col("c_mktsegment") == "BUILDING", nation).alias("county_code"),
        )
    )


@query("job_decode_names", DECODED, "dictionary")
def job_decode_names(t: Tables) -> DataFrame:
    """All rows decoded, before the filter and the preview."""
    return decode_names(_coded(t), t.book(), t.book())


@query(
    "job_decode_preview",
    f"SELECT * FROM ({DECODED}) AS d WHERE instr(cnei, 'NATION_1') >= 1 ORDER BY ent_id LIMIT 20",
    "dictionary",
)
def job_decode_preview(t: Tables) -> DataFrame:
    return decode_preview(_coded(t), t.book(), t.book(), "NATION_1")


@query(
    "job_extract",
    """SELECT CAST(c_custkey AS VARCHAR) AS "custId", c_name AS "custNameCn", c_mktsegment AS "createDate",
              "entId" FROM customer LEFT JOIN relation_rows ON CAST(c_custkey AS VARCHAR) = "custId" """,
    "relation_rows",
)
def job_extract(t: Tables, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    master = t.read("customer").selectExpr(
        "cast(c_custkey as string) as custId", "c_name as custNameCn", "c_mktsegment as createDate"
    )
    path = work_folder(t.spark)
    load_customer_extract(master.select("custId"), master, t.relation_rows(), path, rows_per_task)
    return t.spark.read.parquet(path)
