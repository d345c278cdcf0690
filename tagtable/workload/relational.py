"""Joins, aggregates, windows, set and reshape operators, decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagtable.functions import decode
from tagtable.operators import joins, perkey, tags
from tagtable.operators.skew import ROWS_PER_TASK, hot_keys, measure_grid
from tagtable.plans.customer_wide import build_customer_wide
from tagtable.plans.relation import pick_relation
from tagtable.specs import FREE, HAS, IS, MULTI_CODE, SINGLE_CODE, TAGS
from tagtable.workload.registry import query
from tagtable.workload.tables import SCOPE_TEXT, Tables

# --- joins


@query(
    "join_left",
    'SELECT d.cust_id, r."entId", r."createTime" FROM dim d LEFT JOIN relation r ON d.cust_id = r."custId"',
    "dim",
    "relation",
)
def join_left(t: Tables) -> DataFrame:
    relation = pick_relation(t.relation_rows()).select(F.col("custId").alias("cust_id"), "entId", "createTime")
    splits = hot_keys({"dim": (t.dim(), "cust_id")}, nulls=True)
    return joins.enrich(t.dim(), [relation], "cust_id", splits["dim"])


@query(
    "join_left_using",
    """SELECT ent_id, reg_caps2, estimate_date
       FROM (SELECT DISTINCT ent_id, reg_caps2 FROM capital) AS c LEFT JOIN base_info USING (ent_id)""",
    "capital",
    "base_info",
)
def join_left_using(t: Tables, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    capital = t.capital().distinct()
    base = t.base_info().select("ent_id", "estimate_date")
    return joins.enrich(capital, [base], "ent_id", grid=measure_grid(capital, [base], "ent_id", rows_per_task, nulls=True))


@query(
    "join_matched",
    "SELECT s.cust_id, s.ent_id, p.popu_plat, p.modify_time FROM shared_source s JOIN promotion p ON s.ent_id = p.ent_id",
    "shared_source",
    "promotion",
)
def join_matched(t: Tables, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    source = t.shared_relation_rows().selectExpr("custId as cust_id", "entId as ent_id")
    promotion = t.promotion().select("ent_id", "popu_plat", "modify_time")
    found = joins.matched(source, promotion, "ent_id", grid=measure_grid(source, [promotion], "ent_id", rows_per_task))
    return found.select("cust_id", "ent_id", "popu_plat", "modify_time")


@query(
    "join_presence_flags",
    """SELECT s.cust_id, s.ent_id, COALESCE(t1, 0) AS t1, COALESCE(t2, 0) AS t2, COALESCE(t3, 0) AS t3,
              COALESCE(t4, 0) AS t4, COALESCE(t5, 0) AS t5
       FROM many_source s LEFT JOIN marks m ON s.ent_id = m.ent_id""",
    "many_source",
    "marks",
)
def join_presence_flags(t: Tables) -> DataFrame:
    source = _many_source(t)
    splits = hot_keys({"source": (source, "ent_id")}, nulls=True)
    return joins.presence_flags(source, t.facts(), "ent_id", splits["source"])


@query(
    "join_enrich_chain",
    """SELECT s.cust_id, s.ent_id, c.reg_caps2, b.province_code, b.city_code FROM many_source s
       LEFT JOIN (SELECT DISTINCT ent_id, reg_caps2 FROM capital) c ON s.ent_id = c.ent_id
       LEFT JOIN base_info b ON s.ent_id = b.ent_id""",
    "many_source",
    "capital",
    "base_info",
)
def join_enrich_chain(t: Tables, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    source, capital = _many_source(t), t.capital().distinct()
    base = t.base_info().select("ent_id", "province_code", "city_code")
    grid = measure_grid(source, [capital, base], "ent_id", rows_per_task, nulls=True)
    return joins.enrich(source, [capital, base], "ent_id", grid=grid)


@query(
    "join_full_population",
    'SELECT d.cust_id, r."entId" AS ent_id, r."custName" AS "custNameCn", n.found FROM dim d LEFT JOIN relation r ON d.cust_id = r."custId" LEFT JOIN (SELECT cust_id, COUNT(*) AS found FROM source GROUP BY cust_id) n ON d.cust_id = n.cust_id',
    "dim",
    "relation",
    "source",
)
def join_full_population(t: Tables) -> DataFrame:
    """Every customer, with what is known of those that have an enterprise."""
    relation = pick_relation(t.relation_rows())
    known = relation.groupBy(F.col("custId").alias("cust_id")).agg(
        F.max("entId").alias("ent_id"), F.max("custName").alias("custNameCn"), F.count(F.lit(1)).alias("found")
    )
    splits = hot_keys({"dim": (t.dim(), "cust_id")}, nulls=True)
    return joins.enrich(t.dim(), [known], "cust_id", splits["dim"])


@query(
    "join_broadcast",
    """SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey""",
)
def join_broadcast(t: Tables) -> DataFrame:
    """Small sides are broadcast by Spark's own check of their size; grown ones would be shuffled."""
    nation = t.read("nation").join(t.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = t.read("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "n_name", "r_name")


@query(
    "join_lookup_default",
    """SELECT ent_id, city_code, COALESCE(name, '') AS city
       FROM base_info LEFT JOIN dictionary ON city_code = code""",
    "base_info",
    "dictionary",
)
def join_lookup_default(t: Tables) -> DataFrame:
    return joins.lookup_default(t.base_info().select("ent_id", "city_code"), "city_code", t.book(), "city")


def _many_source(t: Tables) -> DataFrame:
    return t.read("orders").selectExpr(
        "cast(o_custkey as string) as cust_id", "cast(o_orderkey as string) as ent_id"
    )


# --- aggregates


@query(
    "agg_distinct_key",
    "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS ent_id FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber <> 7",
)
def agg_distinct_key(t: Tables) -> DataFrame:
    return perkey.distinct_keys(t.facts()["t1"], "ent_id")


@query("agg_distinct_pair", "SELECT DISTINCT ent_id, reg_caps2 FROM capital", "capital")
def agg_distinct_pair(t: Tables) -> DataFrame:
    return perkey.distinct_keys(t.capital(), "ent_id", "reg_caps2")


@query(
    "agg_string_set",
    """SELECT ent_id, popu_plat, popu_type, sem_url, TRY_CAST(modify_time AS DATE) AS day,
              COALESCE(string_agg(DISTINCT popu_keyword, ',' ORDER BY popu_keyword), '') AS keywords
       FROM promotion GROUP BY 1, 2, 3, 4, 5""",
    "promotion",
)
def agg_string_set(t: Tables) -> DataFrame:
    rows = t.promotion().withColumn("day", F.col("modify_time").try_cast("date"))
    keys = ["ent_id", "popu_plat", "popu_type", "sem_url", "day"]
    sets = perkey.string_set(rows, keys, "popu_keyword", "keywords")
    return sets.withColumn("keywords", F.concat_ws(",", "keywords"))


# --- windows and order


@query(
    "win_rank",
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CAST(rank() OVER (
           PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC NULLS LAST) AS BIGINT) AS rk FROM orders""",
)
def win_rank(t: Tables, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    orders = t.read("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    splits = hot_keys({"orders": (orders, "o_custkey")}, rows_per_task, nulls=True)
    return perkey.ranked(orders, "o_custkey", "day", splits=splits["orders"])


@query(
    "win_latest_rank",
    """SELECT event_id, user_id, event_type, day FROM (
           SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, rank() OVER (
               PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC NULLS LAST) AS rk FROM events) AS r
       WHERE rk = 1""",
)
def win_latest_rank(t: Tables, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    events = t.read("events").select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"))
    splits = hot_keys({"events": (events, "user_id")}, rows_per_task, nulls=True)
    return perkey.latest_rows(events, "user_id", "day", splits["events"])


@query(
    "top_limit_by",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
           SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS LAST, o_orderkey) AS place
           FROM orders) AS p WHERE place <= 3""",
)
def top_limit_by(t: Tables) -> DataFrame:
    order = [F.asc_nulls_last("o_orderdate"), F.col("o_orderkey")]
    return perkey.limit_by(t.read("orders"), ["o_custkey"], order, 3).select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )


@query(
    "top_limit_by_many",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 5000""",
)
def top_limit_by_many(t: Tables) -> DataFrame:
    """Many first rows of a few large keys, which no single task ranks."""
    rows = t.read("lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")]
    return perkey.limit_by(rows, ["l_returnflag"], order, 5000)


@query(
    "srt_order_by",
    """SELECT "custId", "entId", "updateTime" FROM relation_rows
       ORDER BY "updateTime" ASC NULLS LAST, "custId", "entId" """,
    "relation_rows",
)
def srt_order_by(t: Tables) -> DataFrame:
    rows = t.relation_rows().select("custId", "entId", "updateTime")
    return rows.orderBy(F.asc_nulls_last("updateTime"), "custId", F.asc_nulls_last("entId"))


# --- tag rows


def _tag_rows(columns: dict[str, str], label: str) -> str:
    """SQL for the tags of some columns: code, value and the given label, one branch per column."""
    branches = [
        f"""SELECT cust_id AS "CUST_ID", '{code}' AS "TAG_CODE", CAST({column} AS VARCHAR) AS "TAG_VALUE",
            {label.format(column)} AS "TAG_VALUE_NAME", '2024-01-31' AS "DATA_DATE" FROM {{table}}"""
        for column, code in columns.items()
    ]
    return " UNION ALL ".join(branches)


CODES = {s.column: s.code for s in TAGS}
HAS_LABEL = "CASE {0} WHEN 1 THEN '有' WHEN 0 THEN '无' END"
IS_LABEL = "CASE {0} WHEN 1 THEN '是' WHEN 0 THEN '否' END"
LIST_LABEL = "COALESCE((SELECT cut_names FROM list_names WHERE codes = {0}), '')"
CODE_LABEL = "COALESCE((SELECT name FROM dictionary WHERE code = {0}), '')"
NO_LABEL = "CAST(NULL AS VARCHAR)"


def tag_sql(kind: str, table: str = "wide") -> str:
    labels = {HAS: HAS_LABEL, IS: IS_LABEL, MULTI_CODE: LIST_LABEL, SINGLE_CODE: CODE_LABEL, FREE: NO_LABEL}
    columns = {}
    for spec in TAGS:
        if spec.kind == kind:
            columns[f'"{spec.column}"'] = spec.code
    return _tag_rows(columns, labels[kind]).format(table=table)


def wide(t: Tables, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    inputs = (t.dim(), t.relation_rows(), t.facts(), t.capital(), t.base_info())
    return build_customer_wide(*inputs, SCOPE_TEXT, rows_per_task)


def _tags_of(t: Tables, kind: str) -> DataFrame:
    specs = [s for s in TAGS if s.kind == kind]
    book = t.book() if kind in (MULTI_CODE, SINGLE_CODE) else None
    return tags.emit_tags(wide(t), "cust_id", "2024-01-31", book, book, specs)


@query("tag_flag_has", tag_sql(HAS), "wide")
def tag_flag_has(t: Tables) -> DataFrame:
    return _tags_of(t, HAS)


@query("tag_flag_is", tag_sql(IS), "wide")
def tag_flag_is(t: Tables) -> DataFrame:
    return _tags_of(t, IS)


@query("tag_multi_code", tag_sql(MULTI_CODE), "wide", "list_names")
def tag_multi_code(t: Tables) -> DataFrame:
    return _tags_of(t, MULTI_CODE)


@query("tag_single_code", tag_sql(SINGLE_CODE), "wide", "dictionary")
def tag_single_code(t: Tables) -> DataFrame:
    return _tags_of(t, SINGLE_CODE)


@query("tag_free_value", tag_sql(FREE), "wide")
def tag_free_value(t: Tables) -> DataFrame:
    return _tags_of(t, FREE)


@query(
    "set_union_all",
    f"""SELECT "CUST_ID", "TAG_CODE", "TAG_VALUE", "TAG_VALUE_NAME" FROM ({tag_sql(HAS)}) AS a
        UNION ALL SELECT "CUST_ID", "TAG_CODE", "TAG_VALUE", "TAG_VALUE_NAME" FROM ({tag_sql(FREE)}) AS b""",
    "wide",
)
def set_union_all(t: Tables) -> DataFrame:
    """The rows of both kinds of tags; one pass over the wide table takes the place of a union of two."""
    specs = [s for s in TAGS if s.kind in (HAS, FREE)]
    both = tags.emit_tags(wide(t), "cust_id", "2024-01-31", specs=specs)
    return both.select("CUST_ID", "TAG_CODE", "TAG_VALUE", "TAG_VALUE_NAME")


@query(
    "rsh_unpivot",
    " UNION ALL ".join(
        f"""SELECT cust_id AS "CUST_ID", '{s.code}' AS "TAG_CODE", CAST("{s.column}" AS VARCHAR) AS "TAG_VALUE" FROM wide"""
        for s in TAGS
    ),
    "wide",
)
def rsh_unpivot(t: Tables) -> DataFrame:
    return tags.unpivot_tags(wide(t), "cust_id")


@query(
    "tag_code_map",
    """SELECT DISTINCT p_type AS kind, p_brand AS col,
              CASE p_brand """
    + " ".join(f"WHEN 'Brand#{i}' THEN '{s.code}'" for i, s in enumerate(TAGS, 11))
    + " END AS code FROM part",
)
def tag_code_map(t: Tables) -> DataFrame:
    """Brands stand in for tag columns."""
    specs = [type(s)(f"Brand#{i}", s.code, s.kind) for i, s in enumerate(TAGS, 11)]
    parts = t.read("part").select(F.col("p_type").alias("kind"), F.col("p_brand").alias("col")).distinct()
    return parts.withColumn("code", tags.tag_code(F.col("col"), specs))


# --- decoding


@query("fn_decode_code", f"SELECT ent_id, city_code, {CODE_LABEL.format('city_code')} AS city FROM base_info", "base_info", "dictionary")
def fn_decode_code(t: Tables) -> DataFrame:
    return joins.lookup_default(t.base_info().select("ent_id", "city_code"), "city_code", t.book(), "city")


@query(
    "fn_decode_codes",
    """SELECT ent_id, cnei_sec_code, COALESCE(cut_names, '') AS cut_names, COALESCE(known_names, '') AS known_names
       FROM base_info LEFT JOIN list_names ON cnei_sec_code = codes""",
    "base_info",
    "list_names",
)
def fn_decode_codes(t: Tables) -> DataFrame:
    rows, book = t.base_info().select("ent_id", "cnei_sec_code"), t.book()
    for name, mode in (("cut_names", "truncate"), ("known_names", "skip")):
        rows = decode.with_code_list_names(rows, "cnei_sec_code", book, name, mode)
    return rows


@query("udf_decode_code", f"SELECT ent_id, {CODE_LABEL.format('county_code')} AS county, {CODE_LABEL.format('province_code')} AS province FROM base_info", "base_info", "dictionary")
def udf_decode_code(t: Tables) -> DataFrame:
    decode.register_decoders(t.spark, t.book(), t.book())
    return t.base_info().selectExpr(
        "ent_id", "decode_code(county_code) as county", "decode_code(province_code) as province"
    )


@query(
    "udf_decode_codes",
    """SELECT ent_id, COALESCE(a.cut_names, '') AS industry, COALESCE(b.cut_names, '') AS second_industry
       FROM base_info LEFT JOIN list_names a ON cnei_code = a.codes LEFT JOIN list_names b ON cnei_sec_code = b.codes""",
    "base_info",
    "list_names",
)
def udf_decode_codes(t: Tables) -> DataFrame:
    decode.register_decoders(t.spark, t.book(), t.book())
    return t.base_info().selectExpr(
        "ent_id", "decode_codes(cnei_code) as industry", "decode_codes(cnei_sec_code) as second_industry"
    )
