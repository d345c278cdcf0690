"""The logical input tables, built from the test tables: as DataFrames and, for the checks, as SQL.

The rules put in what the operators must cope with: blank and missing keys, missing times, unknown codes,
code lists with leading and trailing separators, malformed dates, several attribute rows per enterprise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tagtable.functions.columns import format_timestamp
from tagtable.sources.dictionary import CodeBook

RUN_DATE = "2024-02-01"
SCOPE_TEXT = "BUILD"
SEPARATOR = "\u0002"


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}
        self._book: CodeBook | None = None

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def dim(self) -> DataFrame:
        return self.read("customer").select(_text("c_custkey").alias("cust_id"))

    def relation_rows(self) -> DataFrame:
        status = F.col("o_orderstatus")
        time = format_timestamp(F.col("o_orderdate"))
        return self.read("orders").select(
            _text("o_custkey").alias("custId"),
            F.when(status == "F", _text("o_orderkey")).when(status == "O", "").alias("entId"),
            time.alias("createTime"),
            F.col("o_orderpriority").alias("custName"),
            F.when(F.col("o_orderpriority") != "1-URGENT", time).alias("updateTime"),
        )

    def facts(self) -> dict[str, DataFrame]:
        key = F.when(F.col("l_linenumber") != 7, _text("l_orderkey")).alias("ent_id")
        rules = {
            "t1": F.col("l_returnflag") == "R",
            "t2": F.col("l_returnflag") == "A",
            "t3": F.col("l_linestatus") == "O",
            "t4": F.col("l_discount") >= 0.09,
            "t5": F.col("l_tax") >= 0.08,
        }
        return {name: self.read("lineitem").where(rule).select(key) for name, rule in rules.items()}

    def capital(self) -> DataFrame:
        value = F.when(F.col("l_linestatus") == "O", "100").otherwise("500")
        return self.read("lineitem").select(_text("l_orderkey").alias("ent_id"), value.alias("reg_caps2"))

    def base_info(self) -> DataFrame:
        region = F.concat(F.lit("R"), _text("n_regionkey"))
        nation = F.concat(F.lit("N"), _text("n_nationkey"))
        sep = F.lit(SEPARATOR)
        priority = F.col("o_orderpriority")
        second = (
            F.when(priority == "1-URGENT", F.concat(nation, sep, F.lit("X"), sep, region))
            .when(priority == "2-HIGH", F.concat(sep, region))
            .when(priority == "3-MEDIUM", "")
            .when(priority == "5-LOW", F.concat(region, sep, nation, sep))
        )
        segment = F.col("c_mktsegment")
        return (
            self.read("orders")
            .join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _text("o_orderkey").alias("ent_id"),
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("estimate_date"),
                F.concat(region, sep, nation).alias("cnei_code"),
                second.alias("cnei_sec_code"),
                region.alias("province_code"),
                nation.alias("city_code"),
                F.when(priority != "5-LOW", F.concat(F.lit("C"), _text("n_nationkey"))).alias("county_code"),
                F.when(segment != "MACHINERY", segment).alias("oper_scope"),
            )
        )

    def dictionary(self) -> DataFrame:
        regions = self.read("region")
        named = self.read("nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        name = F.when(F.col("n_name") == "NATION_7", "").otherwise(F.col("n_name"))
        nations = named.where(F.col("r_name") != "ASIA")
        return regions.selectExpr("concat('R', r_regionkey) AS code", "r_name AS name").unionAll(
            nations.select(F.concat(F.lit("N"), _text("n_nationkey")), name)
        )

    def book(self) -> CodeBook:
        self._book = self._book or CodeBook(self.dictionary())
        return self._book

    def promotion(self) -> DataFrame:
        event = F.col("event_type")
        value = F.col("value")
        return self.read("events").select(
            _text("user_id").alias("ent_id"),
            F.when(event != "error", F.col("props")).alias("popu_keyword"),
            event.alias("popu_plat"),
            F.when(value >= 10, "high").otherwise("low").alias("popu_type"),
            F.concat(F.lit("/"), event).alias("sem_url"),
            F.when(value < 1, "n/a").otherwise(format_timestamp(F.col("ts"))).alias("modify_time"),
        )

    def shared_relation_rows(self) -> DataFrame:
        """Many customers per enterprise: those of a nation share one, but for one market segment."""
        enterprise = F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_custkey")).otherwise(
            F.col("c_nationkey").cast("bigint")
        )
        return self.read("customer").select(
            _text("c_custkey").alias("custId"),
            enterprise.cast("string").alias("entId"),
            F.lit("2020-01-01").alias("createTime"),
            F.col("c_name").alias("custName"),
            F.lit("2020-01-01").alias("updateTime"),
        )


def _text(column: str) -> Column:
    return F.col(column).cast("string")


# The same tables for the checking database, by name; each may use those before it.
SQL_TABLES = {
    "dim": "SELECT CAST(c_custkey AS VARCHAR) AS cust_id FROM customer",
    "relation_rows": """
        SELECT CAST(o_custkey AS VARCHAR) AS "custId",
               CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS VARCHAR) WHEN 'O' THEN '' END AS "entId",
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "createTime",
               o_orderpriority AS "custName",
               CASE WHEN o_orderpriority <> '1-URGENT'
                    THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS "updateTime"
        FROM orders""",
    "relation": """
        SELECT "custId", "entId", "createTime", "custName" FROM (
            SELECT *, row_number() OVER (
                PARTITION BY "custId"
                ORDER BY "updateTime" ASC NULLS LAST, "entId", "createTime", "custName") AS place
            FROM relation_rows WHERE "entId" <> '' AND "entId" IS NOT NULL) AS p
        WHERE place = 1""",
    "source": """
        SELECT d.cust_id, r."entId" AS ent_id, r."createTime" AS "createDate", r."custName" AS "custNameCn"
        FROM dim d JOIN relation r ON d.cust_id = r."custId" """,
    "marks": """
        SELECT CAST(l_orderkey AS VARCHAR) AS ent_id,
               MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS t1,
               MAX(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS t2,
               MAX(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS t3,
               MAX(CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END) AS t4,
               MAX(CASE WHEN l_tax >= 0.08 THEN 1 ELSE 0 END) AS t5
        FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1""",
    "capital": """
        SELECT CAST(l_orderkey AS VARCHAR) AS ent_id,
               CASE WHEN l_linestatus = 'O' THEN '100' ELSE '500' END AS reg_caps2
        FROM lineitem""",
    "base_info": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ent_id,
               strftime(o_orderdate, '%Y-%m-%d') AS estimate_date,
               'R' || n_regionkey || chr(2) || 'N' || n_nationkey AS cnei_code,
               CASE o_orderpriority
                   WHEN '1-URGENT' THEN 'N' || n_nationkey || chr(2) || 'X' || chr(2) || 'R' || n_regionkey
                   WHEN '2-HIGH' THEN chr(2) || 'R' || n_regionkey
                   WHEN '3-MEDIUM' THEN ''
                   WHEN '5-LOW' THEN 'R' || n_regionkey || chr(2) || 'N' || n_nationkey || chr(2)
               END AS cnei_sec_code,
               'R' || n_regionkey AS province_code,
               'N' || n_nationkey AS city_code,
               CASE WHEN o_orderpriority <> '5-LOW' THEN 'C' || n_nationkey END AS county_code,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS oper_scope
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "dictionary": """
        SELECT 'R' || r_regionkey AS code, r_name AS name FROM region
        UNION ALL
        SELECT 'N' || n_nationkey, CASE WHEN n_name = 'NATION_7' THEN '' ELSE n_name END
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'""",
    "wide": """
        SELECT d.cust_id, r."createTime" AS "createDate", r."custName" AS "custNameCn",
               CASE WHEN r."custId" IS NOT NULL THEN COALESCE(m.t1, 0) END AS t1,
               CASE WHEN r."custId" IS NOT NULL THEN COALESCE(m.t2, 0) END AS t2,
               CASE WHEN r."custId" IS NOT NULL THEN COALESCE(m.t3, 0) END AS t3,
               CASE WHEN r."custId" IS NOT NULL THEN COALESCE(m.t4, 0) END AS t4,
               CASE WHEN r."custId" IS NOT NULL THEN COALESCE(m.t5, 0) END AS t5,
               CASE WHEN r."custId" IS NULL THEN NULL
                    WHEN instr(b.oper_scope, 'BUILD') > 0 THEN 1 ELSE 0 END AS t6,
               c.reg_caps2, b.estimate_date, b.cnei_code, b.cnei_sec_code,
               b.province_code, b.city_code, b.county_code
        FROM dim d
        LEFT JOIN relation r ON d.cust_id = r."custId"
        LEFT JOIN marks m ON r."entId" = m.ent_id
        LEFT JOIN (SELECT DISTINCT ent_id, reg_caps2 FROM capital) c ON r."entId" = c.ent_id
        LEFT JOIN base_info b ON r."entId" = b.ent_id""",
    "promotion": """
        SELECT CAST(user_id AS VARCHAR) AS ent_id,
               CASE WHEN event_type <> 'error' THEN props END AS popu_keyword,
               event_type AS popu_plat,
               CASE WHEN value >= 10 THEN 'high' ELSE 'low' END AS popu_type,
               '/' || event_type AS sem_url,
               CASE WHEN value < 1 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS modify_time
        FROM events""",
    "shared_source": """
        SELECT CAST(c_custkey AS VARCHAR) AS cust_id,
               CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey ELSE c_nationkey END AS VARCHAR) AS ent_id
        FROM customer""",
    "many_source": """
        SELECT CAST(o_custkey AS VARCHAR) AS cust_id, CAST(o_orderkey AS VARCHAR) AS ent_id FROM orders""",
    # code lists of base_info, looked up piece by piece
    "code_lists": "SELECT cnei_code AS codes FROM base_info UNION SELECT cnei_sec_code FROM base_info",
    "looked_up": """
        SELECT codes, place, name, SUM(CASE WHEN name IS NULL THEN 1 ELSE 0 END)
                   OVER (PARTITION BY codes ORDER BY place) AS unknown_so_far
        FROM (
            SELECT codes, unnest(pieces) AS code, unnest(range(1, len(pieces) + 1)) AS place
            FROM (SELECT codes, string_split(rtrim(codes, chr(2)), chr(2)) AS pieces
                  FROM code_lists WHERE codes IS NOT NULL) AS s
        ) AS p LEFT JOIN dictionary USING (code)""",
    "list_names": """
        SELECT codes,
               COALESCE(string_agg(name, ',' ORDER BY place) FILTER (unknown_so_far = 0 AND name <> ''), '')
               || CASE WHEN MAX(unknown_so_far) > 0
                            AND COUNT(*) FILTER (unknown_so_far = 0 AND name <> '') > 0
                       THEN ',' ELSE '' END AS cut_names,
               COALESCE(string_agg(name, ',' ORDER BY place) FILTER (name <> ''), '') AS known_names
        FROM looked_up GROUP BY codes""",
}


def with_tables(query: str, *names: str) -> str:
    """A query preceded by the tables it names and those that these use."""
    order = list(SQL_TABLES)
    needed: set[str] = set()
    pending = list(names)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            body = SQL_TABLES[name]
            pending += [other for other in order[: order.index(name)] if _mentions(body, other)]
    parts = [f"{n} AS ({SQL_TABLES[n]})" for n in order if n in needed]
    return f"WITH {', '.join(parts)} {query}"


def _mentions(sql: str, table: str) -> bool:
    words = sql.replace("(", " ").replace(")", " ").split()
    return any(w == table and words[i - 1].upper() in ("FROM", "JOIN") for i, w in enumerate(words))
