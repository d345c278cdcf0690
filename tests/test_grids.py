"""Grids of hot keys: keys that are heavy on two sides, many hot keys, and the jobs that use them."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tagtable.operators import perkey, skew
from tagtable.operators.joins import enrich, matched
from tagtable.plans.customer_wide import build_customer_wide, measure_enterprises
from tagtable.plans.extract import customer_extract
from tagtable.plans.latest_campaigns import build_latest_campaigns, latest_campaigns, measure_links


@pytest.fixture
def unmerged(spark):
    """Joins as those of large tables: without broadcasts, and with shuffle partitions apart, to count tasks with rows."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def tasks(frame):
    return [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]


def test_two_moderate_sides_meet_in_many_tasks(unmerged, frame):
    left = frame("key,a", [("k", str(i)) for i in range(900)] + [("x", "1")])
    right = frame("key,b", [("k", str(i)) for i in range(900)] + [("y", "1")])
    assert not skew.hot_keys({"l": (left, "key"), "r": (right, "key")}, 1000)["l"]
    grid = skew.measure_grid(left, [right], "key", 1000)
    ((key, g),) = [tuple(r) for r in grid.frame.collect()]
    assert key == "k" and g[0] * g[1] >= 810 and 900 / g[0] * 900 / g[1] <= 1000
    found = matched(left, right, "key", grid=grid)
    assert found.count() == 810_000 == found.distinct().count()
    made = tasks(found)
    assert len(made) == 8 and max(made) < 2 * min(made)


def sides(seed, keys=30, rows=120):
    rng = random.Random(seed)
    names = [f"k{i}" for i in range(keys)] + ["hot"] * keys + ["warm"] * 6
    some = lambda extra: [(rng.choice([*names, extra, None]), str(rng.randrange(40))) for _ in range(rows)]
    return some("only_left"), some("only_right"), some("other")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize(("seed", "limit"), [(1, 4), (2, 50), (3, 2000), (4, 10**9)])
def test_grid_join_equals_plain_join(frame, rows, how, seed, limit):
    a, b, c = sides(seed)
    left, right, third = frame("key,a", a), frame("key,b", b), frame("key,c", c[:40])
    grid = skew.measure_grid(left, [right, third], "key", limit, nulls=True)
    assert bool(grid) == (limit < 10**9)
    got = skew.join_chain(left, [right, third], "key", how, grid=grid)
    wanted = left.join(right, "key", how).join(third, "key", how)
    assert got.columns == ["key", "a", "b", "c"]
    assert rows(got) == rows(wanted)


def test_cells_are_bounded_and_small_sides_are_not_cut(spark):
    data = [("even", 3000, 3000, 1), ("left", 10**7, 1, 0), ("three", 700, 900, 800), ("low", 10, 10, 10), ("right", 0, 10**7, 0)]
    counts = spark.createDataFrame(data, "key string, n0 long, n1 long, n2 long")
    limit = 10_000
    found = {r["key"]: r["g"] for r in skew.grid_of_counts(counts, 3, limit).frame.collect()}
    assert set(found) == {"even", "left", "three", "right"}
    for key, *n in data:
        if key in found:
            cell = 1
            for rows_of, parts in zip(n, found[key], strict=True):
                cell *= max(1, rows_of / parts)
            assert cell <= limit * 1.001
    assert found["left"] == [1000, 1, 1] and found["right"] == [1, 1000, 1]


def test_rows_of_a_missing_key_are_spread(unmerged, frame):
    left = frame("key,a", [(None, str(i)) for i in range(400)] + [("k", "x")])
    grid = skew.measure_grid(left, [frame("key,b", [("k", "y")])], "key", 50, nulls=True)
    assert grid.frame is None and grid.nulls == 8
    got = skew.join_chain(left, [frame("key,b", [("k", "y")])], "key", "left", grid=grid)
    assert got.count() == 401 and len(tasks(got)) > 4


def test_zeros_of_both_signs_meet(spark):
    left = spark.createDataFrame([(0.0, i) for i in range(20)] + [(-0.0, i) for i in range(20)], "key double, a int")
    right = spark.createDataFrame([(-0.0, i) for i in range(10)], "key double, b int")
    grid = skew.measure_grid(left, [right], "key", 50)
    assert grid and skew.join_chain(left, [right], "key", "inner", grid=grid).count() == left.join(right, "key").count() == 400


def test_decimals_of_two_scales_meet(spark):
    left = spark.range(120).selectExpr("cast(id % 3 * 10 AS decimal(10, 1)) / 4 AS key", "id AS a").selectExpr("cast(key AS decimal(10, 1)) AS key", "a")
    right = spark.range(60).selectExpr("cast(cast(id % 3 * 10 AS decimal(10, 1)) / 4 AS decimal(12, 3)) AS key", "id AS b")
    grid = skew.measure_grid(left, [right], "key", 50)
    assert grid.frame.count() == 3
    assert skew.join_chain(left, [right], "key", "inner", grid=grid).count() == left.join(right, "key").count() == 2400


def test_fifty_thousand_hot_keys(spark, rows):
    left = spark.range(200_000).selectExpr("concat('k', id % 50000) AS key", "id AS a")
    right = spark.range(60_000).selectExpr("concat('k', id % 60000) AS key", "id AS b")
    start = time.time()
    grid = skew.measure_grid(left, [right], "key", 2)
    joined = skew.join_chain(left, [right], "key", "left", grid=grid)
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert time.time() - start < 30
    assert not grid.listed and grid.frame.count() == 50_000 and "k49999" not in text and len(text) < 50_000
    assert joined.agg(F.count("*"), F.count("b"), F.sum("a"), F.sum("b")).first() == (
        left.join(right, "key", "left").agg(F.count("*"), F.count("b"), F.sum("a"), F.sum("b")).first()
    )


def test_many_hot_keys_in_ranks(spark, monkeypatch, rows):
    monkeypatch.setattr(skew, "LISTED", 20)
    data = spark.range(3000).selectExpr("cast(id % 100 as string) AS key", "cast(id % 7 as string) AS day", "id AS v")
    data = data.unionByName(spark.range(50).selectExpr("cast(null as string) AS key", "if(id < 9, null, '3') AS day", "id AS v"))
    splits = skew.hot_keys({"d": (data, "key")}, 9, nulls=True)["d"]
    assert splits and not skew.is_listed(splits) and len(splits) == 101 and splits["7"] == 4 and splits[None] == 6
    assert rows(perkey.ranked(data, "key", "day", splits=splits)) == rows(perkey.ranked(data, "key", "day"))
    assert rows(perkey.latest_rows(data, "key", "day", splits)) == rows(perkey.latest_rows(data, "key", "day"))


PROMOTION = "ent_id,popu_keyword,popu_plat,popu_type,sem_url,modify_time"


def heavy_enterprise(frame, n=900):
    """An enterprise of many customers and many campaigns, none of which is many alone."""
    promotion = [("e", f"w{i % 3}", f"p{i}", "t", "u", "2024-01-05") for i in range(n)]
    promotion += [("e", "old", f"o{i}", "t", "u", "2024-01-04") for i in range(50)] + [("f", "w", "p", "t", "u", "2024-01-03")]
    links = [(f"c{i}", "e") for i in range(n)] + [("c0", "f"), ("d", "f")]
    return frame("cust_id,ent_id", links), frame(PROMOTION, promotion)


def test_customers_and_campaigns_of_one_enterprise_use_many_tasks(unmerged, frame):
    source, promotion = heavy_enterprise(frame)
    grid = measure_links(source, promotion, None, 1000)
    ((key, g),) = [tuple(r) for r in grid.frame.collect()]
    assert key == "e" and g[0] * g[1] >= 810  # the older promotions of the enterprise are no campaigns
    got = latest_campaigns(source, promotion, "2024-02-01", one_enterprise=True, grid=grid)
    made = tasks(got)
    assert sum(made) == 900 * 900 + 2 and len(made) == 8 and max(made) < 2 * min(made)


def test_campaigns_of_a_heavy_enterprise(frame, rows):
    source, promotion = heavy_enterprise(frame, 40)
    plain = rows(latest_campaigns(source, promotion, "2024-02-01"))
    assert len(plain) == 40 * 40 + 1  # c0 has the later day of its first enterprise
    grid = measure_links(source, promotion, None, 100)
    splits = skew.hot_keys({"promotion": (promotion, "ent_id"), "source": (source, "ent_id"), "customer": (source, "cust_id")}, 10)
    assert grid and rows(latest_campaigns(source, promotion, "2024-02-01", splits=splits, grid=grid)) == plain


def test_built_campaigns_of_a_heavy_enterprise(frame, rows):
    source, promotion = heavy_enterprise(frame, 30)
    relation = source.where("ent_id = 'e'").selectExpr("cust_id AS custId", "ent_id AS entId", "'t' AS createTime", "'n' AS custName", "'1' AS updateTime")
    dimension = source.select("cust_id")
    plain = rows(build_latest_campaigns(dimension, relation, promotion, "2024-02-01"))
    assert rows(build_latest_campaigns(dimension, relation, promotion, "2024-02-01", rows_per_task=50)) == plain
    assert len(plain) == 900


def test_only_enterprises_of_the_latest_day_meet_their_campaigns(frame):
    """The join of customers and campaigns gets the picked links only."""
    source = frame("cust_id,ent_id", [("c", f"e{i}") for i in range(30)])
    promotion = frame(PROMOTION, [(f"e{i}", "w", f"p{j}", "t", "u", f"2024-01-{i % 28 + 1:02}") for i in range(30) for j in range(5)])
    got = latest_campaigns(source, promotion, "2024-02-01")
    assert got.count() == 5 and got.select("RELEASE_TIME").distinct().count() == 1


def test_extract_of_a_customer_heavy_in_both_tables(unmerged, frame):
    customers = frame("custId,x", [("c", ""), ("d", "")]).select("custId")
    master = frame("custId,custNameCn,createDate", [("c", f"n{i}", "d") for i in range(300)] + [("d", "n", "d")])
    relation = frame("custId,entId", [("c", f"e{i}") for i in range(300)])
    got = customer_extract(customers, master, relation, rows_per_task=500)
    made = tasks(got)
    assert sum(made) == 300 * 300 + 1 and len(made) == 8 and max(made) < 3 * min(made)
    assert got.distinct().count() == 300 * 300 + 1


def test_wide_rows_of_a_heavy_enterprise(unmerged, frame, rows):
    base = "ent_id,estimate_date,cnei_code,cnei_sec_code,province_code,city_code,county_code,oper_scope"
    relation = frame("custId,entId,createTime,custName,updateTime", [(f"c{i}", "e", "t", "n", "1") for i in range(60)])
    capital = frame("ent_id,reg_caps2", [("e", str(i % 20)) for i in range(400)])
    infos = frame(base, [("e", str(i), "A", None, "P", "Q", None, "x") for i in range(15)])
    facts = {f"t{k}": frame("ent_id,x", [("e", "")]).select("ent_id") for k in range(1, 6)}
    dimension = frame("cust_id,x", [(f"c{i}", "") for i in range(61)] + [("c1", "")]).select("cust_id")
    ((key, g),) = [tuple(r) for r in measure_enterprises(relation, capital, infos, 500).frame.collect()]
    assert key == "e" and g[1] == 1 and 60 / g[0] * 20 / g[2] * 15 / g[3] <= 501  # distinct capital values count
    plain = build_customer_wide(dimension, relation, facts, capital, infos)
    split = build_customer_wide(dimension, relation, facts, capital, infos, rows_per_task=500)
    assert rows(split) == rows(plain) and plain.count() == 63 * 20 * 15 + 1
    assert len(tasks(split)) == 8


def test_enrich_with_a_grid_keeps_unmatched_rows(frame, rows):
    left = frame("key,a", [("hot", str(i)) for i in range(50)] + [("gone", "1"), (None, "2"), (None, "3")])
    right = frame("key,b", [("hot", str(i)) for i in range(3)] + [("far", "z")] * 40)
    grid = skew.measure_grid(left, [right, None], "key", 10, nulls=True)
    third = frame("key,c", [("far", "z")])
    got = enrich(left, [right, third], "key", grid=grid)
    assert rows(got) == rows(enrich(left, [right, third], "key")) and len(rows(got)) == 153


def test_first_rows_of_a_hot_key_use_many_tasks(unmerged, rows):
    data = unmerged.range(300_000).selectExpr("if(id % 10 = 0, null, 'hot') AS key", "(id * 7919) % 300007 AS v", "id")
    order = [F.desc("v"), F.col("id")]
    got = perkey.limit_by(data, ["key"], order, 100_000)
    counts = {r["key"]: r["count"] for r in got.groupBy("key").count().collect()}
    assert counts == {"hot": 100_000, None: 30_000}
    least = got.where("key = 'hot'").agg(F.min("v")).first()[0]
    assert data.where(f"key = 'hot' AND v > {least}").count() == 99_999
    made = tasks(got)
    assert len(made) > 2 and max(made) < 80_000


def test_first_rows_with_ties_and_clashing_names(frame, rows, monkeypatch):
    monkeypatch.setattr(perkey, "GROUP_LIMIT", 3)
    data = frame("k,_bucket,_held", [("a" if i % 3 else None, f"{i // 9:02}", f"{i:03}") for i in range(90)] + [("b", None, None)] * 9)
    order = [F.asc_nulls_last("_bucket"), F.col("_held")]
    got = perkey.limit_by(data, ["k"], order, 7)
    assert got.columns == ["k", "_bucket", "_held"]
    assert len(rows(got)) == 21
    assert rows(got.where("k = 'a'"), "_held") == [(f"{i:03}",) for i in range(90) if i % 3][:7]
    assert perkey.limit_by(data.limit(0), ["k"], order, 7).count() == 0


def test_keys_of_few_rows_are_not_copied_to_be_marked(unmerged, rows):
    left = unmerged.range(60_000).selectExpr("if(id % 9 = 0, null, concat('k', id % 20000)) AS key", "id AS a")
    right = unmerged.range(20_000).selectExpr("concat('k', id) AS key", "id AS b")
    grid = skew.measure_grid(left, [right], "key", 1)
    assert not grid.listed and grid.heavy == []
    joined = skew.join_chain(left, [right], "key", "inner", grid=grid)
    assert joined.count() == left.join(right, "key").count()
    table = grid.frame.withColumnRenamed("key", "known")
    met = skew.spread_join(left, table, "key", "known", heavy=grid.heavy)
    met.collect()
    text = met._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in text
    at = {r["p"] for r in met.select("key", F.spark_partition_id().alias("p")).collect() if r["key"] is None}
    assert len(at) == 8  # rows without a key are spread all the same


def copies_made(frame):
    """Rows that the generators of a plan make."""
    frame.collect()
    plan, found = frame._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        if node.nodeName() == "Generate":
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found


def test_only_heavy_keys_are_copied(unmerged, rows, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    data = unmerged.range(900).selectExpr("if(id < 300, 'hot', if(id < 500, null, concat('k', id))) AS code", "id AS a")
    names = unmerged.range(1000).selectExpr("if(id = 0, 'hot', concat('k', id)) AS known", "id AS name")
    got = skew.spread_join(data, names, "code", "known", 16)
    assert rows(got) == rows(data.join(names, F.col("code") == F.col("known"), "left"))
    (made,) = copies_made(got)
    assert 1000 + 15 <= made < 1000 + 15 * 20  # the rest shares no bucket, or few do
    at = {(r["code"], r["p"]) for r in got.select("code", F.spark_partition_id().alias("p")).collect()}
    assert len([p for code, p in at if code == "hot"]) > 4 and len([p for code, p in at if code is None]) > 4
    numbers = unmerged.range(50).selectExpr("cast(id % 5 AS int) AS code", "id AS a")
    known = unmerged.createDataFrame([("01", "one"), ("2", "two")], "known string, name string")
    assert rows(skew.spread_join(numbers, known, "code", "known", 4)) == rows(numbers.join(known, F.col("code") == F.col("known"), "left"))
