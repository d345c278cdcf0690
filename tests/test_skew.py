"""Split joins give what plain joins give; hot keys are found."""

import random

import pytest
from pyspark.sql import functions as F

from tagtable.operators import skew
from tagtable.operators.joins import enrich, presence_flags
from tagtable.operators.perkey import latest_rows, ranked


def hot_pairs(seed, count, keys, hot_share=0.4):
    """Pairs of which a large share has the key 'hot', with copies and NULL keys among them."""
    rng = random.Random(seed)
    pick = lambda: "hot" if rng.random() < hot_share else rng.choice(keys)
    return [(pick(), str(rng.randrange(count // 4))) for _ in range(count)] + [(None, "n1"), (None, "n2")]


KEYS = [f"k{i}" for i in range(40)]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_left", [{}, {"hot": 7}, {"hot": 5, "k1": 2, "gone": 3, None: 4}])
@pytest.mark.parametrize("hot_right", [None, {"hot": 4}, {"hot": 3, "k2": 6, None: 2}])
def test_join_chain_equals_plain_join(frame, rows, how, hot_left, hot_right):
    left = frame("key,a", hot_pairs(1, 300, KEYS + ["only_left"]))
    right = frame("key,b", hot_pairs(2, 60, KEYS + ["only_right"]))
    other = frame("key,c", [(k, k.upper()) for k in KEYS[:30] + ["hot"]])
    got = skew.join_chain(left, [right, other], "key", how, hot_left, [hot_right, None])
    wanted = left.join(right, "key", how).join(other, "key", how)
    assert rows(got, "key", "a", "b", "c") == rows(wanted, "key", "a", "b", "c")


def test_split_rows_really_spread(frame):
    left = frame("key,a", [("hot", str(i)) for i in range(200)])
    right = frame("key,b", [("hot", "x")])
    split = left.withColumn("s", skew._own_split(left, "key", {"hot": 8}))
    assert split.select("s").distinct().count() == 8
    copies = frame("key,a", [("hot", "same")] * 200).repartition(8)
    split = copies.withColumn("s", skew._own_split(copies, "key", {"hot": 8}))
    assert split.select("s").distinct().count() > 4
    assert skew.join_chain(copies, [right], "key", "inner", {"hot": 8}).count() == 200


def test_hot_keys(frame):
    left = frame("key,a", hot_pairs(3, 3000, KEYS))
    right = frame("id,b", [(str(i), "x") for i in range(500)])
    found = skew.hot_keys({"left": (left, "key"), "right": (right, "id")}, rows_per_task=200)
    assert found["right"] == {}
    assert list(found["left"]) == ["hot"]
    assert found["left"]["hot"] == -(-left.where("key = 'hot'").count() // 200)
    assert skew.hot_keys({"left": (left, "key")}) == {"left": {}}


def test_hot_keys_count_missing_keys_if_asked(frame):
    data = frame("key,a", [(None, str(i)) for i in range(50)] + [("k", "x")] * 10)
    assert skew.hot_keys({"d": (data, "key")}, 20)["d"] == {}
    assert skew.hot_keys({"d": (data, "key")}, 20, nulls=True)["d"] == {None: 3}
    nothing = frame("key,a", [(None, "x")] * 50)
    assert skew.hot_keys({"d": (nothing, "key")}, 20, nulls=True)["d"] == {None: 3}
    split = data.withColumn("s", skew._own_split(data, "key", {None: 8}))
    assert split.where("key is null").select("s").distinct().count() > 4


def test_hot_keys_of_numbers(spark):
    numbers = spark.range(5000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("key"))
    splits = skew.hot_keys({"n": (numbers, "key")}, rows_per_task=500)["n"]
    assert splits == {"7": 4}
    names = spark.createDataFrame([(7, "seven")], "key bigint, name string")
    joined = skew.join_chain(numbers, [names], "key", "left", splits)
    assert joined.where("name = 'seven'").count() == 2000 and joined.count() == 5000


def test_no_hot_keys_no_extra_columns_in_the_plan(frame):
    left = frame("key,a", [("x", "1")])
    joined = skew.join_chain(left, [frame("key,b", [("x", "2")])], "key", "left", {}, [{}])
    assert joined.columns == ["key", "a", "b"]
    assert "split" not in joined._jdf.queryExecution().toString()


def test_spread_join(frame, rows):
    left = frame("code,a", hot_pairs(5, 200, KEYS))
    names = frame("_code,name", [(k, k.upper()) for k in KEYS[:20] + ["hot"]])
    got = skew.spread_join(left, names, "code", "_code", 8)
    wanted = left.join(names, left["code"] == names["_code"], "left")
    assert rows(got, "code", "a", "name") == rows(wanted, "code", "a", "name")


def test_presence_flags_equal_chained_joins(frame, rows):
    source = frame("ent_id,cust_id", hot_pairs(6, 200, KEYS))
    rng = random.Random(7)
    facts = {
        f"t{i}": frame("ent_id,x", [(rng.choice(KEYS + ["hot", None]), "x") for _ in range(50)]) for i in range(6)
    }
    chained = source
    for name, fact in facts.items():
        keys = fact.where("ent_id is not null").select(F.col("ent_id").alias("k")).distinct()
        chained = (
            chained.join(keys, chained["ent_id"] == keys["k"], "left")
            .withColumn(name, F.when(F.col("k").isNotNull(), 1).otherwise(0))
            .drop("k")
        )
    for splits in (None, {"hot": 5}):
        got = presence_flags(source, facts, "ent_id", splits)
        assert rows(got, *chained.columns) == rows(chained)


def test_presence_flags_beyond_one_mask(frame, rows):
    facts = {f"f{i}": frame("ent_id,x", [(str(i), "x"), (str(i), "y")]) for i in range(70)}
    source = frame("ent_id,c", [(str(i), "c") for i in range(0, 72, 3)])
    for row in presence_flags(source, facts, "ent_id").collect():
        on = [n for n in facts if row[n] == 1]
        assert on == ([f"f{row['ent_id']}"] if int(row["ent_id"]) < 70 else [])


def test_enrich_multiplies_rows(frame, rows):
    left = frame("k,a", [("x", "1"), ("y", "2")])
    got = enrich(left, [frame("k,b", [("x", "b1"), ("x", "b2")]), frame("k,c", [("x", "c1"), ("x", "c2")])], "k")
    assert got.columns == ["k", "a", "b", "c"]
    assert len(rows(got)) == 5


@pytest.mark.parametrize("splits", [None, {"hot": 3}, {"hot": 3, "k1": 2, "nulls": 2, None: 2}])
def test_latest_rows(frame, rows, splits):
    rng = random.Random(8)
    days = [None, "2024-01-01", "2024-01-02", "2024-01-03"]
    data = [(k, rng.choice(days), v) for k, v in hot_pairs(8, 300, KEYS)]
    data += [("nulls", None, "a"), ("nulls", None, "b")]
    got = latest_rows(frame("key,day,v", data), "key", "day", splits)
    best = {}
    for key, day, _ in data:
        best[key] = max(best.get(key, ""), day or "")
    wanted = [r for r in data if (r[1] or "") == best[r[0]]]
    assert rows(got) == sorted(wanted, key=lambda r: [(v is not None, str(v)) for v in r])


def test_ranked_with_hot_keys(frame, rows):
    rng = random.Random(9)
    days = [None, "2024-01-01", "2024-01-02", "2024-01-03"]
    data = frame("key,day,v", [(k, rng.choice(days), v) for k, v in hot_pairs(9, 300, KEYS)])
    wanted = ranked(data, "key", "day")
    assert rows(ranked(data, "key", "day", splits={"hot": 4, "k1": 2, None: 2})) == rows(wanted)
    assert wanted.schema["rk"].dataType == ranked(data, "key", "day", splits={"hot": 2}).schema["rk"].dataType
