"""The thresholds' plan: a level reads the one before, and does not compute it again."""

import random

from pyspark.sql import functions as F

from tagtable.llm import mixing

SCHEMA = "source string, hash long, size long"


def made(n=400):
    draw = random.Random(8)
    rows = [(draw.choice(["a", "b", None]), draw.randrange(1 << draw.choice([20, 40, 60])), draw.randrange(9)) for _ in range(n)]
    return rows + rows[:5]


def test_levels_are_not_computed_again(spark):
    rows = spark.createDataFrame(made(), SCHEMA)
    budgets = rows.groupBy("source").agg((F.sum("size") / 2).alias("budget"))
    plan = mixing.thresholds(rows, budgets)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 1 and plan.count("Join") <= 2


def test_thresholds_are_those_of_a_running_sum(spark):
    rows = made()
    budgets = {"a": 301.5, "b": 0.0, None: 1e9}
    frame = spark.createDataFrame(list(budgets.items()), "source string, budget double")
    got = {r.source: r.threshold for r in mixing.thresholds(spark.createDataFrame(rows, SCHEMA), frame).collect()}
    wanted = {}
    for source, budget in budgets.items():
        own = [r for r in rows if r[0] == source]
        for hashed in sorted({r[1] for r in own}):
            if sum(r[2] for r in own if r[1] <= hashed) > budget:
                wanted[source] = hashed
                break
    assert got == wanted and None not in wanted and len(wanted) == 2
