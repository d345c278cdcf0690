"""The search's joins: by shuffle whatever Spark takes the sizes for, and of crowded keys in cells."""

import random

import pytest

from tagtable.llm import fingerprints
from tagtable.operators.skew import ROWS_PER_TASK

SCHEMA = "doc_id long, f1 long, f2 long"


def made(n=300):
    """Fingerprints of which many are within a few bits of one another, some equal."""
    draw = random.Random(5)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = []
    for i in range(n):
        whole = draw.getrandbits(128) if i % 3 else 0xABCDEF << 90
        for _ in range(draw.randrange(5)):
            whole ^= 1 << draw.randrange(128)
        rows.append((i, signed(whole & (1 << 64) - 1), signed(whole >> 64)))
    return rows + [(n + i, *r[1:]) for i, r in enumerate(rows[:9])]


def apart(a, b):
    return sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(a[1:], b[1:], strict=True))


@pytest.mark.parametrize("rows_per_task", [ROWS_PER_TASK, 20])
def test_all_within_the_radius_are_found(spark, rows_per_task):
    rows = made()
    prints = spark.createDataFrame(rows, SCHEMA)
    got = fingerprints.search(prints.where("doc_id % 7 = 0"), prints, rows_per_task=rows_per_task).collect()
    wanted = {(*a[1:], *b[1:], apart(a, b)) for a in rows if a[0] % 7 == 0 for b in rows if apart(a, b) <= 6}
    assert len(got) == len(wanted) and {tuple(r) for r in got} == wanted


def test_crowded_keys_are_cut(spark):
    prints = spark.createDataFrame(made(), SCHEMA)
    tables = fingerprints.block_tables(prints.select("f1", "f2").distinct())
    assert not fingerprints.crowded(tables, tables)
    assert fingerprints.crowded(tables, tables, 20)


def test_exploded_tables_are_not_broadcast(spark):
    """28 tables are made of a few rows, which Spark does not count; neither they nor the counts are broadcast."""
    prints = spark.createDataFrame(made(), SCHEMA)
    told = fingerprints.searched(prints, prints.doc_id % 7 == 0)
    told.collect()
    final = told._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Broadcast" not in final and final.count("SortMergeJoin") >= 3
