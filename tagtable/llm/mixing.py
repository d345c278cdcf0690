"""Mixing sources to target weights by nested hash thresholds.

Every row has a 60-bit hash of its ``doc_id``. A source's budget is met by taking each row a whole number of
times, and once more if its hash lies below the source's threshold. Thresholds come from histograms of sizes
over hash buckets: find the bucket where the running sum passes the budget, split only that bucket by the
next bits, and so on. Nothing is sorted by hash, and thresholds of smaller budgets give subsets.

Defined cases: a missing text or one without words has size 0; rows without a source are one source, the last
one; equal or missing ``doc_id`` share a hash and so are taken alike; a source without words takes nothing;
an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagtable.llm.store import same, saved

HASH_BITS = 60
LEVEL_BITS = 15  # a histogram has at most 2 ** 15 buckets for a source
SALTS = 32  # a source's threshold is joined in this many copies, so that a hot source meets many tasks

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id as text."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``source, source_size`` with ``target``: budgets by weight, none above ``most`` times the source's size.

    Weights go to the sources by code point, missing last, and repeat. What a full source can't take goes to the
    others by weight; as sources fill up in the order of size by weight, one running sum finds who is full.
    There is one row per source here, never one per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("double"))
    cap = F.col("source_size") * F.lit(float(most))
    filling = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_first())
    everyone = Window.partitionBy()
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        weighted.withColumn("cap", cap)
        .withColumn("left", F.sum("source_size").over(everyone) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weights", F.sum("weight").over(onward))
        .withColumn("open", F.col("weight") * F.col("left") <= F.col("cap") * F.col("weights"))
        # the first open source has the largest sum of weights from there on
        .withColumn("level", F.max(F.when(F.col("open"), F.struct("weights", "left"))).over(everyone))
        .select(
            "source",
            "source_size",
            F.when(F.col("level").isNull(), F.col("cap"))
            .otherwise(F.least("cap", F.col("weight") * F.col("level.left") / F.col("level.weights")))
            .alias("target"),
        )
    )


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each ``source`` of ``budgets`` the smallest ``threshold`` hash whose rows no longer fit into ``budget``.

    ``rows`` has ``source, hash, size``. All rows of smaller hashes fit; where all rows do, it is null.
    """
    at = budgets.select("source", F.lit(0).cast("long").alias("bucket"), F.col("budget").alias("left"))
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        inside = rows.withColumn("bucket", F.shiftright("hash", shift))
        if level:
            outer = at.select(F.col("source").alias("s"), F.col("bucket").alias("b"))
            on = same(F.col("source"), F.col("s")) & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("b"))
            inside = inside.join(outer, on, "left_semi")
        histogram = inside.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        left = at.select(F.col("source").alias("s"), "left")
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        over = (
            histogram.withColumn("upto", F.sum("words").over(running))
            .join(left, same(F.col("source"), F.col("s")))
            .where(F.col("upto") > F.col("left"))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", (F.col("left") - F.col("upto") + F.col("words")).alias("left"))).alias("first"))
        )
        at = saved(over.select("source", "first.bucket", "first.left"))  # read twice a level: else plans double
    return at.select("source", F.col("bucket").alias("threshold"))


def plan_mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> tuple[DataFrame, DataFrame]:
    """The sizes ``doc_id, source, hash, size`` of all rows, and per source ``source_size, target, whole, threshold``."""
    rows = saved(
        docs.select("doc_id", "source", document_hash(F.col("doc_id")).alias("hash"), word_count(F.col("text")).alias("size"))
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = saved(source_targets(totals, weights, share, most).withColumn("whole", whole))
    budgets = plan.select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    found = thresholds(rows, budgets).withColumnRenamed("source", "s")
    plan = saved(plan.join(found, same(F.col("source"), F.col("s")), "left").drop("s"))
    return rows, plan


def with_copies(frame: DataFrame, plan: DataFrame, source: Column, hashed: Column) -> DataFrame:
    """``frame`` with a struct column ``_mix`` of ``source_size, target, copies``: how often to take the row."""
    spread = plan.select(
        F.col("source").alias("_mix_source"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_mix_salt"),
        F.struct("source_size", "target", "whole", "threshold").alias("_mix"),
    )
    on = same(source, F.col("_mix_source")) & (F.pmod(hashed, F.lit(SALTS)).cast("int") == F.col("_mix_salt"))
    more = F.coalesce((hashed < F.col("_mix.threshold")).cast("long"), F.lit(0))
    mixed = F.struct("_mix.source_size", "_mix.target", (F.col("_mix.whole") + more).alias("copies"))
    joined = frame.join(spread, on).withColumn("_mix", mixed)
    return joined.drop("_mix_source", "_mix_salt")


def mix_report(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words that the mix takes from each row."""
    rows, plan = plan_mix(docs, weights, share, most)
    return with_copies(rows, plan, F.col("source"), F.col("hash")).select(
        "doc_id", "size", "_mix.source_size", "_mix.target", (F.col("size") * F.col("_mix.copies")).alias("taken")
    )


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    _, plan = plan_mix(docs, weights, share, most)
    columns = docs.columns
    wrapped = docs.select(F.struct(*columns).alias("_row"))
    copied = with_copies(wrapped, plan, F.col("_row.source"), document_hash(F.col("_row.doc_id")))
    many = F.explode(F.sequence(F.lit(1), F.col("_mix.copies").cast("int")))
    return copied.where(F.col("_mix.copies") > 0).select("_row", many).select("_row.*")
