"""Per-key operators: distinct, first rows, latest rows, string sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tagtable.operators.skew import Splits, free_name, hot_marked, is_listed, place_of, split_lookup
from tagtable.session import shuffle_width, work_folder

GROUP_LIMIT = 1_000  # Spark's spark.sql.optimizer.windowGroupLimitThreshold


def distinct_keys(frame: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of the columns, leaving out rows whose first column is NULL."""
    return frame.where(F.col(columns[0]).isNotNull()).select(*columns).distinct()


def limit_by(frame: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int = 1) -> DataFrame:
    """The first rows of every key in an order, which should end in a unique column to be repeatable.

    Spark drops the rows that cannot be among the first before the shuffle (a window group limit), so a hot
    key sends only that many per task. It does so for up to ``GROUP_LIMIT`` rows; for more, no task ranks a key
    (``_limit_by_buckets``).
    """
    if rows > GROUP_LIMIT:
        return _limit_by_buckets(frame, keys, order, rows)
    place = free_name("_place", frame)
    number = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return frame.withColumn(place, number).where(F.col(place) <= rows).drop(place)


def _limit_by_buckets(frame: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int) -> DataFrame:
    """The first rows of every key by a histogram of the order, many tasks working on one key.

    Rows are dealt out by ranges of key and order, ties by place, and written with the number of their range, their
    bucket. Counts of each key's buckets tell which buckets are among the first as a whole, and in which one the last
    of the first rows lies; only that one is ranked.
    """
    spark = frame.sparkSession
    bucket, place, before, held = (free_name(n, frame) for n in ("_bucket", "_place", "_before", "_held"))
    ranges = shuffle_width(spark)
    dealt = frame.withColumn(place, place_of(frame)).repartitionByRange(ranges, *keys, *order, place).drop(place)
    path = work_folder(spark)
    dealt.withColumn(bucket, F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)  # the numbers of the ranges hold from here on
    counts = dealt.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias(held))
    earlier = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(held).over(earlier), F.lit(0))).where(F.col(before) < rows)
    own = [free_name(f"_{c}", dealt, counts) for c in [*keys, bucket]]
    counts = counts.withColumnsRenamed(dict(zip([*keys, bucket], own, strict=True)))
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(o)) for c, o in zip([*keys, bucket], own, strict=True)])
    found = dealt.join(counts, same).drop(*own)
    whole = F.col(before) + F.col(held) <= rows
    number = F.row_number().over(W.partitionBy(*keys, bucket).orderBy(*order))
    last = found.where(~whole).withColumn(place, number).where(F.col(place) <= rows - F.col(before)).drop(place)
    return found.where(whole).unionByName(last).drop(bucket, before, held)


def ranked(frame: DataFrame, key: str, day: str, name: str = "rk", splits: Splits | None = None) -> DataFrame:
    """Rank the rows of every key from the latest day on, NULL days last.

    Hot keys (``splits``) are ranked by day: the rows of a key and day have one rank, which follows from the
    counts of the key's later days. Their rows then get it by a join that splits the key.
    """
    window = W.partitionBy(key).orderBy(F.desc_nulls_last(day))
    rank = F.rank().over(window).cast("long")  # hot keys may outnumber an int
    if not splits:
        return frame.withColumn(name, rank)
    tasks, rows = free_name("_tasks", frame), free_name("_rows", frame)
    marked = hot_marked(frame, key, splits, tasks)
    cold, hot = marked.where(F.col(tasks).isNull()).drop(tasks), marked.where(F.col(tasks).isNotNull())
    later = F.sum(rows).over(window.rowsBetween(W.unboundedPreceding, -1))
    ranks = (
        hot.groupBy(key, day, tasks)
        .agg(F.count(F.lit(1)).alias(rows))
        .select(key, day, tasks, (F.coalesce(later, F.lit(0)) + 1).alias(name))
    )
    return cold.withColumn(name, rank).unionByName(split_lookup(hot, ranks, key, day, tasks))


def latest_rows(frame: DataFrame, key: str, day: str, splits: Splits | None = None) -> DataFrame:
    """All rows of every key's latest day; a key with NULL days only keeps all its rows.

    Rows older than the latest day of their own task are dropped before the shuffle. That does not help a
    hot key whose rows share one day, so rows of hot keys (``splits``) are not shuffled by key: the latest days of a
    list of hot keys are broadcast to where the rows are, those of more are joined to the parts of each key.
    """
    rank = free_name("_rank", frame)
    window = W.partitionBy(key).orderBy(F.desc_nulls_last(day))
    latest = lambda rows: rows.withColumn(rank, F.rank().over(window)).where(F.col(rank) == 1).drop(rank)
    if not splits:
        return latest(frame)
    tasks = free_name("_tasks", frame)
    marked = hot_marked(frame, key, splits, tasks)
    cold, hot = marked.where(F.col(tasks).isNull()).drop(tasks), marked.where(F.col(tasks).isNotNull())
    days = hot.groupBy(key, tasks).agg(F.max(day).alias(day))
    if not is_listed(splits):
        return latest(cold).unionByName(split_lookup(hot, days, key, day, tasks))
    hot_key, hot_day = free_name("_key", frame), free_name("_day", frame)
    days = days.select(F.col(key).alias(hot_key), F.col(day).alias(hot_day))
    same_day = F.col(key).eqNullSafe(F.col(hot_key)) & F.col(day).eqNullSafe(F.col(hot_day))
    return latest(cold).unionByName(hot.drop(tasks).join(F.broadcast(days), same_day, "left_semi"))


def string_set(frame: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """The distinct non-NULL strings of every group as a sorted array.

    Copies go first, so a group's array is built from distinct values and a group with many copies of few
    values is small. The result is one value per group, so a group's distinct strings have to fit one row.
    """
    return (
        frame.select(*keys, column)
        .distinct()
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(column)).alias(name))
    )
