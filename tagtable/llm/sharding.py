"""Sharding by a k-d tree of weighted medians over metadata.

Rows are points: one coordinate per metadata column, a whole number (of a string its hash) plus a fraction
from a hash of the row's text, so that a column with few values can be cut anywhere. Every node is cut along
the dimension in which its points spread widest, where the bytes to the left are the share of the shards that go
left. The cut comes from histograms of bytes: of its 512 bins only the one that holds the cut is split further.
All nodes of a level are cut together, and a row's node is an expression of its coordinates, so rows are not
moved or joined. The driver sees at most 512 bins for each of the tree's nodes.

Rows of equal text get equal coordinates, the smallest of them, and so share a shard, unless they hold more
than ``1 / GROUP_PARTS`` of a shard's bytes; then they are dealt out by a hash into parts of that size.

Defined cases: a missing text has no bytes and the checksum of an empty one; missing metadata have coordinate
-1; repeated rows get slots of their own; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from tagtable.llm.store import saved

BINS = 512
GROUP_PARTS = 8
SALTS = 8
CODES = 1 << 16
TOLERANCE = 0.0005  # of a node's bytes; a cut this near to its place is not refined
SLOT_ROWS = 100_000  # about so many rows are numbered by one task


@dataclass
class Node:
    """A cell of the tree: its first shard and how many shards it will hold, and its two cells once it is cut."""

    first: int
    shards: int
    dimension: int = 0
    at: float = 0.0
    inclusive: bool = False
    left: Node | None = None
    right: Node | None = None

    def cut(self, dimension: int, at: float, inclusive: bool) -> None:
        half = self.shards // 2
        self.dimension, self.at, self.inclusive = dimension, at, inclusive
        self.left, self.right = Node(self.first, half), Node(self.first + half, self.shards - half)


def coordinate(docs: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(docs.schema[column].dataType, StringType):
        value = F.pmod(F.xxhash64(value), F.lit(CODES))
    return F.coalesce(F.when(F.col(column).isNotNull(), F.floor(value.cast("double"))), F.lit(-1)).cast("double")


def place(node: Node, dims: Sequence[Column]) -> Column:
    """The first shard of the cell that a row lies in."""
    if node.left is None:
        return F.lit(node.first)
    x = dims[node.dimension]
    goes_left = x <= node.at if node.inclusive else x < node.at
    return F.when(goes_left, place(node.left, dims)).otherwise(place(node.right, dims))


def points(docs: DataFrame, dimensions: Sequence[str], shards: int) -> DataFrame:
    """``doc_id, size, text_crc32, x0, x1, ...`` and the written part ``part`` of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    coordinates = [coordinate(docs, d).alias(f"v{i}") for i, d in enumerate(dimensions)]
    rows = saved(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("key"),
            F.spark_partition_id().alias("part"),
            *coordinates,
        )
    )
    names = [f"v{i}" for i in range(len(dimensions))]
    groups = (
        rows.groupBy("key")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), *(F.min(v).alias(f"g{v}") for v in names))
        .where(F.col("n") > 1)
    )
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    limit = max(1.0, total / (shards * GROUP_PARTS))
    parts = F.when(F.col("bytes") > limit, F.ceil(F.col("bytes") / F.lit(limit))).otherwise(1).cast("long")
    copies = groups.select(
        F.col("key").alias("_key"),
        parts.alias("_parts"),
        *(f"g{v}" for v in names),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )
    salt = F.pmod(F.xxhash64("doc_id", "part"), F.lit(SALTS)).cast("int")
    joined = rows.join(copies, (F.col("key") == F.col("_key")) & (salt == F.col("_salt")), "left")
    piece = F.when(F.col("_parts") > 1, F.pmod(F.xxhash64("part", "doc_id", F.lit(7)), F.col("_parts"))).otherwise(0)
    fraction = F.pmod(F.xxhash64("key", piece), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return saved(
        joined.select(
            "doc_id",
            "size",
            "text_crc32",
            "part",
            *((F.coalesce(f"g{v}", v) + fraction).alias(f"x{i}") for i, v in enumerate(names)),
        )
    )


def grow(rows: DataFrame, dims: int, shards: int) -> Node:
    """The tree over the rows of ``points``, each leaf one shard."""
    root = Node(0, shards)
    columns = [F.col(f"x{i}") for i in range(dims)]
    spread: list[float] = []
    level = [root]
    while level := [n for n in level if n.shards > 1]:
        placed = rows.withColumn("node", place(root, columns))
        ends = [f(f"x{i}").alias(f"{f.__name__}{i}") for i in range(dims) for f in (F.min, F.max)]
        cells = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect()}
        if not spread:
            spread = [cells[0][f"max{i}"] - cells[0][f"min{i}"] or 1.0 for i in range(dims)] if cells else [1.0] * dims
        searches = []
        for node in level:
            if cell := cells.get(node.first):
                widths = [(cell[f"max{i}"] - cell[f"min{i}"]) / spread[i] for i in range(dims)]
                d = max(range(dims), key=widths.__getitem__)
                searches.append(Search(node, d, cell[f"min{d}"], cell[f"max{d}"], cell["bytes"]))
            else:
                node.cut(0, 0.0, False)
        _find_cuts(placed, columns, searches)
        level = [child for node in level for child in (node.left, node.right)]
    return root


class Search:
    """The narrowing search for one node's cut along a dimension."""

    def __init__(self, node: Node, dimension: int, low: float, high: float, total: int):
        self.node, self.dimension, self.low, self.high = node, dimension, low, high
        self.total, self.goal, self.done = total, total * (node.shards // 2) / node.shards, False

    def bin_of(self, x: Column) -> Column:
        width = (self.high - self.low) or 1.0
        return F.least(F.floor((x - F.lit(self.low)) / F.lit(width) * F.lit(float(BINS))), F.lit(BINS - 1)).cast("int")

    def narrow(self, bins: list) -> None:
        """Find the bin of the cut; cut next to it if it is small or can't be split, else search within it."""
        for b in sorted(bins, key=lambda r: r["bin"]):
            if b["bytes"] <= self.goal and b is not bins[-1]:
                self.goal -= b["bytes"]
                continue
            if b["low"] == b["high"] or b["bytes"] <= self.total * TOLERANCE:
                inclusive = b["bytes"] / 2 < self.goal
                self.node.cut(self.dimension, b["high"] if inclusive else b["low"], inclusive)
                self.done = True
            else:
                self.low, self.high = b["low"], b["high"]
            return


def _find_cuts(placed: DataFrame, columns: list[Column], searches: list[Search]) -> None:
    while open_ := [s for s in searches if not s.done]:
        x, bin_ = F.lit(None), F.lit(None)
        inside = F.lit(False)
        for s in open_:
            own = columns[s.dimension]
            here = F.col("node") == s.node.first
            x = F.when(here, own).otherwise(x)
            bin_ = F.when(here, s.bin_of(own)).otherwise(bin_)
            inside = inside | (here & own.between(s.low, s.high))
        counted = (
            placed.where(inside)
            .groupBy("node", bin_.alias("bin"))
            .agg(F.sum("size").alias("bytes"), F.min(x).alias("low"), F.max(x).alias("high"))
            .collect()  # at most BINS rows for each node
        )
        for s in open_:
            s.narrow(sorted((r for r in counted if r["node"] == s.node.first), key=lambda r: r["bin"]))


def numbered(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in every shard, numbered by many tasks for each shard."""
    buckets = max(1, math.ceil(count / SLOT_ROWS))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "part"), F.lit(buckets)))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size", "part")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    ranked = dealt.withColumn("rank", F.row_number().over(within))
    return ranked.join(starts, ["shard", "bucket"]).withColumn("slot", F.col("start") + F.col("rank") - 1)


def shard(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Sequence[str] = ("source", "lang", "n_chars"),
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: a number of shards of about equal bytes, or of about ``target_bytes``."""
    if shards is None:
        if not target_bytes:
            raise ValueError("give a number of shards or the bytes of one")
        size = F.coalesce(F.octet_length("text"), F.lit(0)) + 8
        shards = max(1, math.ceil((docs.agg(F.sum(size.cast("long"))).first()[0] or 0) / target_bytes))
    rows = points(docs, dimensions, shards)
    root = grow(rows, len(dimensions), shards)
    placed = rows.withColumn("shard", place(root, [F.col(f"x{i}") for i in range(len(dimensions))]).cast("int"))
    return numbered(placed, rows.count()).select("doc_id", "size", "text_crc32", "shard", "slot")
