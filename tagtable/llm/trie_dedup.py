"""Near-duplicates by 64-bit SimHash fingerprints, linked by a self-join of their binary trie.

A fingerprint has the bits that are set in over half of the XXH64 hashes (seed 42) of a text's three-word shingles,
repeated ones included. The distinct fingerprints form a binary trie, a level for each bit. The join goes down pairs
of nodes of one level together, adds up the bits in which their prefixes differ, and leaves a pair out as soon as
they are over the error budget. The budget grows with the level: however ``radius`` differing bits lie in the four
quarters of a fingerprint, the quarters can be turned round so that none of the first one, two and three holds more
than its share of them. So there are four tries, one for each turn, and the first ``k`` quarters of one have a budget
of ``k * radius // 4``: for three bits 0, 1, 2 and 3. Down to level 16 a node is then paired with itself only.

The upper levels are Spark joins of tables of node pairs, four levels a round, for nodes of more than ``LEAF``
fingerprints; a node has at most 16 children a round. Pairs of nodes of at most ``LEAF`` fingerprints together are
a group each, of bounded size whatever the data, and are joined to the end in numpy. A group keeps which
fingerprints are connected already, leaves out pairs of nodes that lie in one component, and gives a spanning forest,
not all its links, so dense families of near copies cost no squares. The forests of all groups are united by
``components``. Equal fingerprints are one vertex; rows are counted by fingerprint and a salt before any join.

Defined cases: a missing text, or one without words, has fingerprint zero and is linked like any other; one of fewer
than three words has its whole sequence as its one shingle; texts of any length are read whole, in segments; every
repeated row gets its own row; rows without an id get a class too, whose name is the smallest id that there is in it
(missing if there is none); an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tagtable.llm.components import components
from tagtable.llm.store import map_batches, saved
from tagtable.llm.words import chunks

BITS = 64
TURNS = 4
QUARTER = BITS // TURNS
RADIUS = 3
WORDS = 3
SEED = 42
STEP = 4  # levels that Spark goes down in one round
LEAF = 1 << 14  # fingerprints of a pair of nodes that a task joins by itself
SEGMENT = 1 << 22  # bytes of a text that are hashed in one go
SALTS = 1024
_FRONTIER = 1 << 20  # pairs of nodes that a task expands in one go
_CROSS = 64  # pairs of fingerprints up to which two nodes are compared directly

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


# --- fingerprints


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """Hashes of the shingles of one lower-cased text, segment by segment."""
    start, held, any_long = 0, [], False
    while start < len(text):
        end = start + SEGMENT
        blank = _BLANK.search(text, end) if end < len(text) else None
        end = blank.start() if blank else len(text)
        words = held + text[start:end].split()
        if len(words) >= WORDS:
            any_long = True
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = [0, *ends[: -WORDS].tolist()]
            yield _hashes(joined[a:b] for a, b in zip(starts, (ends[WORDS - 1 :] - 1).tolist(), strict=True))
            words = words[1 - WORDS :]
        held, start = words, end
    if held and not any_long:
        yield _hashes([b" ".join(held)])


def _hashes(shingles) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in shingles), np.uint64)


def _votes(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def simhash(texts: list[bytes]) -> np.ndarray:
    """The fingerprints of lower-cased texts."""
    votes, counts = np.zeros((len(texts), BITS), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    rows, held = [], []
    for row, text in enumerate(texts):
        for hashes in shingle_hashes(text):
            counts[row] += len(hashes)
            if len(text) > SEGMENT:
                votes[row] += _votes(hashes).sum(axis=0, dtype=np.int64)
            else:
                rows.append(row)
                held.append(hashes)
    if held:
        starts = np.zeros(len(held), dtype=np.int64)
        np.cumsum([len(h) for h in held[:-1]], out=starts[1:])
        votes[rows] = np.add.reduceat(_votes(np.concatenate(held)), starts, axis=0, dtype=np.int64)
    return np.packbits(2 * votes > counts[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, f`` of each row; ``f`` is the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in chunks(batch.column(1)):
                data = texts.data.tobytes().lower()  # of bytes, this changes A-Z only
                bounds = texts.offsets.tolist()
                prints = simhash([data[a:b] for a, b in zip(bounds, bounds[1:])])
                arrays = [batch.column(0)[first:end], pa.array(prints.view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "f"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", text), run, f"doc_id {kind}, f long")


def hexadecimal(f: Column) -> Column:
    return F.lower(F.lpad(F.hex(f), 16, "0"))


# --- the trie's upper levels, in Spark


def _budget(depth: int, radius: int) -> int:
    return -(-depth // QUARTER) * radius // TURNS


def _prefix(x: Column, depth: int) -> Column:
    return F.shiftrightunsigned(x, BITS - depth) if depth else F.lit(0).cast("long")


def _turned(x: Column, turn: int) -> Column:
    """The bits of ``x`` with the quarter number ``turn`` in front."""
    return F.shiftleft(x, turn * QUARTER).bitwiseOR(F.shiftrightunsigned(x, BITS - turn * QUARTER)) if turn else x


def node_pairs(keys: DataFrame, radius: int, leaf: int) -> list[DataFrame]:
    """Pairs of nodes within the budget that hold at most ``leaf`` keys together, as ``t, depth, a, b``.

    ``keys`` holds the distinct ``t, x``: a trie and a fingerprint as it is written there.
    """
    root = F.lit(0).cast("long")
    pairs = keys.groupBy("t").agg(F.count("*").alias("na"))
    pairs = pairs.select("t", root.alias("a"), root.alias("b"), "na", F.col("na").alias("nb"), F.lit(0).alias("errors"))
    done = []
    size = F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb"))
    for depth in range(0, BITS + 1, STEP):
        pairs = saved(pairs)
        small = (size <= leaf) | F.lit(depth == BITS)
        done.append(pairs.where(small).select("t", F.lit(depth).alias("depth"), "a", "b"))
        large = pairs.where(~small)
        if not large.take(1):
            break
        below = depth + STEP
        inner = large.select("t", F.col("a").alias("p")).union(large.select("t", F.col("b").alias("p"))).distinct()
        nodes = keys.groupBy("t", _prefix(F.col("x"), below).alias("c")).agg(F.count("*").alias("n"))
        nodes = nodes.withColumn("p", F.shiftrightunsigned("c", STEP)).join(inner, ["t", "p"], "left_semi")
        nodes = saved(nodes)
        of_a = nodes.select("t", F.col("p").alias("a"), F.col("c").alias("ca"), F.col("n").alias("ca_n"))
        of_b = nodes.select("t", F.col("p").alias("b"), F.col("c").alias("cb"), F.col("n").alias("cb_n"))
        errors = F.col("errors") + F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit((1 << STEP) - 1)))
        met = large.join(of_a, ["t", "a"]).join(of_b, ["t", "b"])
        met = met.where((errors <= _budget(below, radius)) & ((F.col("a") != F.col("b")) | (F.col("ca") <= F.col("cb"))))
        pairs = met.select("t", F.col("ca").alias("a"), F.col("cb").alias("b"), F.col("ca_n").alias("na"), F.col("cb_n").alias("nb"), errors.cast("int").alias("errors"))
    return done


def links(prints: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``f`` that connect all that differ in at most ``radius`` bits.

    Every row is such a link itself; of several ways to connect two fingerprints not all are given.
    """
    tries = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), _turned(F.col("f"), t).alias("x")) for t in range(TURNS)]))
    keys = saved(prints.select("f").distinct().select(tries.alias("k")).select("k.t", "k.x"))
    done = node_pairs(keys, radius, leaf)
    depths = [STEP * i for i in range(len(done))]
    pairs = done[0]
    for more in done[1:]:
        pairs = pairs.union(more)
    pairs = saved(pairs.withColumn("pair", F.monotonically_increasing_id()))
    nodes = pairs.select("t", "depth", F.explode(F.array_distinct(F.array("a", "b"))).alias("p"), "pair")
    at = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(F.col("x"), d).alias("p")) for d in depths]))
    placed = keys.withColumn("n", at).select("t", "n.depth", "n.p", "x").join(nodes, ["t", "depth", "p"])

    def run(group: pa.Table) -> pa.Table:
        xs = np.sort(group.column("x").to_numpy().view(np.uint64))
        root = spanning(xs, group.column("depth")[0].as_py(), radius)
        member = np.flatnonzero(root != np.arange(len(xs)))
        a, b = xs[member], xs[root[member]]
        turn = group.column("t")[0].as_py() * QUARTER
        if turn:
            a, b = ((v >> np.uint64(turn)) | (v << np.uint64(BITS - turn)) for v in (a, b))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return placed.groupBy("pair").applyInArrow(run, "a long, b long")


# --- the levels below, in a task


def spanning(xs: np.ndarray, depth: int, radius: int) -> np.ndarray:
    """For each of the sorted distinct ``xs`` the position of the first one that links connect it to.

    They share a prefix of ``depth`` bits, or have two; of two, only pairs of one each are compared (links between
    neighbours in the order are also used).
    """
    n = len(xs)
    root = np.arange(n)
    near = np.flatnonzero(np.bitwise_count(xs[1:] ^ xs[:-1]) <= radius)
    _unite(root, near, near + 1)
    prefix = xs >> np.uint64(BITS - depth) if depth else np.zeros(n, dtype=np.uint64)
    middle = int(np.searchsorted(prefix, prefix[0], side="right"))
    first = (0, n, 0, n, 0) if middle == n else (0, middle, middle, n, int(np.bitwise_count(prefix[0] ^ prefix[-1])))
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, np.array([first], dtype=np.int64))]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > _FRONTIER:
            stack.append((depth, pairs[_FRONTIER:]))
            pairs = pairs[:_FRONTIER]
        changes = np.zeros(n, dtype=np.int64)
        np.cumsum(root[1:] != root[:-1], out=changes[1:])
        a, a_end, b, b_end, errors = pairs.T
        one = (changes[a] == changes[a_end - 1]) & (changes[b] == changes[b_end - 1]) & (root[a] == root[b])
        single = (a == b) & (a_end - a == 1)
        pairs = pairs[~(one | single)]
        direct = ((pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2]) <= _CROSS) | (depth == BITS)
        _compare(xs, root, pairs[direct], radius)
        pairs = pairs[~direct]
        if not len(pairs):
            continue
        if depth not in ones:
            ones[depth] = np.zeros(n + 1, dtype=np.int64)
            np.cumsum((xs >> np.uint64(BITS - 1 - depth)) & np.uint64(1), out=ones[depth][1:], dtype=np.int64)
        count = ones[depth]
        a, a_end, b, b_end, errors = pairs.T
        a_mid, b_mid = a_end - (count[a_end] - count[a]), b_end - (count[b_end] - count[b])
        children = [(a, a_mid, b, b_mid, errors), (a_mid, a_end, b_mid, b_end, errors), (a, a_mid, b_mid, b_end, errors + 1)]
        children = [np.stack(c, axis=1) for c in children]
        other = a != b
        children.append(np.stack((a_mid, a_end, b, b_mid, errors + 1), axis=1)[other])
        below = np.concatenate(children)
        kept = (below[:, 1] > below[:, 0]) & (below[:, 3] > below[:, 2]) & (below[:, 4] <= _budget(depth + 1, radius))
        stack.append((depth + 1, below[kept]))
    return root


def _compare(xs: np.ndarray, root: np.ndarray, pairs: np.ndarray, radius: int) -> None:
    """Compare every fingerprint of one node with every one of the other, for nodes of few."""
    a, a_end, b, b_end, _ = pairs.T
    sizes = (a_end - a) * (b_end - b)
    for first in range(0, len(pairs), _FRONTIER // _CROSS):
        part = slice(first, first + _FRONTIER // _CROSS)
        size = sizes[part]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        width = np.repeat((b_end - b)[part], size)
        i, j = np.repeat(a[part], size) + place // width, np.repeat(b[part], size) + place % width
        near = np.bitwise_count(xs[i] ^ xs[j]) <= radius
        _unite(root, i[near], j[near])


def _unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the components of ``i`` and ``j``; afterwards every position has the first one of its component."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = root[root]
            if (further == root).all():
                break
            root[:] = further


# --- classes


def classes(docs: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """``doc_id, f, component_id`` of each row: the smallest id that links lead to, its own included."""
    prints = saved(fingerprint(docs))
    salted = prints.withColumn("salt", _salt("doc_id"))
    parts = saved(salted.groupBy("f", "salt").agg(F.min("doc_id").alias("least")))
    own = saved(parts.groupBy("f").agg(F.min("least").alias("least")))
    linked = components(links(own, radius, leaf))
    of = own.join(linked, F.col("f") == F.col("id"), "left")
    of = saved(of.select("f", F.coalesce("comp", "f").alias("comp"), "least", _salt("f").alias("salt")))
    of_parts = of.groupBy("comp", "salt").agg(F.min("least").alias("least"))
    least = of_parts.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = _spread(of, of_parts, least, "comp").select("f", "component_id")
    return _spread(salted, parts, named, "f").select("doc_id", "f", "component_id")


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS))


def _spread(rows: DataFrame, parts: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Join one row of ``values`` per key to all ``rows`` of it, by way of the key's ``parts``, one for each salt."""
    return rows.join(parts.select(key, "salt").join(values, key), [key, "salt"])
