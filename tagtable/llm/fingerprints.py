"""SimHash fingerprints, and a search for all fingerprints within a Hamming radius by permuted block tables.

A text's terms are its pairs of neighbouring words in lower case (a lone word is its own term). Each term has
a 128-bit hash and weighs as often as it occurs; it votes for or against each bit, and the fingerprint has the
bits with more votes for than against. Votes are added 16 bits wide, four in a machine word, for all texts of
a chunk at once.

Search: 128 bits make 8 blocks. Fingerprints that differ in ``radius`` <= 6 bits agree in 2 blocks at least, so
each pair of blocks is one table keyed by those blocks; a pair of fingerprints is found in the table of its
first two equal blocks only, and its distance is counted. Equal fingerprints are looked up once. The tables are
joined by shuffle, never broadcast, and keys with very many pairs are cut into cells (``operators.skew``).

Defined cases: a missing text is an empty one, whose fingerprint is 0; repeated rows get a fingerprint each;
texts of any length are read whole; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tagtable.llm.store import map_batches, same, saved, tidy
from tagtable.llm.words import NOT_BLANK, Texts, chunks, grams, mix, rows_of
from tagtable.operators.skew import BUCKETS, ROWS_PER_TASK, Grid, grid_of_counts, join_chain

BITS = 128
BLOCKS = 8
RADIUS = BLOCKS - 2

_SHIFTS = np.arange(4, dtype=np.uint64) * np.uint64(16)
_bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.uint64)
#: For each byte, its low and its high four bits as four counters of 16 bits.
_COUNTERS = tuple((_bits[:, i : i + 4] << _SHIFTS).sum(axis=1, dtype=np.uint64) for i in (0, 4))
_MOST = 1 << 15  # terms added in one go, so that no counter overflows


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of each text, with bounds."""
    words = texts.lower().words(NOT_BLANK)
    hashes, bounds = words.hashes(), words.bounds
    if not len(hashes):
        return hashes, bounds
    pairs = np.append(grams(hashes, 2), hashes[-1:])
    counts = np.diff(bounds)
    last = bounds[1:][counts > 1] - 1  # a text's last word starts no pair
    pairs[bounds[:-1][counts == 1]] = mix(hashes[bounds[:-1][counts == 1]], 1)
    keep = np.ones(len(pairs), dtype=bool)
    keep[last] = False
    kept = np.zeros(len(bounds), dtype=np.int64)
    np.cumsum(np.maximum(counts - 1, np.minimum(counts, 1)), out=kept[1:])
    return pairs[keep], kept


def simhash(texts: Texts) -> np.ndarray:
    """Fingerprints of texts, two 64-bit numbers each."""
    hashes, bounds = terms(texts)
    row = rows_of(bounds)
    # runs of at most _MOST terms of one text
    starts = np.unique(np.concatenate([bounds[:-1][np.diff(bounds) > 0], *(np.arange(a, b, _MOST) for a, b in zip(bounds[:-1], bounds[1:], strict=True) if b - a > _MOST)])).astype(np.int64)
    edges = np.append(starts, len(hashes))
    votes = np.zeros((len(texts), BITS), dtype=np.int64)
    if len(hashes):
        owner = row[starts]
        for half in range(2):
            octets = np.ascontiguousarray(hashes if half == 0 else mix(hashes, 3)).view(np.uint8).reshape(-1, 8)
            for j in range(8):
                for k, counters in enumerate(_COUNTERS):
                    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
                    np.cumsum(counters[octets[:, j]], out=total[1:])
                    packed = total[edges[1:]] - total[edges[:-1]]
                    four = (packed[:, None] >> _SHIFTS & np.uint64(0xFFFF)).astype(np.int64)
                    first = half * 64 + j * 8 + k * 4
                    np.add.at(votes[:, first : first + 4], owner, four)
    bits = votes * 2 > np.diff(bounds)[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def _texts(values: list[bytes]) -> Texts:
    offsets = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return Texts(np.frombuffer(b"".join(values), dtype=np.uint8), offsets)


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, f1, f2`` of each row: the fingerprint's two halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in chunks(batch.column(1)):
                prints = simhash(texts).view(np.int64)
                arrays = [batch.column(0)[first:end], pa.array(prints[:, 0]), pa.array(prints[:, 1])]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "f1", "f2"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", text), run, f"doc_id {kind}, f1 long, f2 long")


def hexadecimal(f1: Column, f2: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f2), 16, "0"), F.lpad(F.hex(f1), 16, "0")))


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """1 for equal fingerprints, about 0.5 for unrelated ones."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def _block(f: tuple[Column, Column], b: int) -> Column:
    return F.shiftrightunsigned(f[b // 4], 16 * (b % 4)).bitwiseAND(F.lit(0xFFFF))


def block_tables(prints: DataFrame) -> DataFrame:
    """``f1, f2`` and other columns once for each pair of blocks, with the table's key and number."""
    f = (F.col("f1"), F.col("f2"))
    rows = []
    for i, j in combinations(range(BLOCKS), 2):
        key = F.shiftleft(_block(f, i), 16).bitwiseOR(_block(f, j)).bitwiseOR(F.shiftleft(F.lit(i * BLOCKS + j).cast("long"), 32))
        rows.append(F.struct(key.alias("key"), F.lit((1 << (j + 1)) - 1).alias("low"), F.lit((1 << i) | (1 << j)).alias("want")))
    return prints.withColumn("t", F.explode(F.array(*rows))).select(*prints.columns, "t.key", "t.low", "t.want")


def search(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``q1, q2, f1, f2, distance``: for each fingerprint of ``queries`` all those of ``prints`` within ``radius``."""
    if radius > RADIUS:
        raise ValueError(f"tables of two blocks find distances up to {RADIUS}")
    asked = block_tables(queries.select("f1", "f2").distinct())
    asked = asked.select(F.col("f1").alias("q1"), F.col("f2").alias("q2"), "key", "low", "want")
    known = block_tables(prints.select("f1", "f2").distinct()).select("f1", "f2", "key")
    q, f = (F.col("q1"), F.col("q2")), (F.col("f1"), F.col("f2"))
    x = (q[0].bitwiseXOR(f[0]), q[1].bitwiseXOR(f[1]))
    equal = sum(F.when(_block(x, b) == 0, 1 << b).otherwise(0) for b in range(BLOCKS))
    first = equal.bitwiseAND(F.col("low")) == F.col("want")
    near = distance(q, f) <= radius
    grid = crowded(known, asked, rows_per_task)
    # Spark's estimate of a size does not count the 28 tables, so it must not choose to broadcast either side
    pairs = join_chain(known.hint("merge"), [asked.hint("merge")], "key", "inner", grid=grid).where(near & first)
    return pairs.select("q1", "q2", "f1", "f2", distance(q, f).alias("distance"))


def crowded(known: DataFrame, asked: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> Grid:
    """The keys of block tables with over ``rows_per_task`` pairs, cut so that a task makes no more of them.

    Rows are counted by hash bucket first, a small shuffle, and by key only in buckets with that many pairs.
    """
    sides = [frame.select("key", *[F.lit(int(i == j)).cast("long").alias(f"n{j}") for j in range(2)]) for i, frame in enumerate((known, asked))]
    rows = sides[0].unionAll(sides[1]).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))
    sums = [F.sum(f"n{j}").alias(f"n{j}") for j in range(2)]
    with tidy(known.sparkSession):
        counts = rows.groupBy("bucket").agg(*sums)
        full = [r["bucket"] for r in counts.where(F.col("n0").cast("double") * F.col("n1") > rows_per_task).select("bucket").collect()]
        if not full:
            return Grid(None)
        buckets = known.sparkSession.createDataFrame(pa.table({"full": pa.array(full, pa.int32())}))
        counts = rows.join(F.broadcast(buckets), F.col("bucket") == F.col("full")).groupBy("key").agg(*sums)
        return grid_of_counts(counts.withColumn("key", F.col("key").cast("string")), 2, rows_per_task)


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row's text, of its edited text and of the next row's text, by descending ``doc_id``.

    The edited text has its last third of code points replaced by the first as many of the next text; after the
    last row comes the first. Rows are dealt to partitions by ranges of ids and walked through in order; each
    partition leaves its first and last text in the written rows, by which the gaps between partitions are
    closed. Rows of equal ids go by text, descending; missing ids come last.

    Columns: ``doc_id, n_chars, edited_sha256`` and ``f1, f2, e1, e2, n1, n2``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    fields = "n_chars long, edited_sha256 string, f1 long, f2 long, e1 long, e2 long, n1 long, n2 long"
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last()]
    dealt = docs.select("doc_id", "text").repartitionByRange(n, by[0], F.substring("text", 1, 64).desc_nulls_last())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, held, started = TaskContext.get().partitionId(), [], [], False
        for batch in batches:
            for first, end, _ in chunks(batch.column(1)):
                ids += batch.column(0)[first:end].to_pylist()
                held += [t or "" for t in batch.column(1)[first:end].to_pylist()]
                if len(held) > 1:
                    yield _written(id_type, ids[:-1], held[:-1], held[1:], part, None if started else held[0], None)
                    ids, held, started = ids[-1:], held[-1:], True
        if held:
            yield _written(id_type, ids, held, held, part, None if started else held[0], held[0])

    ends = f"doc_id {kind}, {fields}, part int, head string, tail string"
    rows = saved(map_batches(dealt.sortWithinPartitions(*by), walk, ends))
    done = rows.where(F.col("tail").isNull()).drop("part", "head", "tail")
    # a row or two for each partition; only the partitions' numbers are put in order
    heads = rows.where(F.col("head").isNotNull()).select(F.col("part").alias("following"), F.col("head").alias("next")).hint("merge")
    tails = rows.where(F.col("tail").isNotNull()).select("part", "doc_id", "tail").hint("merge")
    ring = Window.orderBy("own")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("own").over(ring), F.first("own").over(whole)).alias("after")
    order = rows.where(F.col("head").isNotNull()).select(F.col("part").alias("own")).select("own", after)
    gaps = tails.join(order, F.col("part") == F.col("own")).join(heads, F.col("after") == F.col("following"))
    gaps = gaps.select("doc_id", "tail", "next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _written(id_type, *(batch.column(i).to_pylist() for i in range(3)), 0, None, None, in_order=False)
            yield pa.RecordBatch.from_arrays(made.columns[:9], names=made.schema.names[:9])

    return done.unionByName(map_batches(gaps, close, f"doc_id {kind}, {fields}"))


def _written(id_type: pa.DataType, ids: list, texts: list[str], following: list[str], part: int, head: str | None, tail: str | None, in_order: bool = True) -> pa.RecordBatch:
    """Rows of texts and the texts that follow them, of which all but the last are the next rows' if ``in_order``."""
    edited = []
    for text, after in zip(texts, following, strict=True):
        third = len(text) // 3
        edited.append((text[: len(text) - third] + after[:third]).encode())
    own = simhash(_texts([t.encode() for t in texts])).view(np.int64)
    others = simhash(_texts([t.encode() for t in (following[-1:] if in_order else following)])).view(np.int64)
    changed = simhash(_texts(edited)).view(np.int64)
    after = np.concatenate([own[1:], others]) if in_order else others
    numbers = [pa.array(np.ascontiguousarray(x[:, i])) for x in (own, changed, after) for i in range(2)]
    first_only = [head] + [None] * (len(ids) - 1)
    arrays = [
        pa.array(ids, id_type),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
        *numbers,
        pa.array([part] * len(ids), pa.int32()),
        pa.array(first_only, pa.string()),
        pa.array([None] * (len(ids) - 1) + [tail], pa.string()),
    ]
    names = ["doc_id", "n_chars", "edited_sha256", "f1", "f2", "e1", "e2", "n1", "n2", "part", "head", "tail"]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def searched(prints: DataFrame, asked: Column, radius: int = RADIUS) -> DataFrame:
    """``prints`` with ``n_within``: for rows where ``asked``, how many other rows are within the radius."""
    counts = prints.groupBy("f1", "f2").agg(F.count("*").alias("n"))
    found = search(prints.where(asked), prints, radius)
    f = counts.select(F.col("f1").alias("c1"), F.col("f2").alias("c2"), "n")
    near = found.join(f.hint("merge"), (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")))
    near = near.groupBy("q1", "q2").agg(F.sum("n").alias("n_all"))
    on = same(F.col("f1"), F.col("q1")) & same(F.col("f2"), F.col("q2"))
    told = prints.where(asked).join(near.hint("merge"), on).withColumn("n_within", F.col("n_all") - 1)
    rest = prints.where(~F.coalesce(asked, F.lit(False))).withColumn("n_within", F.lit(None).cast("long"))
    return told.select(*rest.columns).unionByName(rest)
