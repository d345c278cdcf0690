"""Benchmark decontamination by winnowing.

Texts are words of letters and digits in lower case. A window is ``window`` consecutive words of a benchmark
item. Of every ``window - GRAM + 1`` consecutive ``GRAM``-word hashes the smallest is kept (the last of equal
ones), in items and in documents alike, so that two texts that share a window share a kept hash at the same
place in it. Kept hashes of documents pass a Bloom filter of those of the benchmark. A hash that passes is
extended to the windows around it that can hold it, each named by 128 bits, and these are joined with the
windows of the items: what matches is an occurrence of the whole window. Items shorter than a window are one
window each; for each such length documents keep every hash of that length.

A document is identified by its id and its text; what is sent is a few hashes of documents that may be hit,
never a text. The filter has a fixed size; it only saves work, as all that passes it is joined exactly.

Defined cases: a missing or empty text has no words and no hits; items without words are in no document; equal
rows get a result each; an empty benchmark hits nothing; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tagtable.llm.store import map_batches, same, saved
from tagtable.llm.words import LETTERS_DIGITS, Texts, as_long, chunks, grams, mix

WINDOW = 13
GRAM = 8
FILTER_BITS = 23  # the Bloom filter has 2 ** 23 bits, a megabyte, whatever the benchmark
FILTER_HASHES = 3


def winnow(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places of the smallest of every ``span`` consecutive hashes, the last of equal ones; none if there are fewer."""
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best, at = hashes[:n].copy(), np.arange(n)
    for i in range(1, span):
        other = hashes[i : i + n]
        lower = other <= best
        best = np.where(lower, other, best)
        at = np.where(lower, np.arange(i, i + n), at)
    return np.unique(at)


class Spans:
    """Words of a chunk of texts, as hashes; of each text its windows and kept hashes."""

    def __init__(self, texts: Texts):
        words = texts.lower().words(LETTERS_DIGITS)
        self.hashes, self.bounds = words.hashes(), words.bounds
        self.other = mix(self.hashes, 11)
        self._all: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of ``length`` words for each word; those that reach over a text's end mean nothing."""
        if length not in self._all:
            self._all[length] = grams(self.hashes, length), grams(self.other, length)
        return self._all[length]


def _probes(hashes: np.ndarray) -> list[np.ndarray]:
    bits = np.uint64(FILTER_BITS)
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return [(hashes >> bits * np.uint64(i)) & mask for i in range(FILTER_HASHES)]


def _kept(spans: Spans, first: int, last: int, gram: int, window: int) -> np.ndarray:
    """Places in the chunk of the kept hashes of the text with words ``first:last``."""
    return first + winnow(spans.windows(gram)[0][first : max(first, last - gram + 1)], window - gram + 1)


def benchmark_windows(benchmark: DataFrame, window: int, gram: int) -> DataFrame:
    """``item_id, length, h1, h2`` of all distinct windows of the items, with their kept hashes ``marks``."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                ((_, _, texts),) = chunks(batch.column(1).slice(row, 1))
                spans = Spans(texts)
                n = len(spans.hashes)
                length = min(n, window)
                if not n:
                    continue
                one, two = spans.windows(length)
                marks = spans.windows(gram)[0][_kept(spans, 0, n, gram, window)] if n >= window else one
                h1, h2 = as_long(one), as_long(two)
                arrays = [
                    pa.array([batch.column(0)[row].as_py()] * len(h1), batch.schema.field(0).type),
                    pa.array(np.full(len(h1), length, np.int32)),
                    pa.array(h1),
                    pa.array(h2),
                    pa.array([as_long(np.unique(marks)).tolist()] + [None] * (len(h1) - 1), pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["item_id", "length", "h1", "h2", "marks"])

    return saved(map_batches(benchmark.select("item_id", "text"), run, f"item_id {kind}, length int, h1 long, h2 long, marks array<long>"))


def mark_filter(windows: DataFrame) -> np.ndarray:
    """A Bloom filter of the benchmark's kept hashes; words of the filter are united before they come here."""
    mark = F.explode("marks").alias("mark")
    probe = lambda i: F.shiftrightunsigned("mark", FILTER_BITS * i).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bits = windows.select(mark).select(F.explode(F.array(*map(probe, range(FILTER_HASHES)))).alias("bit"))
    words = bits.groupBy(F.shiftrightunsigned("bit", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("set")
    )
    filter_ = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    for word, value in words.collect():  # at most 2 ** 17 numbers
        filter_[word] = np.uint64(value & ((1 << 64) - 1))
    return filter_


def candidate_windows(docs: DataFrame, filter_: np.ndarray, short: list[int], window: int, gram: int) -> DataFrame:
    """``doc_id, key, n_words`` and ``spans``: places, lengths and hashes of windows that may be an item's."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(filter_)

    def passes(hashes: np.ndarray) -> np.ndarray:
        bits, ok = shared.value, np.ones(len(hashes), dtype=bool)
        for at in _probes(hashes):
            ok &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return ok

    def spans_of(spans: Spans) -> tuple[np.ndarray, list[np.ndarray]]:
        """Bounds of each text's candidates, and their place, length and hashes."""
        hashes, bounds = spans.hashes, spans.bounds
        n = len(hashes)
        end = np.repeat(bounds[1:], np.diff(bounds))
        start = np.repeat(bounds[:-1], np.diff(bounds))
        found = []
        if n >= window:
            marks = spans.windows(gram)[0]
            valid = np.arange(len(marks)) + gram <= end[: len(marks)]
            # windows over a text's end keep hashes that no item needs; they only cost a look into the filter
            at = winnow(marks, window - gram + 1)
            at = at[valid[at]]
            at = at[passes(marks[at])]
            places = (at[:, None] - np.arange(window - gram + 1)[None, :]).ravel()
            owner = np.repeat(at, window - gram + 1)
            ok = (places >= start[owner]) & (places + window <= end[owner])
            places = np.unique(places[ok])
            found.append((places, np.full(len(places), window)))
        for length in short:
            if n >= length:
                own = spans.windows(length)[0]
                places = np.flatnonzero((np.arange(len(own)) + length <= end[: len(own)]) & passes(own))
                found.append((places, np.full(len(places), length)))
        if not found:
            return np.zeros(len(bounds), dtype=np.int64), [np.zeros(0, np.int64)] * 4
        places, lengths = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(places, kind="stable")
        places, lengths = places[order], lengths[order]
        h1, h2 = np.zeros(len(places), np.uint64), np.zeros(len(places), np.uint64)
        for length in np.unique(lengths).tolist():
            mine = lengths == length
            one, two = spans.windows(length)
            h1[mine], h2[mine] = one[places[mine]], two[places[mine]]
        own_bounds = np.searchsorted(places, bounds)
        return own_bounds, [places - start[places] if n else places, lengths, as_long(h1), as_long(h2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in chunks(batch.column(1)):
                spans = Spans(texts)
                bounds, columns = spans_of(spans)
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
                values = [pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True)]
                rows = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays(values, ["at", "length", "h1", "h2"]))
                arrays = [batch.column(0)[first:last], batch.column(2)[first:last], pa.array(np.diff(spans.bounds)), rows]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "n_words", "spans"])

    read = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    span = "struct<at: int, length: int, h1: bigint, h2: bigint>"
    return map_batches(read, run, f"doc_id {kind}, key long, n_words long, spans array<{span}>")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, key, n_words, n_hit`` and ``items``: the sorted ids, as strings, of items with occurring windows.

    ``key`` is the hash of id and text that tells rows apart. A word within any occurrence counts once.
    """
    windows = benchmark_windows(benchmark, window, gram)
    lengths = [r[0] for r in windows.where(F.col("length") < window).select("length").distinct().collect()]  # under `window` many
    rows = saved(candidate_windows(docs, mark_filter(windows), sorted(lengths), window, gram))
    names = windows.select(F.col("length").alias("l"), F.col("h1").alias("i1"), F.col("h2").alias("i2"), "item_id").distinct()
    spans = rows.where(F.size("spans") > 0).select("doc_id", "key", F.explode("spans").alias("s")).select("doc_id", "key", "s.*").distinct()
    on = (F.col("length") == F.col("l")) & (F.col("h1") == F.col("i1")) & (F.col("h2") == F.col("i2"))
    hits = spans.join(names, on)
    items = hits.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    places = spans.join(names.select("l", "i1", "i2").distinct(), on, "left_semi").select("doc_id", "key", "at", (F.col("at") + F.col("length")).alias("end"))
    before = Window.partitionBy("doc_id", "key").orderBy("at", "end").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("at"), F.coalesce(F.max("end").over(before), F.lit(0))))
    words = places.withColumn("new", new).groupBy("doc_id", "key").agg(F.sum("new").alias("n_hit"))
    hit = words.select(F.col("doc_id").alias("d1"), F.col("key").alias("k1"), "n_hit")
    listed = items.select(F.col("doc_id").alias("d2"), F.col("key").alias("k2"), "items")
    return (
        rows.join(hit, same(F.col("doc_id"), F.col("d1")) & (F.col("key") == F.col("k1")), "left")
        .join(listed, same(F.col("doc_id"), F.col("d2")) & (F.col("key") == F.col("k2")), "left")
        .select(
            "doc_id",
            "key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def contaminated(share_of: int = 20):
    """A hit, and at least one in ``share_of`` words within hits."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share_of >= F.col("n_words"))


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = find_contamination(docs, benchmark).where(contaminated()).select(F.col("doc_id").alias("_d"), F.col("key").alias("_k")).distinct()
    columns = docs.columns
    wrapped = docs.select(F.struct(*columns).alias("_row"))
    on = same(F.col("_row.doc_id"), F.col("_d")) & (F.xxhash64("_row.doc_id", "_row.text") == F.col("_k"))
    return wrapped.join(bad, on, "left_anti").select("_row.*")
