"""Token ids in ORC files, in ascending ``doc_id`` order.

A file holds one range of ids; its rows carry the file's place among the files and the row's start within the
file. Ids are integers in ORC's run-length encoding; every stripe has row indexes, and Bloom filters on
``doc_id``, so that a lookup reads only the stripes and row groups that may hold an id, and Spark reads stripes
in parallel. The place of a document among all ids is its file's start plus its start in the file: only one
number per file is summed up, whatever the number of rows.

Defined cases: a missing or empty text gives the end id alone; rows of equal ``doc_id`` follow each other by
text; a missing ``doc_id`` comes first; an empty table gives files without rows; other columns are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tagtable.llm.store import map_batches
from tagtable.llm.tokenizer import vocabulary
from tagtable.llm.words import chunks

CHUNK_BYTES = 4 << 20
SCHEMA = "doc_id {kind}, ids array<int>, file int, file_start long"


def encode(docs: DataFrame, model: str, end_id: int, text: str = "text") -> DataFrame:
    """``doc_id, ids`` in ascending order within and between partitions, with each row's start in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, start = vocabulary(model), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, end, texts in chunks(batch.column(1), CHUNK_BYTES):
                ids, bounds = coder.encode(texts, end_id)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                starts = start + bounds[:-1]
                start += int(bounds[-1])
                arrays = [batch.column(0)[first:end], lists, pa.array(np.full(len(lists), part, np.int32)), pa.array(starts)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "file", "file_start"])

    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col(text).asc_nulls_first()]
    # by the texts' beginnings the rows of a repeated id are dealt to several files, in the order of the sort
    ranged = docs.select("doc_id", text).repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.substring(text, 1, 64))
    return map_batches(ranged.sortWithinPartitions(*order), run, SCHEMA.format(kind=docs.schema["doc_id"].dataType.simpleString()))


def write_tokens(docs: DataFrame, path: str, model: str, end_id: int) -> None:
    (
        encode(docs, model, end_id)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(16 << 20))
        .option("compression", "zstd")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids, start``: rows in files, with the number of all ids before each."""
    rows = spark.read.orc(path)
    last = F.max_by(F.col("file_start") + F.size("ids"), "file_start")
    # one row per file; an end id makes starts in a file differ
    ends = rows.groupBy("file").agg(last.alias("length"))
    before = F.sum("length").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    bases = ends.select(F.col("file").alias("_file"), F.coalesce(before, F.lit(0)).alias("_base"))
    joined = rows.join(F.broadcast(bases), F.col("file") == F.col("_file"))  # a row per file, and files are as many as partitions
    return joined.select("doc_id", "ids", (F.col("_base") + F.col("file_start")).alias("start"))


def lookup(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The rows of some documents; ORC's statistics and Bloom filters leave out all other row groups."""
    return spark.read.orc(path).where(F.col("doc_id").isin(list(doc_ids))).select("doc_id", "ids")


def checksums(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens`` and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(), dtype="<u4")).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            arrays = [batch.column(0), batch.column(1), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    picked = rows.select("doc_id", "start", "ids")
    return map_batches(picked, run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
