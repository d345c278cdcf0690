"""Token counts: batches balanced by bytes are encoded in Arrow functions that return lengths only.

Long texts are cut at blanks over which no piece of the model goes; a text without such a place stays whole.
Defined cases: a missing or empty text has no bytes and no tokens; repeated rows are counted each; other
columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagtable.llm.store import map_batches
from tagtable.llm.tokenizer import pieces
from tagtable.llm.words import chunks

BATCH_BYTES = 1 << 18


def count_tokens(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each row, by the sentencepiece model at the path ``model``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = pieces(model)
        for batch in batches:
            out: list[int] = []
            column = batch.column(1)
            for first, end, _ in chunks(column, BATCH_BYTES):
                out += counter.counts([t or "" for t in column[first:end].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.col(text), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return map_batches(read, count, f"doc_id {kind}, n_bytes long, n_tokens long")


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
