"""From documents to shards: five stages, each written and read again before the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagtable.llm import decontamination, jaccard, mixing, quality, sharding
from tagtable.llm.store import saved, table

SHARDS = 24


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Junk, toxic and empty documents go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of five-word shingles at 0.8 or more lead to, the one with the smallest id stays."""
    return jaccard.one_of_each(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a hit window of the benchmark and one word in twenty within hits go."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and its slot there: ``doc_id, size, text_crc32, shard, slot``."""
    return sharding.shard(docs, shards=SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

#: A trained classifier can't be said in SQL; tests hold every stage against plain loops.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        rows = saved(stage(spark, rows, sf_dir))
    return rows
