"""Tables written once to the shared folder, to cut lineage and to read an input's texts only once."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tagtable.session import work_folder


HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_batches(
    frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` whose Python workers find this package, also when only the driver's path has it.

    On a cluster the package is installed or shipped with the job; the folder named here then just isn't there.
    """
    environment = frame.sparkSession.sparkContext.environment
    path = environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in path:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in path if p] + [HOME])
    return frame.mapInArrow(function, schema)


TIDY = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Settings for queries that run in here: Spark removes their shuffle files when they end, which otherwise stay
    until the driver collects garbage, and Python workers hold few texts at a time."""
    before = {key: spark.conf.get(key, None) for key in TIDY}
    for key, value in TIDY.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def saved(frame: DataFrame) -> DataFrame:
    """The rows of ``frame``, written to a new folder under ``spark.checkpoint.dir`` and read from there."""
    spark = frame.sparkSession
    path = work_folder(spark)
    with tidy(spark):
        frame.write.parquet(path)
    relieved(spark)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def scratch(frame: DataFrame) -> Iterator[DataFrame]:
    """``frame`` written and read like ``saved``, for as long as the block lasts; what is made of it is saved inside."""
    spark = frame.sparkSession
    path = work_folder(spark)
    with tidy(spark):
        frame.write.parquet(path)
    yield spark.read.schema(frame.schema).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def relieved(spark: SparkSession) -> None:
    """Give back what finished steps still hold in the driver: plans that Python names, then their broadcasts and shuffles.

    The driver by itself collects garbage only when its heap is full, which an operator of many steps fills with plans.
    """
    gc.collect()
    spark._jvm.java.lang.System.gc()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def same(left: Column, right: Column) -> Column:
    """Equal, with missing equal to missing; sorts and hashes like an ordinary join key."""
    return left.eqNullSafe(right)


def text_key(column: str) -> Column:
    """128 bits that tell texts apart: two hashes with different seeds; a missing text has a key of its own."""
    text = F.col(column)
    return F.struct(
        F.xxhash64(text, F.lit(1)).alias("a"),
        F.xxhash64(F.lit(2), text, text.isNull()).alias("b"),
    )
