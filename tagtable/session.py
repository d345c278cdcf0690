"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Only settings that results or plans rely on; memory, masters and partition counts are the cluster's.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "tagtable", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, shuffled_bytes: int, partition_bytes: int = 200 << 20) -> int:
    """Raise the number of shuffle partitions so that one fits in a task's memory; return the number.

    Adaptive execution merges partitions that turn out small but does not add any, so a large job has to
    start with enough of them.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = max(current, -(-shuffled_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return needed


def work_folder(spark: SparkSession) -> str:
    """A new folder name under the session's ``spark.checkpoint.dir``, which every executor can see.

    Where that is unset, it is set to a folder for passing data on the session's default file system. A cluster whose
    default file system is each machine's own has to name a shared one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        conf = spark._jsc.hadoopConfiguration()
        files = spark._jvm.org.apache.hadoop.fs.FileSystem.get(conf)
        if files.getScheme() == "file" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = f"{files.getUri()}{conf.get('hadoop.tmp.dir')}/tagtable"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tagtable-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``work_folder`` named, once nothing reads it any more."""
    files = spark._jvm.org.apache.hadoop.fs.Path(path)
    files.getFileSystem(spark._jsc.hadoopConfiguration()).delete(files, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of queries that run in here when they end, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
