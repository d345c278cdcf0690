"""Reuse of a computed frame."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def persisted(frame: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame while it is used several times; partitions lost with an executor are computed again."""
    frame.persist(level)
    try:
        yield frame
    finally:
        frame.unpersist()
