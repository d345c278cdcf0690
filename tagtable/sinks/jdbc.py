"""JDBC sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def append_jdbc(frame: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Append rows by column name; table columns the frame lacks keep their default.

    A task that is retried appends its rows again unless the table removes duplicates, so write dated
    results with ``sinks.files.replace_date`` where that matters.
    """
    frame.write.mode("append").jdbc(url, table, properties=dict(properties))
