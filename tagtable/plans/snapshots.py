"""Dated snapshots of a job's inputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tagtable.sinks.files import refresh_snapshot


def refresh_inputs(frames: Mapping[str, DataFrame], base: str, version: str) -> dict[str, DataFrame]:
    """Extract each named input once, for instance from a database, and go on with the written copies.

    A job reads its inputs more than once (to measure hot keys, then to join), which the copies make cheap
    and repeatable.
    """
    return {name: refresh_snapshot(frame, base, name, version) for name, frame in frames.items()}
