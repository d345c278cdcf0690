"""Row-batch transforms, for what column expressions cannot say."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def map_batches(
    frame: DataFrame, change: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str
) -> DataFrame:
    """Apply a pandas function to Arrow batches of each partition; a batch is never a whole partition's data."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield change(batch)

    return frame.mapInPandas(run, schema)
