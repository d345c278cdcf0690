"""The daily tag table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tagtable.operators.tags import emit_tags
from tagtable.sinks.files import replace_date
from tagtable.sources.dictionary import CodeBook


def data_date_of(run_date: str) -> str:
    """The day a run reports on: the day before it."""
    return (dt.date.fromisoformat(run_date) - dt.timedelta(days=1)).isoformat()


def customer_tags(
    wide: DataFrame, industries: CodeBook, regions: CodeBook, run_date: str, on_unknown: str = "truncate"
) -> DataFrame:
    """All tags of ``customer_wide`` as ``CUST_ID, TAG_CODE, TAG_VALUE, TAG_VALUE_NAME, DATA_DATE``."""
    return emit_tags(wide, "cust_id", data_date_of(run_date), industries, regions, on_unknown=on_unknown)


def load_customer_tags(
    wide: DataFrame,
    industries: CodeBook,
    regions: CodeBook,
    run_date: str,
    path: str,
    on_unknown: str = "truncate",
    keep: int = 0,
) -> None:
    """Compute the tags of a day and put them in place of that day in the tag table at ``path``.

    ``keep`` runs before it stay for readers (``sources.files.read_dated``) that have begun with them.
    """
    replace_date(customer_tags(wide, industries, regions, run_date, on_unknown), path, data_date_of(run_date), keep)
