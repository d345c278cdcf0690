"""Extract of listed customers with their master data and enterprise."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tagtable.operators.copies import COPIES, copied, counted, is_repeated
from tagtable.operators.joins import enrich
from tagtable.operators.skew import ROWS_PER_TASK, measure_grid
from tagtable.sinks.files import write_compact


def customer_extract(
    customers: DataFrame, master: DataFrame, relation_rows: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Listed customers (``custId``) with ``custNameCn, createDate`` and every ``entId`` they relate to.

    A customer that is listed several times is one row until all joins are done. One that has many rows in both of
    the other tables is cut by the product of them.
    """
    listed = counted(customers, "custId")
    rights = [master.select("custId", "custNameCn", "createDate"), relation_rows.select("custId", "entId")]
    found = enrich(listed, rights, "custId", grid=measure_grid(None, rights, "custId", rows_per_task))
    return copied(found, COPIES, is_repeated(listed))


def load_customer_extract(
    customers: DataFrame, master: DataFrame, relation_rows: DataFrame, path: str, rows_per_task: int = ROWS_PER_TASK
) -> None:
    write_compact(customer_extract(customers, master, relation_rows, rows_per_task), path)
