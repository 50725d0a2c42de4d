"""One-row frames: summaries side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(record: DataFrame, *others: DataFrame) -> DataFrame:
    """The columns of one-row frames next to each other.

    Each other frame is one scalar subquery, run once whatever the number of its columns.
    """
    names = [f"_record_{i}" for i in range(len(others))]
    subqueries = {n: o.select(F.struct("*")).scalar() for n, o in zip(names, others)}
    return record.withColumns(subqueries).select(*record.columns, *[f"{n}.*" for n in names])
