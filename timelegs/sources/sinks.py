"""Writers. Every task writes its own files; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


# Without these the writer trims its text, and a blank value would come back as NULL.
CSV_OPTIONS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


class WriteError(RuntimeError):
    """What was written is not what was meant to be written."""


def write_parquet(
    df: DataFrame,
    path: str,
    expected_rows: int | None = None,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    allow_empty: bool = False,
) -> int:
    """Write snappy Parquet and return the rows written, counted in the same pass.

    Zero rows (unless allowed), or another number than ``expected_rows``, is an error. The
    count is an observation on the write itself, so no second job reads the data.
    """
    return write_observed(df, path, [], expected_rows, partition_by, mode, allow_empty)["rows"]


def write_observed(
    df: DataFrame,
    path: str,
    metrics: list[Column],
    expected_rows: int | None = None,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    allow_empty: bool = False,
) -> dict:
    """``write_parquet`` that also returns aggregates of the rows, taken while they are written."""
    observation = Observation()
    counted = df.observe(observation, F.count(F.lit(1)).alias("rows"), *metrics)
    writer = counted.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    rows = observation.get["rows"]
    if rows == 0 and not allow_empty:
        raise WriteError(f"no records were written to {path}")
    if expected_rows is not None and rows != expected_rows:
        raise WriteError(f"expected {expected_rows} rows in {path}, wrote {rows}")
    return observation.get


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).options(**CSV_OPTIONS).csv(path)


def as_metrics(record: DataFrame) -> DataFrame:
    """A one-row record as metric/value rows, in column order."""
    pairs = ", ".join(
        f"'{c}', CAST(`{c}` AS STRING)" for c in record.columns
    )
    return record.select(F.expr(f"stack({len(record.columns)}, {pairs}) AS (metric, value)"))


def write_metrics(record: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_csv(as_metrics(record), path, mode)


def write_statements(statements: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A single text column, one statement per line."""
    statements.write.mode(mode).text(path)


def export_result(result: DataFrame, path: str) -> None:
    """A detail result as CSV, without its map coordinates."""
    from timelegs.operators.serving import without_coordinates  # which writes tables itself

    write_csv(without_coordinates(result), path)
