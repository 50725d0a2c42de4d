"""CSV and Parquet readers. Layouts are explicit: nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from timelegs.operators.quality import require_columns
from timelegs.schemas import METRIC_VALUE, RAW_SEGMENTS, STOP_CATALOGUE, STOPS


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.option("header", True).option("encoding", "UTF-8").schema(schema).csv(path)


def read_raw_segments(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_SEGMENTS)


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, STOPS)


def read_stop_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, STOP_CATALOGUE)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, METRIC_VALUE)


def _register_reader(spark: SparkSession) -> DataFrameReader:
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    return found.option("header", True).option("encoding", "UTF-8").option("inferSchema", False)


def register_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a register by their header line: a list as long as there are files."""
    lines = _register_reader(spark).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
        "value",
    )
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return {r["header"]: r["files"] for r in groups.orderBy("header").collect()}


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """The stop register: CSV files, one per area, all text, each under the header it has.

    Files with the same header line are read together; a column that a file lacks is NULL.
    ``row_order`` follows the files by name and the rows within each, for last-wins rules;
    ``atco_area_code`` is the three digits that end the file name, blank where there are none.
    """
    name = F.col("_metadata.file_name")
    parts = []
    for files in register_headers(spark, path).values():
        rows = _register_reader(spark).csv([unquote(f) for f in files])
        parts.append(
            rows.select(
                *[F.col(f"`{c}`").alias(c.lstrip("\ufeff").strip()) for c in rows.columns],
                F.regexp_extract(name, r"(\d{3})\.csv$", 1).alias("atco_area_code"),
                F.struct(
                    name.alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"),
                ).alias("row_order"),
            )
        )
    if not parts:
        raise FileNotFoundError(f"No register files: {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """A Parquet table, cut to ``columns``; an error names those that it lacks."""
    df = spark.read.parquet(path)
    if columns is None:
        return df
    return require_columns(df, list(columns), path).select(*columns)


def metrics_record(metrics: DataFrame) -> DataFrame:
    """Metric/value rows as one row with a column per metric.

    Meant for summary files: the metric names are read first, a bounded list.
    """
    return metrics.groupBy().pivot("metric").agg(F.first("value"))


def metric_value(metrics: DataFrame, metric: str, order: Column | None = None) -> DataFrame:
    """One row: the last known value of a metric, trimmed; NULL when blank or absent.

    ``order`` places the rows; without it they count as they are read, as in one summary file.
    """
    order = F.monotonically_increasing_id() if order is None else order
    value = F.nullif(F.trim("value"), F.lit(""))
    rows = metrics.filter(F.col("metric") == metric).select(value.alias("value"), order.alias("place"))
    known = rows.filter("value IS NOT NULL")
    return known.agg(F.max_by("value", "place").alias("value"))


def check_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    """One error that lists every path Spark cannot find."""
    missing = []
    for path in paths:
        try:
            spark.read.format("binaryFile").load(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError("Required inputs are missing: " + ", ".join(missing))
