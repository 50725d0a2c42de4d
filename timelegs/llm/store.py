"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only a local session without it gets its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="llm-")
    return "file://" + _LOCAL[context.applicationId]


class Workspace:
    """The tables of one operator run, in one new folder below the shared one."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        """``df`` written once and read back, so that later plans start at the files.

        The shuffle files of the jobs before are released first, not at some later garbage
        collection, so that disk use is that of one phase.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        df.write.option("compression", compression).parquet(f"{self.path}/{name}")
        schema = df.schema
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def write_in_small_batches(self, df: DataFrame, name: str, rows: int = 128) -> DataFrame:
        """``write`` for a frame whose tasks get very large rows from Spark: fewer of them at a time."""
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, rows)
        try:
            return self.write(df, name)
        finally:
            self.spark.conf.set(setting, before)

    def drop(self, name: str) -> None:
        """Delete a table that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def whole_row(df: DataFrame, keep: list[str] | None = None) -> Column:
    """All columns of a frame, or those named, as one column ``row``: added columns then never clash."""
    return F.struct(*(df[f"`{c}`"] for c in (df.columns if keep is None else keep))).alias("row")


def row_and_text(df: DataFrame, text_column: str, keep: list[str] | None = None) -> list[Column]:
    """``whole_row`` and the text; the text comes once, within the row if that has it."""
    row = whole_row(df, keep)
    if text_column in (df.columns if keep is None else keep):
        return [row]
    return [row, df[f"`{text_column}`"].cast("string").alias("text")]


def text_of(batch, text_column: str):
    """The text of an Arrow batch made from ``row_and_text``."""
    return batch.column("text") if "text" in batch.schema.names else batch.column("row").field(text_column)


def row_and(df: DataFrame, more: str) -> StructType:
    """The schema of the column ``row`` of a frame, followed by further columns in DDL."""
    return StructType(df.select("row").schema.fields + StructType.fromDDL(more).fields)
