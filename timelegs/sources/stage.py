"""Tables written between stages, in the folder that the cluster shares.

The folder is the session's ``spark.checkpoint.dir``. Where that is unset, a local session
(tests) gets a folder of its own, removed at exit; on a cluster it is an error, since no
machine's own disk is a safe place for it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from timelegs.sources import sinks

_own_folder: tempfile.TemporaryDirectory | None = None
_written: dict[tuple[str, str], str] = {}


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    global _own_folder
    if _own_folder is None:
        _own_folder = tempfile.TemporaryDirectory(prefix="timelegs-")
    return _own_folder.name


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_folder(spark).rstrip('/')}/timelegs-{name}-{uuid.uuid4().hex}"


def placed(spark: SparkSession, path: str):
    """A path and the store that it is in."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files, in whatever store it is; nothing if it is not there."""
    place, store = placed(spark, path)
    store.delete(place, True)


def stage(name: str, build) -> DataFrame:
    """The table ``name`` of this application: written from ``build()`` the first time it is
    asked for, read back from then on. Name it after everything that it depends on."""
    spark = SparkSession.active()
    key = (spark.sparkContext.applicationId, name)
    if key not in _written:
        df = build()
        path = f"{shared_folder(spark).rstrip('/')}/timelegs-{uuid.uuid4().hex}"
        sinks.write_parquet(df, path, allow_empty=True)
        _written[key] = path
    return spark.read.parquet(_written[key])
