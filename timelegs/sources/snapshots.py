"""Published sets of tables: written beside each other, and switched by one small pointer.

A set is written to a folder of its own, which no reader knows of. Then a pointer, a file whose name
is the next number and whose text names the folder, is created; a reader takes the highest pointer
that is complete. Nothing that a reader may be using is renamed or deleted on the way, so a failure
at any step leaves the set before in place, in any store: no step needs a rename, and a pointer that
was written half-way doesn't count. Two publishers can't take one number; the later one tries the
next. Old sets are removed by ``prune`` when their readers are done.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from timelegs.sources.stage import placed, remove_folder

POINTERS, SETS = "_pointers", "sets"
DIGITS = 10
END = "\n"


def new_set(base: str) -> str:
    """A folder for the next set below ``base``; nobody finds it before it is published."""
    return f"{base.rstrip('/')}/{SETS}/{uuid.uuid4().hex}"


def _pointers(spark: SparkSession, base: str) -> list[str]:
    """Names of the pointers, the latest first."""
    folder, store = placed(spark, f"{base.rstrip('/')}/{POINTERS}")
    if not store.exists(folder):
        return []
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    return sorted((n for n in names if n.isdigit()), reverse=True)


def _target(spark: SparkSession, base: str, name: str) -> str | None:
    """The set that a pointer names, or None if the pointer isn't complete."""
    place, store = placed(spark, f"{base.rstrip('/')}/{POINTERS}/{name}")
    stream = store.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{base.rstrip('/')}/{SETS}/{text.strip()}" if text.endswith(END) else None


def published(spark: SparkSession, base: str) -> str:
    """The folder of the set that was published last; an error if there is none."""
    for name in _pointers(spark, base):
        found = _target(spark, base, name)
        if found is not None:
            return found
    raise FileNotFoundError(f"nothing has been published below {base}")


def publish(spark: SparkSession, base: str, written: str) -> None:
    """Make a written set, a folder from ``new_set``, the one that readers find."""
    number = 1 + max((int(n) for n in _pointers(spark, base)), default=0)
    while True:
        place, store = placed(spark, f"{base.rstrip('/')}/{POINTERS}/{number:0{DIGITS}d}")
        try:
            stream = store.create(place, False)
        except Exception as error:
            if "FileAlreadyExistsException" in str(error) and store.exists(place):
                number += 1
                continue
            raise
        try:
            stream.write((written.rstrip("/").rsplit("/", 1)[1] + END).encode())
        finally:
            stream.close()
        return


def prune(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Remove all published sets but the last ``keep``, pointer before set.

    Sets that have no pointer are left: they may be in the making.
    """
    for name in _pointers(spark, base)[max(1, keep) :]:
        found = _target(spark, base, name)
        remove_folder(spark, f"{base.rstrip('/')}/{POINTERS}/{name}")
        if found is not None:
            remove_folder(spark, found)
