"""Joining a large table to another one without assuming how large or how even it is.

A side is broadcast only after its rows were counted against a limit. Beyond the limit the
join shuffles, and keys that hold a large share of the rows are split over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Narrow dimension rows of a few hundred bytes: at most some hundred MB per executor.
BROADCAST_ROW_LIMIT = 1_000_000

# A key with more rows than this is split into parts of about so many.
ROWS_PER_TASK = 1_000_000
# Never more hot keys than this, whatever the number of rows: their list is broadcast.
MOST_HOT_KEYS = 10_000
# Rows without a key match nothing; they are dealt over so many parts.
NULL_PARTS = 1 << 20


def fits_broadcast(df: DataFrame, row_limit: int = BROADCAST_ROW_LIMIT) -> bool:
    """Whether ``df`` has at most ``row_limit`` rows.

    A plain count adds one number per task. Counting a limited frame would first bring up to
    ``row_limit`` rows of every partition together in one task.
    """
    return df.count() <= row_limit


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    how: str = "left",
    row_limit: int = BROADCAST_ROW_LIMIT,
    small: bool | None = None,
) -> DataFrame:
    """Join ``fact`` to ``lookup`` on ``{fact column: lookup column}``; lookup keys are dropped.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. Pass ``small`` when the
    lookup was measured already, e.g. because it is joined twice.
    """
    if small is None:
        small = fits_broadcast(lookup, row_limit)
    if not small:
        return hot_key_join(fact, lookup, on, how)
    joined = fact.join(F.broadcast(lookup), _equal(fact, lookup, on), how)
    return _without(joined, lookup, on, how)


def hot_keys(fact: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> list[Row]:
    """Keys with more than ``rows_per_task`` rows, and in ``_splits`` how many tasks they need.

    One pass over the keys. At most ``MOST_HOT_KEYS`` come to the driver: a key that would need
    more room on the list holds less than that share of the rows.
    """
    counts = fact.dropna(how="any", subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large = counts.filter(F.col("_rows") > rows_per_task).orderBy(F.desc("_rows"), *keys)
    splits = F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_splits")
    return large.limit(MOST_HOT_KEYS).select(*keys, splits).collect()


def hot_key_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Shuffled equi join whose hot keys are split and whose rows without a key are dealt out.

    Rows of a hot key go to as many parts as they need tasks, and only the lookup rows of hot
    keys are repeated to meet them; all others are in part 0. Where nothing is hot it is a plain
    join. The part is a hash of the row, not a random number: a task that is run again after a
    lost executor puts its rows in the same parts.
    """
    left_keys, right_keys = list(on), list(on.values())
    names = [f"_hot_{i}" for i in range(len(on))]
    found = hot_keys(fact, left_keys, rows_per_task)
    place = F.xxhash64(*fact.columns)
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in left_keys])
    part = F.when(missing, F.pmod(place, F.lit(NULL_PARTS)) + 1).otherwise(F.lit(0))
    parts = F.array(F.lit(0))
    marked_fact, marked_lookup = fact, lookup
    if found:
        types = [fact.select(k).schema[0].dataType for k in left_keys]
        schema = StructType([StructField(n, t) for n, t in zip(names, types)])
        hot = fact.sparkSession.createDataFrame(
            [tuple(r) for r in found], schema.add("_splits", "integer")
        )

        def mark(df: DataFrame, keys: list[str]) -> DataFrame:
            same = reduce(lambda a, b: a & b, [df[k] == hot[n] for k, n in zip(keys, names)])
            return df.join(F.broadcast(hot), same, "left").drop(*names)

        marked_fact, marked_lookup = mark(fact, left_keys), mark(lookup, right_keys)
        part = F.coalesce(F.pmod(place, F.col("_splits")), part)
        parts = F.coalesce(F.sequence(F.lit(0), F.col("_splits") - 1), parts)
    spread = marked_fact.withColumn("_split", part.cast("int")).drop("_splits")
    repeated = marked_lookup.withColumn("_lookup_split", F.explode(parts)).drop("_splits")
    condition = _equal(spread, repeated, on) & (spread["_split"] == repeated["_lookup_split"])
    joined = spread.join(repeated, condition, how)
    return _without(joined, repeated, on, how).drop("_split", "_lookup_split")


def _equal(left: DataFrame, right: DataFrame, on: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in on.items()])


def _without(joined: DataFrame, lookup: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[lookup[c] for c in on.values()])
