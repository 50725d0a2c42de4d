"""Measures that can be merged, kept in tables: distinct counts as bitmaps, quantiles as sketches.

Every distinct key gets a number from 1 on, without gaps, in the order of the group that it is
mostly asked for, so that a group's keys lie in few bitmaps. A bitmap holds 32,768 numbers. A
written table of bitmaps by fine groups answers any coarser grouping by a union of bitmaps, never
by another pass over the rows, and its size follows the keys, not the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.operators.serving import assign_ids


def key_bitmaps(rows: DataFrame, groups: list[str], key: list[str]) -> DataFrame:
    """(groups, bucket, bitmap) over the keys of each group; keys with a NULL part don't count.

    Rows are reduced to (groups, key) before anything is shuffled, so a group or a key with a
    third of all rows is spread over the tasks.
    """
    held = rows.select(*groups, *key).dropna(subset=key).distinct()
    first = reduce(lambda a, b: F.least(a, b), [F.min(F.col(c).cast("string")) for c in groups[:1]])
    numbers = assign_ids(held.groupBy(*key).agg(first.alias("_group")), "_number", ["_group", *key])
    named = numbers.select(*[F.col(c).alias(f"_key_{i}") for i, c in enumerate(key)], "_number")
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_key_{i}") for i, c in enumerate(key)])
    numbered = held.join(named, on)
    bit = F.bitmap_construct_agg(F.bitmap_bit_position("_number"))
    return numbered.groupBy(*groups, F.bitmap_bucket_number("_number").alias("bucket")).agg(bit.alias("bitmap"))


def distinct_keys(bitmaps: DataFrame, by: list[str], name: str) -> DataFrame:
    """How many distinct keys each group of ``by`` has; one row in all if there are no columns."""
    united = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return united.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name))


# Size of a sketch, and the share of the rows that a rank is off by at most (the
# sketch's own bound at this size is 0.0013 with 99 % probability).
SKETCH_SIZE = 2048
RANK_ERROR = 0.01


def quantile_sketches(rows: DataFrame, groups: list[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """(groups, sketch): a bounded sketch of the known values of each group, to be written and merged."""
    known = rows.filter(F.col(value).isNotNull())
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size))
    return known.groupBy(*groups).agg(sketch.alias("sketch"))


def quantiles_of(sketches: DataFrame, by: list[str], points: dict[str, float]) -> DataFrame:
    """(by, rows, quantiles) of any coarser grouping, from the sketches alone.

    A quantile is an element of the data; its rank is off by ``RANK_ERROR`` of the rows at most.
    """
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in points.items()]
    return merged.select(*by, F.kll_sketch_get_n_double("sketch").alias("rows"), *found)
