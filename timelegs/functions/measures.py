"""Aggregate expressions used by more than one report."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timelegs.functions.text import col

# Fixed value: sketch accuracy; the rank error is at most rows / accuracy.
QUANTILE_ACCURACY = 10_000


def quantile(value: Column | str, p: float, accuracy: int = QUANTILE_ACCURACY) -> Column:
    """Quantile that is an element of the data, from a bounded, mergeable sketch.

    The rank of the answer is off by ``rows / accuracy`` at most; memory per group is bounded
    by ``accuracy``. Where the rank has to be right, use ``exact_quantiles``.
    """
    return F.percentile_approx(col(value), F.lit(p), F.lit(accuracy))


# Bits of a number that one pass tells apart; a double has four such digits.
DIGIT_BITS = 16


def ordered_bits(value: Column) -> Column:
    """A double as a bigint that has the same order; 0.0 and -0.0 are one value, NaN is the greatest."""
    text = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0))
    bits = text.cast("bigint")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit((1 << 63) - 1)))


def exact_quantiles(df: DataFrame, value: str, points: Mapping[str, float]) -> DataFrame:
    """One row: for each name the element of rank ``ceil(p n)`` of the known values, NULL without any."""
    v = F.col(value).cast("double")
    keys = df.select(v.alias("v")).filter("v IS NOT NULL").select("v", ordered_bits(F.col("v")).alias("bits"))
    return _select_ranks(keys, {name: (lambda n, p=p: F.greatest(F.lit(1), F.ceil(F.lit(p) * n))) for name, p in points.items()})


def kth_smallest(df: DataFrame, value: str, k: int, name: str = "kth") -> DataFrame:
    """One row: the ``k``-th smallest of the known values of a bigint, the greatest if there are fewer."""
    keys = df.select(F.col(value).cast("bigint").alias("v")).filter("v IS NOT NULL").withColumn("bits", F.col("v"))
    return _select_ranks(keys, {name: lambda n: F.least(F.lit(k).cast("bigint"), n)})


def _select_ranks(keys: DataFrame, ranks: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """One row: for each name the value ``v`` whose rank by ``bits`` is that function of their number.

    Radix selection: a pass counts the values by their next 16 bits, among those that share the
    bits found so far, for all ranks at once. Four passes over one column settle every rank
    whatever the number of values and of ranks; a pass holds at most 65,536 counts a rank, and
    what goes into the next one is a row for each rank. All of it is one lazy plan.
    """
    counted = [F.count(F.lit(1)).alias("n"), F.min("v").alias("v")]
    digit = keys.groupBy(F.shiftright("bits", 64 - DIGIT_BITS).alias("prefix")).agg(*counted)
    upto = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)  # at most 65,536 rows
    totals = digit.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy())})
    wanted = [F.struct(F.lit(i).alias("point"), rank(F.col("all")).cast("bigint").alias("rank")) for i, rank in enumerate(ranks.values())]
    found = _digit_of_rank(totals.select("*", F.inline(F.array(*wanted))))
    for shift in range(64 - 2 * DIGIT_BITS, -1, -DIGIT_BITS):
        known = F.broadcast(found.select("point", "rank", F.col("prefix").alias("known")))  # a row for each rank
        inside = keys.join(known, F.shiftright("bits", shift + DIGIT_BITS) == F.col("known"))
        digit = inside.groupBy("point", "rank", F.shiftright("bits", shift).alias("prefix")).agg(*counted)
        upto = Window.partitionBy("point").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        found = _digit_of_rank(digit.withColumn("upto", F.sum("n").over(upto)))
    return found.agg(*[F.max(F.when(F.col("point") == i, F.col("v"))).alias(name) for i, name in enumerate(ranks)])


def _digit_of_rank(counts: DataFrame) -> DataFrame:
    """The digit that holds the rank, and the rank among the values that have it."""
    before = F.col("upto") - F.col("n")
    held = counts.filter((before < F.col("rank")) & (F.col("rank") <= F.col("upto")))
    return held.select("point", (F.col("rank") - before).alias("rank"), "prefix", "v")


def exact_quantile(df: DataFrame, value: str, p: float) -> float | None:
    """The single value of ``exact_quantiles``."""
    return exact_quantiles(df, value, {"value": p}).first()["value"]


def percent_of_flags(flag: Column | str, digits: int = 4) -> Column:
    """Mean of a 0/1 flag as a percentage."""
    return F.round(F.lit(100.0) * F.avg(col(flag)), digits)


def percentage(part: Column, whole: Column, digits: int = 4) -> Column:
    """``100·part/whole``; 0 when there is no whole."""
    return F.coalesce(F.round(F.try_divide(F.lit(100.0) * part, whole), digits), F.lit(0.0))
