"""Profiles of raw segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.functions import measures, text


def missing_counts(df: DataFrame) -> DataFrame:
    """One row: how many NULL or blank values each column has."""
    return df.agg(*[F.count_if(text.is_blank(c)).alias(c) for c in df.columns])


def runtime_quality(raw: DataFrame) -> DataFrame:
    seconds = F.col("runtime_seconds")
    return raw.agg(
        F.count_if(seconds > 0).alias("positive_runtime_rows"),
        F.count_if(seconds == 0).alias("zero_runtime_rows"),
        F.count_if(seconds.isNull()).alias("missing_runtime_rows"),
    )


def duplicate_counts(raw: DataFrame) -> DataFrame:
    unique = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return unique.agg(
        F.sum("_copies").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (F.sum("_copies") - F.count(F.lit(1))).alias("duplicate_rows"),
    )


def runtime_summary(raw: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of the positive run times."""
    value = "runtime_minutes"
    return raw.filter(F.col("runtime_seconds") > 0).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        measures.quantile(value, 0.25).alias("p25"),
        measures.quantile(value, 0.50).alias("p50"),
        measures.quantile(value, 0.75).alias("p75"),
        F.max(value).alias("max"),
    )


def journey_keys(raw: DataFrame) -> DataFrame:
    """Distinct journeys: (source_file, vehicle_journey_code)."""
    return raw.select("source_file", "vehicle_journey_code").distinct()


def stops_of_both_ends(segments: DataFrame) -> DataFrame:
    """Distinct non-NULL stop references over both ends of the segments."""
    return (
        segments.select(F.explode(F.array("from_stop_ref", "to_stop_ref")).alias("stop_ref"))
        .filter(F.col("stop_ref").isNotNull())
        .distinct()
    )


def coverage(raw: DataFrame) -> DataFrame:
    """One row: distinct lines, stops and journeys.

    Three column-pruned distinct counts rather than one aggregate with three DISTINCTs,
    which would triple every row before its shuffle.
    """
    lines = raw.filter(F.col("line_ref").isNotNull()).select("line_ref").distinct()
    stops = stops_of_both_ends(raw)
    count = F.count(F.lit(1))
    return (
        journey_keys(raw)
        .agg(count.alias("unique_journeys"))
        .withColumns(
            {
                "unique_routes": lines.agg(count.alias("n")).scalar(),
                "unique_stops": stops.agg(count.alias("n")).scalar(),
            }
        )
    )


def moments(segments: DataFrame, value: str = "runtime_minutes") -> DataFrame:
    return segments.agg(
        F.stddev_samp(value).alias("standard_deviation"),
        F.skewness(value).alias("skewness"),
        F.kurtosis(value).alias("kurtosis"),
    )


def quantiles(
    df: DataFrame, value: str, points: dict[str, float], accuracy: int = measures.QUANTILE_ACCURACY
) -> DataFrame:
    """One row of named quantiles, all read from one sketch."""
    sketch = F.percentile_approx(
        F.col(value), F.array(*[F.lit(p) for p in points.values()]), F.lit(accuracy)
    )
    return df.agg(sketch.alias("_q")).select(
        *[F.col("_q")[i].alias(name) for i, name in enumerate(points)]
    )


def preview(df: DataFrame, columns: list[str], order_by: list[str], rows: int) -> DataFrame:
    """The first rows under a stated order, so that two runs show the same ones."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).select(*columns).limit(rows)


def even_group_counts(ids: DataFrame, id_column: str = "id") -> DataFrame:
    """Squares of the ids, and counts of the even ones by last digit."""
    squared = ids.withColumn("square", F.col(id_column) * F.col(id_column))
    return (
        squared.filter(F.col(id_column) % 2 == 0)
        .groupBy((F.col(id_column) % 10).alias("group_number"))
        .agg(F.count("square").alias("count"))
        .orderBy("group_number")
    )
