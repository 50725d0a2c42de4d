"""Descriptive reports over cleaned segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.functions import clock, measures
from timelegs.operators.records import beside

# Report sizes and the smallest line the flagged-share report keeps.
LONGEST_ROWS = 100
TOP_ROUTES = 10
MIN_ROUTE_RECORDS = 500
RESIDUAL_BINS = 40


def _mean(column: str, digits: int = 4):
    return F.round(F.avg(column), digits)


def _deviation(column: str, digits: int = 4):
    return F.round(F.stddev_samp(column), digits)


def _flag_measures():
    return [
        F.sum("is_iqr_high_duration").alias("high_duration_records"),
        measures.percent_of_flags("is_iqr_high_duration").alias("high_duration_percentage"),
    ]


def _centre_measures():
    return [
        F.count(F.lit(1)).alias("record_count"),
        _mean("runtime_minutes").alias("average_runtime_minutes"),
        measures.quantile("runtime_minutes", 0.50).alias("median_runtime_minutes"),
        _deviation("runtime_minutes").alias("standard_deviation_minutes"),
    ]


def distinct_counts(segments: DataFrame) -> DataFrame:
    """Rows and distinct lines, segments and journeys; a journey with a NULL part is not counted.

    Each count is a column-pruned aggregate of its own; one aggregate with three DISTINCTs
    would repeat every row three times before its shuffle.
    """

    def distinct(*columns: str):
        known = segments.select(*columns).dropna(how="any").distinct()
        return known.agg(F.count(F.lit(1)).alias("n")).scalar()

    return segments.agg(F.count(F.lit(1)).alias("record_count")).withColumns(
        {
            "unique_service_lines": distinct("line_ref"),
            "unique_segments": distinct("segment_key"),
            "unique_vehicle_journeys": distinct("source_file", "vehicle_journey_code"),
        }
    )


def overall_statistics(segments: DataFrame) -> DataFrame:
    """One row of 17 measures.

    The distinct counts are an aggregate of their own. Together with the quantile sketches
    they would force one sketch per distinct key.
    """
    v = "runtime_minutes"
    counts = distinct_counts(segments).drop("record_count")
    measured = segments.agg(
        F.count(F.lit(1)).alias("record_count"),
        _mean(v).alias("mean_runtime_minutes"),
        measures.quantile(v, 0.50).alias("median_runtime_minutes"),
        _deviation(v).alias("standard_deviation_minutes"),
        F.round(F.skewness(v), 4).alias("runtime_skewness"),
        F.round(F.kurtosis(v), 4).alias("runtime_kurtosis"),
        F.min(v).alias("minimum_runtime_minutes"),
        measures.quantile(v, 0.25).alias("first_quartile_minutes"),
        measures.quantile(v, 0.75).alias("third_quartile_minutes"),
        measures.quantile(v, 0.95).alias("percentile_95_minutes"),
        measures.quantile(v, 0.99).alias("percentile_99_minutes"),
        F.max(v).alias("maximum_runtime_minutes"),
        *_flag_measures(),
    )
    return beside(measured, counts)


def runtime_distribution(segments: DataFrame) -> DataFrame:
    """Rows per run time and their share of all rows."""
    counts = segments.groupBy("runtime_minutes").agg(F.count(F.lit(1)).alias("record_count"))
    total = segments.agg(F.count(F.lit(1)).alias("total_records")).scalar()
    share = F.round(F.lit(100.0) * F.col("record_count") / total, 4)
    return counts.withColumn("percentage", share).orderBy("runtime_minutes")


def time_of_day_summary(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("time_of_day")
        .agg(*_centre_measures(), *_flag_measures())
        .orderBy(clock.period_rank("time_of_day"))
    )


def peak_summary(segments: DataFrame) -> DataFrame:
    label = F.when(F.col("is_peak_hour") == 1, "Peak").otherwise("Off-peak").alias("period_type")
    measured = segments.groupBy("is_peak_hour").agg(*_centre_measures(), *_flag_measures())
    return measured.orderBy(F.col("is_peak_hour").desc()).select(label, *measured.columns[1:])


def route_summary(segments: DataFrame) -> DataFrame:
    """Eleven measures per line, largest line first.

    Distinct keys are counted apart from the sketches, as in the overall statistics. Rows
    are first reduced to (line, key), so a line with a third of all rows is spread over the
    tasks by its keys.
    """
    per_line = segments.groupBy("line_ref").agg(
        *_centre_measures(),
        F.min("runtime_minutes").alias("minimum_runtime_minutes"),
        F.max("runtime_minutes").alias("maximum_runtime_minutes"),
        *_flag_measures(),
    )

    def with_distinct(lines: DataFrame, name: str, *columns: str) -> DataFrame:
        known = segments.select(F.col("line_ref").alias("_line"), *columns).distinct()
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        counts = known.groupBy("_line").agg(F.count_if(whole).alias(name))
        return lines.join(counts, F.col("line_ref").eqNullSafe(F.col("_line"))).drop("_line")

    joined = with_distinct(per_line, "unique_segments", "segment_key")
    joined = with_distinct(joined, "unique_vehicle_journeys", "source_file", "vehicle_journey_code")
    key_counts = ["unique_segments", "unique_vehicle_journeys"]
    ordered = joined.select("line_ref", "record_count", *key_counts, *per_line.columns[2:])
    return ordered.orderBy(F.col("record_count").desc(), "line_ref")


def high_duration_routes(segments: DataFrame, min_records: int = MIN_ROUTE_RECORDS) -> DataFrame:
    """Flagged share of every line with enough records, highest share first."""
    return (
        segments.groupBy("line_ref")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            *_flag_measures(),
            _mean("runtime_minutes").alias("average_runtime_minutes"),
            F.max("runtime_minutes").alias("maximum_runtime_minutes"),
        )
        .filter(F.col("record_count") >= min_records)
        .orderBy(F.col("high_duration_percentage").desc(), F.col("record_count").desc(), "line_ref")
    )


LONGEST_COLUMNS = [
    "line_ref",
    "vehicle_journey_code",
    "departure_time",
    "time_of_day",
    "from_stop_ref",
    "to_stop_ref",
    "runtime_minutes",
    "is_iqr_high_duration",
]


def longest_segments(segments: DataFrame, rows: int = LONGEST_ROWS) -> DataFrame:
    """The longest scheduled segments; ties are settled by the remaining columns."""
    ties = [F.col(c).asc_nulls_last() for c in LONGEST_COLUMNS if c != "runtime_minutes"]
    return (
        segments.select(*LONGEST_COLUMNS)
        .orderBy(F.col("runtime_minutes").desc_nulls_last(), *ties)
        .limit(rows)
    )


def top_routes(segments: DataFrame, rows: int = TOP_ROUTES) -> DataFrame:
    return (
        segments.groupBy("line_ref")
        .agg(
            F.count(F.lit(1)).alias("segment_records"),
            _mean("runtime_minutes").alias("average_runtime_minutes"),
        )
        .orderBy(F.col("segment_records").desc(), "line_ref")
        .limit(rows)
    )


def equal_width_histogram(df: DataFrame, value: str, bins: int = RESIDUAL_BINS) -> DataFrame:
    """Counts over equal-width bins between the extremes; the last bin is closed above."""
    known = df.filter(F.col(value).isNotNull())
    lowest = known.agg(F.min(value).alias("v")).scalar()
    highest = known.agg(F.max(value).alias("v")).scalar()
    placed = known.select(F.col(value), lowest.alias("_lo"), highest.alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    position = F.floor(F.try_divide(F.col(value) - F.col("_lo"), width))
    bin_number = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        placed.groupBy(bin_number.alias("bin"), "_lo", "_hi")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select(
            "bin",
            (F.col("_lo") + F.col("bin") * width).alias("lower_edge"),
            (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper_edge"),
            "record_count",
        )
        .orderBy("bin")
    )
