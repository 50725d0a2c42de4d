"""From raw segments to cleaned segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timelegs.functions import clock, measures, text
from timelegs.operators.joins import BROADCAST_ROW_LIMIT
from timelegs.operators.records import beside
from timelegs.schemas import REQUIRED_TEXT
from timelegs.sources import sinks
from timelegs.sources.stage import new_folder

# Fixed value: whisker length of the interquartile fence.
FENCE_FACTOR = 1.5


def positive_runtime() -> Column:
    return F.col("runtime_seconds") > 0


def forward_sequence() -> Column:
    return F.col("to_sequence") > F.col("from_sequence")


def distinct_ends() -> Column:
    return F.col("from_stop_ref") != F.col("to_stop_ref")


def is_valid_segment() -> Column:
    """The rules a row must meet to be kept. A NULL operand fails its rule."""
    return text.all_present(REQUIRED_TEXT) & positive_runtime() & forward_sequence() & distinct_ends()


def drop_exact_duplicates(raw: DataFrame) -> DataFrame:
    return raw.dropDuplicates()


def drop_few_duplicates(rows: DataFrame) -> DataFrame:
    """``drop_exact_duplicates`` of rows of which few are repeated, without a shuffle of whole rows.

    Only 64-bit hashes of the rows are shuffled, in a job of its own, and those that occur twice or
    more are written. A row whose hash occurs once has no copy and stays where it is; the others,
    copies or not, are de-duplicated by all their columns. With more repeated hashes than fit a
    broadcast, all rows are.
    """
    spark = rows.sparkSession
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).alias("_hash")
    repeated = rows.select(hashed).groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select("_hash")
    path = new_folder(spark, "repeated")
    if sinks.write_parquet(repeated, path, allow_empty=True) > BROADCAST_ROW_LIMIT:
        return drop_exact_duplicates(rows)
    known = F.broadcast(spark.read.schema("_hash bigint").parquet(path))
    marked = rows.select("*", hashed)
    several = marked.join(known, "_hash", "left_semi").select(*rows.columns)
    return marked.join(known, "_hash", "left_anti").select(*rows.columns).unionByName(drop_exact_duplicates(several))


def add_time_features(segments: DataFrame) -> DataFrame:
    """departure_hour, is_peak_hour, time_of_day and segment_key."""
    return (
        segments.withColumn("departure_hour", clock.departure_hour("departure_time"))
        .withColumns(
            {
                "is_peak_hour": clock.is_peak("departure_hour"),
                "time_of_day": clock.time_of_day("departure_hour"),
                "segment_key": text.segment_key("from_stop_ref", "to_stop_ref"),
            }
        )
    )


def clean_segments(raw: DataFrame) -> DataFrame:
    """Unique, complete, plausible segments with their time features.

    The rules are row-wise, so Catalyst runs them below the de-duplication: rejected
    rows are never shuffled.
    """
    return add_time_features(drop_exact_duplicates(raw).filter(is_valid_segment()))


def clean_mostly_unique(raw: DataFrame) -> DataFrame:
    """``clean_segments`` of rows of which few are repeated; a job runs when it is called."""
    return add_time_features(drop_few_duplicates(raw.filter(is_valid_segment())))


def iqr_fence(segments: DataFrame, accuracy: int = measures.QUANTILE_ACCURACY) -> DataFrame:
    """One row: quartiles of runtime_minutes, their range and the upper limit."""
    quartiles = segments.agg(
        measures.quantile("runtime_minutes", 0.25, accuracy).alias("q1"),
        measures.quantile("runtime_minutes", 0.75, accuracy).alias("q3"),
    )
    return quartiles.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn(
        "upper_limit", F.col("q3") + F.lit(FENCE_FACTOR) * F.col("iqr")
    )


def flag_high_durations(segments: DataFrame, fence: DataFrame) -> DataFrame:
    """Adds is_iqr_high_duration. The fence is a scalar subquery, so it stays in the plan."""
    limit = fence.select("upper_limit").scalar()
    return segments.withColumn(
        "is_iqr_high_duration", F.when(F.col("runtime_minutes") > limit, 1).otherwise(0)
    )


def cleaned_and_flagged(raw: DataFrame) -> DataFrame:
    segments = clean_segments(raw)
    return flag_high_durations(segments, iqr_fence(segments))


def quality_funnel(raw: DataFrame) -> DataFrame:
    """One row of cleaning counters, from a single shuffle of fingerprints of the raw rows.

    Defect counters overlap: they are taken over all unique rows with complete keys. A row goes
    out as two 64-bit hashes, its NULLs and its defects; of 10^12 different rows, two have one
    fingerprint with a probability of about 10^-15.
    """
    complete = text.all_present(REQUIRED_TEXT)
    defects = {
        "complete_records": complete,
        "zero_runtime_records": complete & (F.col("runtime_seconds") == 0),
        "invalid_sequence_records": complete & (F.col("to_sequence") <= F.col("from_sequence")),
        "identical_stop_records": complete & (F.col("from_stop_ref") == F.col("to_stop_ref")),
        "final_cleaned_records": is_valid_segment(),
    }
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in raw.columns])
    columns = [F.col(f"`{c}`") for c in raw.columns]
    fingerprint = [
        F.xxhash64(*columns, nulls).alias("_one"),
        F.xxhash64(F.lit("second"), nulls, *columns).alias("_two"),
    ]
    flags = [F.coalesce(holds, F.lit(False)).alias(name) for name, holds in defects.items()]
    unique = raw.select(*fingerprint, *flags).groupBy("_one", "_two", *defects).agg(F.count(F.lit(1)).alias("_copies"))
    counted = unique.agg(
        F.sum("_copies").alias("raw_records"),
        F.count(F.lit(1)).alias("deduplicated_records"),
        *[F.count_if(F.col(name)).alias(name) for name in defects],
    )
    raw_rows = F.coalesce(F.col("raw_records"), F.lit(0))
    return counted.select(
        raw_rows.alias("raw_records"),
        (raw_rows - F.col("deduplicated_records")).alias("duplicates_removed"),
        (F.col("deduplicated_records") - F.col("complete_records")).alias(
            "missing_required_records_removed"
        ),
        "zero_runtime_records",
        "invalid_sequence_records",
        "identical_stop_records",
        "final_cleaned_records",
        (raw_rows - F.col("final_cleaned_records")).alias("total_records_removed"),
    )


def cleaning_summary(raw: DataFrame, flagged: DataFrame, fence: DataFrame) -> DataFrame:
    """The funnel with the fence and the number of flagged rows beside it, still one row."""
    high = flagged.agg(F.count_if(F.col("is_iqr_high_duration") == 1).alias("high_duration_records_retained"))
    limits = fence.select(
        F.col("q1").alias("runtime_q1_minutes"),
        F.col("q3").alias("runtime_q3_minutes"),
        F.col("iqr").alias("runtime_iqr_minutes"),
        F.col("upper_limit").alias("upper_iqr_limit_minutes"),
    )
    return beside(quality_funnel(raw), limits, high)
