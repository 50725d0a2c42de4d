"""Cleaning, profiling and row-level expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from timelegs.functions import clock, durations, geo, measures, text
from timelegs.operators import cleaning, profiling
from timelegs.operators.records import beside
from timelegs.registry.book import COMPLETE, RAW_COLUMNS, blank, query
from timelegs.schemas import RAW_SEGMENTS
from timelegs.sources import sinks
from timelegs.sources.stage import new_folder
from timelegs.sources.tables import metrics_record, read_parquet, read_raw_segments

# The largest number that a bigint holds.
LONGEST = (1 << 63) - 1


@query(
    "clean_funnel",
    f"""
    SELECT (SELECT count(*) FROM raw) AS raw_records,
           (SELECT count(*) FROM raw) - count(*) AS duplicates_removed,
           count(*) - count(*) FILTER (WHERE {COMPLETE}) AS missing_required_records_removed,
           count(*) FILTER (WHERE {COMPLETE} AND runtime_seconds = 0) AS zero_runtime_records,
           count(*) FILTER (WHERE {COMPLETE} AND to_sequence <= from_sequence)
               AS invalid_sequence_records,
           count(*) FILTER (WHERE {COMPLETE} AND from_stop_ref = to_stop_ref) AS identical_stop_records,
           (SELECT count(*) FROM cleaned) AS final_cleaned_records,
           (SELECT count(*) FROM raw) - (SELECT count(*) FROM cleaned) AS total_records_removed
    FROM (SELECT DISTINCT * FROM raw) u
    """,
    ["raw", "cleaned"],
)
def clean_funnel(net):
    return cleaning.quality_funnel(net.raw)


@query("dedup_rows", "SELECT DISTINCT * FROM raw", ["raw"])
def dedup_rows(net):
    return cleaning.drop_exact_duplicates(net.raw)


@query(
    "duplicate_counts",
    """
    SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM raw) u) AS distinct_rows,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw) u) AS duplicate_rows
    FROM raw
    """,
    ["raw"],
)
def duplicate_counts(net):
    return profiling.duplicate_counts(net.raw)


@query(
    "cleaned_segments",
    """
    SELECT source_file, vehicle_journey_code, line_ref, departure_time, from_sequence, to_sequence,
           from_stop_ref, to_stop_ref, runtime_seconds, runtime_minutes, hour AS departure_hour,
           is_peak_hour, time_of_day, segment_key
    FROM cleaned
    """,
    ["cleaned"],
)
def cleaned_segments(net):
    return net.cleaned.select(
        "source_file",
        "vehicle_journey_code",
        "line_ref",
        "departure_time",
        "from_sequence",
        "to_sequence",
        "from_stop_ref",
        "to_stop_ref",
        "runtime_seconds",
        "runtime_minutes",
        "departure_hour",
        "is_peak_hour",
        "time_of_day",
        "segment_key",
    )


@query(
    "iqr_flagged",
    """
    SELECT vehicle_timing_link_id, segment_key, runtime_minutes, is_iqr_high_duration,
           (SELECT q1 FROM fence) AS q1, (SELECT q3 FROM fence) AS q3,
           (SELECT q3 + 1.5 * (q3 - q1) FROM fence) AS upper_limit
    FROM segments
    """,
    ["segments", "fence"],
)
def iqr_flagged(net):
    fence = cleaning.iqr_fence(net.cleaned).select("q1", "q3", "upper_limit")
    flagged = cleaning.flag_high_durations(net.cleaned, fence)
    columns = ["vehicle_timing_link_id", "segment_key", "runtime_minutes", "is_iqr_high_duration"]
    return beside(flagged.select(*columns), fence)


@query(
    "missing_counts",
    "SELECT "
    + ", ".join(f"count(*) FILTER (WHERE {blank(c)}) AS {c}" for c in RAW_COLUMNS)
    + " FROM raw",
    ["raw"],
)
def missing_counts(net):
    return profiling.missing_counts(net.raw)


@query(
    "runtime_quality",
    """
    SELECT count(*) FILTER (WHERE runtime_seconds > 0) AS positive_runtime_rows,
           count(*) FILTER (WHERE runtime_seconds = 0) AS zero_runtime_rows,
           count(*) FILTER (WHERE runtime_seconds IS NULL) AS missing_runtime_rows
    FROM raw
    """,
    ["raw"],
)
def runtime_quality(net):
    return profiling.runtime_quality(net.raw)


@query(
    "runtime_summary",
    """
    SELECT count(runtime_minutes) AS count, round(avg(runtime_minutes), 6) AS mean,
           round(stddev_samp(runtime_minutes), 6) AS stddev, min(runtime_minutes) AS min,
           quantile_disc(runtime_minutes, 0.25) AS p25, quantile_disc(runtime_minutes, 0.50) AS p50,
           quantile_disc(runtime_minutes, 0.75) AS p75, max(runtime_minutes) AS max
    FROM raw WHERE runtime_seconds > 0
    """,
    ["raw"],
)
def runtime_summary(net):
    summary = profiling.runtime_summary(net.raw)
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "coverage",
    """
    SELECT (SELECT count(DISTINCT line_ref) FROM raw) AS unique_routes,
           (SELECT count(*) FROM (SELECT from_stop_ref FROM raw UNION SELECT to_stop_ref FROM raw) s)
               AS unique_stops,
           (SELECT count(*) FROM (SELECT DISTINCT source_file, vehicle_journey_code FROM raw) j)
               AS unique_journeys
    """,
    ["raw"],
)
def coverage(net):
    return profiling.coverage(net.raw)


@query("journey_keys", "SELECT DISTINCT source_file, vehicle_journey_code FROM raw", ["raw"])
def journey_keys(net):
    return profiling.journey_keys(net.raw)


@query(
    "endpoint_stops",
    "SELECT from_stop_ref AS stop_ref FROM raw UNION SELECT to_stop_ref FROM raw",
    ["raw"],
)
def endpoint_stops(net):
    return profiling.stops_of_both_ends(net.raw)


@query(
    "moments",
    """
    SELECT round(stddev_samp(runtime_minutes), 4) AS standard_deviation,
           round((sum(cube) / count(*)) / pow(sum(square) / count(*), 1.5), 4) AS skewness,
           round((sum(square * square) / count(*)) / pow(sum(square) / count(*), 2) - 3, 4) AS kurtosis
    FROM (SELECT runtime_minutes, pow(runtime_minutes - mean, 2) AS square,
                 pow(runtime_minutes - mean, 3) AS cube
          FROM cleaned, (SELECT avg(runtime_minutes) AS mean FROM cleaned) m) d
    """,
    ["cleaned"],
)
def moments(net):
    return profiling.moments(net.cleaned).select(
        *[F.round(c, 4).alias(c) for c in ("standard_deviation", "skewness", "kurtosis")]
    )


@query(
    "quantiles",
    """
    SELECT quantile_disc(runtime_minutes, 0.25) AS p25, quantile_disc(runtime_minutes, 0.5) AS p50,
           quantile_disc(runtime_minutes, 0.75) AS p75, quantile_disc(runtime_minutes, 0.95) AS p95,
           quantile_disc(runtime_minutes, 0.99) AS p99
    FROM cleaned
    """,
    ["cleaned"],
)
def quantiles(net):
    points = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
    return profiling.quantiles(net.cleaned, "runtime_minutes", points)


@query(
    "fence_summary",
    """
    SELECT q1 AS runtime_q1_minutes, q3 AS runtime_q3_minutes, q3 - q1 AS runtime_iqr_minutes,
           q3 + 1.5 * (q3 - q1) AS upper_iqr_limit_minutes,
           (SELECT count(*) FROM segments WHERE is_iqr_high_duration = 1)
               AS high_duration_records_retained
    FROM fence
    """,
    ["fence", "segments"],
)
def fence_summary(net):
    summary = cleaning.cleaning_summary(net.raw, net.segments, cleaning.iqr_fence(net.cleaned))
    return summary.select(*summary.columns[-5:])


@query(
    "preview_rows",
    """
    SELECT vehicle_journey_code, line_ref, departure_time, from_stop_ref, to_stop_ref, runtime_minutes
    FROM raw
    ORDER BY vehicle_journey_code, line_ref, departure_time, from_stop_ref, to_stop_ref,
             runtime_minutes NULLS FIRST
    LIMIT 100
    """,
    ["raw"],
)
def preview_rows(net):
    columns = [
        "vehicle_journey_code",
        "line_ref",
        "departure_time",
        "from_stop_ref",
        "to_stop_ref",
        "runtime_minutes",
    ]
    return profiling.preview(net.raw, columns, columns, 100)


@query(
    "pruned_scan",
    "SELECT o_orderkey, o_orderpriority FROM orders",
)
def pruned_scan(net):
    return read_parquet(net.spark, f"{net.sf_dir}/orders.parquet", ["o_orderkey", "o_orderpriority"])


@query(
    "modulo_counts",
    """
    SELECT l_orderkey % 10 AS group_number, count(*) AS row_count,
           count(*) FILTER (WHERE l_orderkey % 2 = 0) AS even_rows,
           CAST(sum(l_orderkey * l_orderkey) AS BIGINT) AS sum_of_squares
    FROM lineitem GROUP BY 1
    """,
)
def modulo_counts(net):
    """Rows, even keys and the sum of squares of each remainder, the sums exactly.

    A sum of squares outgrows 64 bits long before its table does, so it is taken in decimals of 38
    digits. It is shown as the SQL's bigint while all sums fit into one, and as decimal(38,0) where
    one doesn't. The SQL itself ends with an error there. What comes to the driver is 20 rows at most.
    """
    key = F.col("l_orderkey")
    exact = key.cast("decimal(19,0)")
    counted = (
        net.table("lineitem")
        .withColumn("square", exact * exact)
        .groupBy((key % 10).alias("group_number"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(key % 2 == 0).alias("even_rows"),
            F.sum("square").alias("sum_of_squares"),
        )
    )
    groups = counted.collect()
    found = net.spark.createDataFrame(groups, counted.schema)
    if all(g["sum_of_squares"] is None or g["sum_of_squares"] <= LONGEST for g in groups):
        found = found.withColumn("sum_of_squares", F.col("sum_of_squares").cast("bigint"))
    return found.orderBy("group_number")


@query(
    "even_group_counts",
    """
    SELECT l_orderkey % 10 AS group_number, count(*) AS "count" FROM lineitem
    WHERE l_orderkey % 2 = 0 GROUP BY 1
    """,
)
def even_group_counts(net):
    return profiling.even_group_counts(net.table("lineitem"), "l_orderkey")


@query(
    "durations",
    """
    SELECT l_orderkey, l_linenumber, l_quantity,
           CASE WHEN l_linestatus = 'F' THEN minutes * 60 + l_linenumber
                WHEN l_returnflag = 'A' THEN minutes * 3600
                WHEN l_returnflag = 'N' THEN 0 END AS runtime_seconds,
           round(CASE WHEN l_linestatus = 'F' THEN minutes * 60 + l_linenumber
                      WHEN l_returnflag = 'A' THEN minutes * 3600
                      WHEN l_returnflag = 'N' THEN 0 END / 60.0, 3) AS runtime_minutes
    FROM lines
    """,
    ["lines"],
)
def run_times(net):
    """Minutes and seconds, hours alone, an empty ``PT`` and an invalid text, by line."""
    m, n = F.col("minutes").cast("string"), F.col("l_linenumber").cast("string")
    iso = (
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("PT"), m, F.lit("M"), n, F.lit("S")))
        .when(F.col("l_returnflag") == "A", F.concat(F.lit(" PT"), m, F.lit("H ")))
        .when(F.col("l_returnflag") == "N", F.lit("PT"))
        .otherwise(F.concat(F.lit("PT"), m, F.lit("M30")))
    )
    rows = net.lines.withColumn("runtime_seconds", durations.duration_seconds(iso))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "runtime_seconds",
        durations.seconds_to_minutes("runtime_seconds").alias("runtime_minutes"),
    )


@query(
    "runtime_classes",
    """
    SELECT CASE WHEN runtime_iso IS NULL THEN 'missing' WHEN runtime_iso = 'P1D' THEN 'invalid'
                WHEN runtime_seconds = 0 THEN 'zero' ELSE 'positive' END AS runtime_class,
           count(*) AS record_count
    FROM raw GROUP BY 1
    """,
    ["raw"],
)
def runtime_classes(net):
    kind = durations.runtime_class("runtime_iso").alias("runtime_class")
    return net.raw.groupBy(kind).agg(F.count(F.lit(1)).alias("record_count"))


@query(
    "event_hours",
    """
    SELECT CAST(hour(ts) AS INT) AS departure_hour,
           CASE WHEN hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 16 AND 18 THEN 1 ELSE 0 END
               AS is_peak_hour,
           CASE WHEN hour(ts) BETWEEN 5 AND 11 THEN 'Morning' WHEN hour(ts) BETWEEN 12 AND 16 THEN 'Afternoon'
                WHEN hour(ts) BETWEEN 17 AND 21 THEN 'Evening' ELSE 'Night' END AS time_of_day,
           count(*) AS event_count
    FROM events GROUP BY ALL
    """,
)
def event_hours(net):
    """The clock features over the times of day of the event stream."""
    hour = clock.departure_hour(F.date_format("ts", "H:mm:ss"))
    hours = net.table("events").groupBy(hour.alias("departure_hour")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    return hours.withColumns(
        {
            "is_peak_hour": clock.is_peak("departure_hour"),
            "time_of_day": clock.time_of_day("departure_hour"),
        }
    )


@query(
    "coord_validation",
    """
    SELECT c_custkey,
           CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN NULL
                WHEN abs(c_acctbal / 100) > 90 THEN NULL ELSE round(c_acctbal / 100, 4) END AS latitude,
           round(c_acctbal / 100, 4) AS longitude,
           CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') OR abs(c_acctbal / 100) > 90
                THEN 0 ELSE 1 END AS has_coordinates
    FROM customer
    """,
)
def coord_validation(net):
    """Coordinates read from text: numbers, a word, a blank, and numbers out of range."""
    number = (F.col("c_acctbal") / 100).cast("string")
    shown = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "n/a")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "  ")
        .otherwise(number)
    )
    points = net.table("customer").select(
        "c_custkey",
        geo.valid_coordinate(shown, geo.LATITUDE_LIMIT).alias("latitude"),
        geo.valid_coordinate(number, geo.LONGITUDE_LIMIT).alias("longitude"),
    )
    return points.select(
        "c_custkey",
        F.round("latitude", 4).alias("latitude"),
        F.round("longitude", 4).alias("longitude"),
        geo.has_both("latitude", "longitude").alias("has_coordinates"),
    )


@query(
    "first_non_blank",
    """
    SELECT stop_ref,
           CASE WHEN trim(naptan_common_name) <> '' THEN trim(naptan_common_name)
                ELSE timetable_common_name END AS shown_name
    FROM stops
    """,
    ["stops"],
)
def first_non_blank(net):
    shown = text.first_non_blank("naptan_common_name", "timetable_common_name", default="Unknown stop")
    return net.stops.select("stop_ref", shown.alias("shown_name"))


@query(
    "sql_literals",
    """
    SELECT concat('INSERT INTO stops (stop_ref, stop_name, has_name, area) VALUES (''', stop_ref, ''', ',
                  CASE WHEN trim(naptan_common_name) = '' THEN 'NULL'
                       ELSE concat('''', replace(naptan_common_name, '''', ''''''), '''') END,
                  ', ', CASE WHEN trim(naptan_common_name) = '' THEN '0' ELSE '1' END,
                  ', ', CAST(administrative_area_code AS INT), ');') AS value
    FROM stops
    """,
    ["stops"],
)
def sql_literals(net):
    from timelegs.operators.serving import insert_statements

    rows = net.stops.select(
        "stop_ref",
        text.non_blank("naptan_common_name").alias("stop_name"),
        (~text.is_blank("naptan_common_name")).alias("has_name"),
        F.col("administrative_area_code").cast("int").alias("area"),
    )
    return insert_statements(rows, "stops")


@query(
    "bool_text",
    """
    SELECT s_suppkey, s_acctbal >= 0 AS is_true FROM supplier
    """,
)
def bool_text(net):
    shown = F.when(F.col("s_acctbal") >= 0, " True ").when(F.col("s_acctbal") < -500, "no")
    return net.table("supplier").select("s_suppkey", text.text_is_true(shown).alias("is_true"))


@query(
    "format_minutes",
    """
    SELECT line_ref,
           printf('%.3f min', sum(runtime_minutes)) AS total_label,
           CASE WHEN count(runtime_minutes) FILTER (WHERE runtime_minutes > 30) = 0 THEN 'N/A'
                ELSE printf('%.3f min', max(runtime_minutes) FILTER (WHERE runtime_minutes > 30)) END
               AS longest_label
    FROM segments GROUP BY line_ref
    """,
    ["segments"],
)
def format_minutes(net):
    long_ones = F.when(F.col("runtime_minutes") > 30, F.col("runtime_minutes"))
    return (
        net.segments.groupBy("line_ref")
        .agg(F.sum("runtime_minutes").alias("total"), F.max(long_ones).alias("longest"))
        .select(
            "line_ref",
            text.minutes_label("total").alias("total_label"),
            text.minutes_label("longest").alias("longest_label"),
        )
    )


@query(
    "metric_unpivot",
    """
    SELECT unnest(['rows', 'lines', 'longest']) AS metric,
           unnest([CAST(count(*) AS VARCHAR), CAST(count(DISTINCT line_ref) AS VARCHAR),
                   CAST(CAST(max(runtime_seconds) AS INT) AS VARCHAR)]) AS value
    FROM raw
    """,
    ["raw"],
)
def metric_unpivot(net):
    record = net.raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("line_ref").alias("lines"),
        F.max("runtime_seconds").alias("longest"),
    )
    return sinks.as_metrics(record)


@query(
    "metric_pivot",
    """
    SELECT count(*) AS rows, count(DISTINCT time_of_day) AS periods,
           CAST(sum(runtime_seconds) AS BIGINT) AS seconds
    FROM segments
    """,
    ["segments"],
)
def metric_pivot(net):
    """A record taken apart into metric rows and put together again."""
    record = net.segments.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("time_of_day").alias("periods"),
        F.sum("runtime_seconds").alias("seconds"),
    )
    again = metrics_record(sinks.as_metrics(record))
    return again.select(*[F.col(c).cast("bigint").alias(c) for c in ("rows", "periods", "seconds")])


@query("csv_round_trip", "SELECT DISTINCT * FROM raw", ["raw"])
def csv_round_trip(net):
    """Unique raw rows written as CSV text and read back under the explicit layout."""
    unique = net.raw.distinct()
    line = F.to_csv(F.struct(*unique.columns), sinks.CSV_OPTIONS).alias("line")
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SEGMENTS.fields)
    back = F.from_csv("line", layout).alias("r")
    return unique.select(line).select(back).select("r.*")


@query("csv_files", "SELECT * FROM raw", ["raw"])
def csv_files(net):
    """All raw rows through CSV files: the shipped writer, then the shipped reader."""
    path = new_folder(net.spark, "csv")
    sinks.write_csv(net.raw, path)
    return read_raw_segments(net.spark, path)


@query("parquet_files", "SELECT * FROM raw", ["raw"])
def parquet_files(net):
    """All raw rows through Parquet files."""
    path = new_folder(net.spark, "parquet")
    sinks.write_parquet(net.raw, path)
    return read_parquet(net.spark, path, RAW_SEGMENTS.fieldNames())


@query(
    "percent_of_flags",
    """
    SELECT line_ref, round(100.0 * avg(is_peak_hour), 4) AS peak_percentage,
           coalesce(round(100.0 * count(*) FILTER (WHERE runtime_minutes > 30)
                    / nullif(count(*) FILTER (WHERE runtime_minutes > 15), 0), 4), 0) AS very_long_share
    FROM segments GROUP BY line_ref
    """,
    ["segments"],
)
def percent_of_flags(net):
    return net.segments.groupBy("line_ref").agg(
        measures.percent_of_flags("is_peak_hour").alias("peak_percentage"),
        measures.percentage(
            F.count_if(F.col("runtime_minutes") > 30), F.count_if(F.col("runtime_minutes") > 15)
        ).alias("very_long_share"),
    )
