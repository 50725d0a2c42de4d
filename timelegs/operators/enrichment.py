"""Segments with the attributes of both their stops and the distance between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.functions import geo, measures
from timelegs.operators.joins import BROADCAST_ROW_LIMIT, fits_broadcast, lookup_join
from timelegs.operators.profiling import preview
from timelegs.operators.records import beside
from timelegs.schemas import ROLE_ATTRIBUTES, SAMPLE_COLUMNS

SAMPLE_ROWS = 100


def stop_role(stops: DataFrame, role: str) -> DataFrame:
    """The stop dimension as seen from one end of a segment: ``origin_…`` or ``destination_…``."""
    return stops.select(
        F.col("stop_ref").alias(f"{role}_lookup_ref"),
        *[F.col(c).alias(f"{role}_{suffix}") for c, suffix in ROLE_ATTRIBUTES.items()],
    )


def join_stops(
    segments: DataFrame,
    stops: DataFrame,
    row_limit: int = BROADCAST_ROW_LIMIT,
    small: bool | None = None,
) -> DataFrame:
    """Left-join the stops twice. ``stops`` holds one row per stop_ref.

    The dimension is counted once for both joins; when it fits, the fact is not shuffled.
    """
    if small is None:
        small = fits_broadcast(stops, row_limit)
    origin = stop_role(stops, "origin")
    destination = stop_role(stops, "destination")
    joined = lookup_join(segments, origin, {"from_stop_ref": "origin_lookup_ref"}, small=small)
    return lookup_join(joined, destination, {"to_stop_ref": "destination_lookup_ref"}, small=small)


def add_distance_features(segments: DataFrame) -> DataFrame:
    """both_stops_matched, distance_km, distance_metres, sequence_gap,
    has_positive_distance and distance_band."""
    ends = ["origin_latitude", "origin_longitude", "destination_latitude", "destination_longitude"]
    matched = F.lit(True)
    for c in ends:
        matched = matched & F.col(c).isNotNull()
    return segments.withColumns(
        {"both_stops_matched": matched.cast("int"), "distance_km": geo.haversine_km(*ends)}
    ).withColumns(
        {
            "distance_metres": F.round(F.col("distance_km") * 1000.0, 2),
            "sequence_gap": F.col("to_sequence") - F.col("from_sequence"),
            "has_positive_distance": F.when(F.col("distance_km") > 0, 1).otherwise(0),
            "distance_band": geo.distance_band("distance_km"),
        }
    )


def enrich_segments(segments: DataFrame, stops: DataFrame, **join_options) -> DataFrame:
    return add_distance_features(join_stops(segments, stops, **join_options))


def enriched_sample(enriched: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A fixed look at the enriched rows: the first ones by line, journey and time."""
    order = [
        "line_ref",
        "vehicle_journey_code",
        "departure_time",
        "from_stop_ref",
        "to_stop_ref",
        "runtime_minutes",
    ]
    return preview(enriched, SAMPLE_COLUMNS, order, rows)


def unmatched(role: str):
    """Condition: the stop at this end has no usable coordinates."""
    return F.col(f"{role}_latitude").isNull() | F.col(f"{role}_longitude").isNull()


def unmatched_segments(enriched: DataFrame) -> DataFrame:
    return enriched.filter(unmatched("origin") | unmatched("destination"))


def match_counters(enriched: DataFrame) -> DataFrame:
    """One row of match and distance counters, in one pass."""
    km = F.col("distance_km")
    return enriched.agg(
        F.count(F.lit(1)).alias("enriched_segment_records"),
        F.count_if(unmatched("origin")).alias("origin_unmatched_records"),
        F.count_if(unmatched("destination")).alias("destination_unmatched_records"),
        F.count_if(F.col("both_stops_matched") == 1).alias("both_stops_matched_records"),
        F.count_if(F.col("has_positive_distance") == 1).alias("positive_distance_records"),
        F.count_if(km == 0).alias("zero_distance_records"),
        F.count_if(km.isNull()).alias("missing_distance_records"),
    ).withColumns(
        {
            "both_stops_match_percentage": measures.percentage(
                F.col("both_stops_matched_records"), F.col("enriched_segment_records")
            ),
            "positive_distance_percentage": measures.percentage(
                F.col("positive_distance_records"), F.col("enriched_segment_records")
            ),
        }
    )


def distance_statistics(enriched: DataFrame) -> DataFrame:
    """One row over the positive distances; the quantiles are exact and found together."""
    v = "distance_km"
    positive = enriched.filter(F.col(v) > 0)
    points = {"median_distance_km": 0.50, "percentile_95_distance_km": 0.95, "percentile_99_distance_km": 0.99}
    moments = positive.agg(
        F.round(F.avg(v), 6).alias("mean_distance_km"),
        F.round(F.stddev_samp(v), 6).alias("standard_deviation_distance_km"),
        F.round(F.min(v), 6).alias("minimum_distance_km"),
        F.round(F.max(v), 6).alias("maximum_distance_km"),
    )
    found = beside(moments, measures.exact_quantiles(positive, v, points))
    return found.select(*moments.columns[:3], *points, moments.columns[3])


def feature_summary(enriched: DataFrame) -> DataFrame:
    """Counters and distance statistics side by side, still one row."""
    return beside(match_counters(enriched), distance_statistics(enriched))
