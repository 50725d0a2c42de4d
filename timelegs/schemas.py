"""Record layouts shared by the readers, the operators and the checks.

Column names and types are fixed values: files written by one stage, or by
another tool that follows the same layout, must load unchanged.
"""

from __future__ import annotations

from pyspark.sql.types import StructType



def _layout(columns: str) -> StructType:
    """A flat layout from ``name type, …``; needs no running session."""
    layout = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        layout.add(name, {"int": "integer"}.get(kind, kind))
    return layout


RAW_SEGMENTS = _layout(
    """
    source_file string, vehicle_journey_code string, service_ref string,
    line_ref string, journey_pattern_ref string, departure_time string,
    vehicle_timing_link_id string, journey_pattern_timing_link_ref string,
    from_sequence int, from_stop_ref string, from_timing_status string, from_activity string,
    to_sequence int, to_stop_ref string, to_timing_status string, to_activity string,
    route_link_ref string, runtime_iso string, runtime_seconds int, runtime_minutes double
    """
)

CLEANED_EXTRA = _layout(
    """
    departure_hour int, is_peak_hour int, time_of_day string,
    segment_key string, is_iqr_high_duration int
    """
)

STOPS = _layout(
    """
    stop_ref string, timetable_common_name string, naptan_common_name string,
    locality_name string, town string, latitude double, longitude double,
    has_coordinates int, stop_type string, status string,
    administrative_area_code string, atco_area_code string
    """
)

STOP_CATALOGUE = _layout(
    """
    stop_ref string, common_name string, locality_name string, latitude string,
    longitude string, has_coordinates string, source_type string, source_file string
    """
)

MODEL_RESULTS = _layout(
    """
    rank_by_rmse int, model_name string, configuration string, training_records long,
    testing_records long, rmse double, mae double, r2 double,
    training_seconds double, evaluation_seconds double
    """
)

METRIC_VALUE = _layout("metric string, value string")

# Fields a segment must carry to be analysed at all.
REQUIRED_TEXT = [
    "source_file",
    "vehicle_journey_code",
    "line_ref",
    "departure_time",
    "from_stop_ref",
    "to_stop_ref",
]

# Register fields and the header spellings under which they are published.
REGISTER_SPELLINGS = {
    "stop_ref": ["ATCOCode", "AtcoCode", "atcoCode"],
    "naptan_common_name": ["CommonName", "commonName"],
    "locality_name": ["LocalityName", "localityName"],
    "town": ["Town", "town"],
    "latitude": ["Latitude", "latitude"],
    "longitude": ["Longitude", "longitude"],
    "stop_type": ["StopType", "stopType"],
    "status": ["Status", "status"],
    "administrative_area_code": ["AdministrativeAreaCode", "administrativeAreaCode"],
}

# Stop attributes carried to each end of a segment: dimension column -> suffix.
ROLE_ATTRIBUTES = {
    "naptan_common_name": "stop_name",
    "locality_name": "locality_name",
    "town": "town",
    "latitude": "latitude",
    "longitude": "longitude",
    "stop_type": "stop_type",
    "status": "stop_status",
}

SAMPLE_COLUMNS = [
    "line_ref",
    "vehicle_journey_code",
    "departure_time",
    "from_stop_ref",
    "origin_stop_name",
    "origin_latitude",
    "origin_longitude",
    "to_stop_ref",
    "destination_stop_name",
    "destination_latitude",
    "destination_longitude",
    "distance_km",
    "distance_metres",
    "distance_band",
    "sequence_gap",
    "runtime_minutes",
]

CATEGORICAL_FEATURES = [
    "line_ref",
    "time_of_day",
    "distance_band",
    "from_timing_status",
    "to_timing_status",
    "from_activity",
    "to_activity",
    "origin_stop_type",
    "destination_stop_type",
]

NUMERIC_FEATURES = [
    "distance_km",
    "departure_hour",
    "is_peak_hour",
    "from_sequence",
    "sequence_gap",
    "origin_latitude",
    "origin_longitude",
    "destination_latitude",
    "destination_longitude",
]

PREDICTION_IDENTIFIERS = [
    "source_file",
    "vehicle_journey_code",
    "line_ref",
    "segment_key",
    "departure_time",
    "from_stop_ref",
    "origin_stop_name",
    "to_stop_ref",
    "destination_stop_name",
    "distance_km",
    "runtime_minutes",
]

PREDICTION_COLUMNS = PREDICTION_IDENTIFIERS + [
    "prediction",
    "residual_minutes",
    "absolute_error_minutes",
    "is_model_anomaly",
    "anomaly_direction",
]

# Serving tables: column order of the load.
SERVING_STOPS = [
    "stop_ref",
    "stop_name",
    "locality_name",
    "town",
    "latitude",
    "longitude",
    "stop_type",
    "status",
    "administrative_area_code",
    "atco_area_code",
]

SERVING_SEGMENTS = [
    "source_file",
    "vehicle_journey_code",
    "vehicle_timing_link_id",
    "line_ref",
    "segment_key",
    "departure_time",
    "departure_hour",
    "time_of_day",
    "is_peak_hour",
    "from_stop_ref",
    "to_stop_ref",
    "distance_km",
    "runtime_minutes",
    "is_iqr_high_duration",
]

SERVING_MODEL_RESULTS = [
    "model_name",
    "rank_by_rmse",
    "configuration",
    "rmse",
    "mae",
    "r2",
    "training_seconds",
    "evaluation_seconds",
]

SERVING_PREDICTIONS = [
    "model_name",
    "source_file",
    "vehicle_journey_code",
    "line_ref",
    "segment_key",
    "departure_time",
    "from_stop_ref",
    "to_stop_ref",
    "distance_km",
    "actual_runtime_minutes",
    "predicted_runtime_minutes",
    "residual_minutes",
    "absolute_error_minutes",
    "is_model_anomaly",
    "anomaly_direction",
]
