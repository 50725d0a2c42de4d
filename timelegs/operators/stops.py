"""Stop records, the stop catalogue and its match against a published register."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timelegs.functions import geo, measures, text
from timelegs.operators.joins import lookup_join
from timelegs.operators.records import beside
from timelegs.schemas import REGISTER_SPELLINGS, STOP_CATALOGUE, STOPS

# The fields that make one record of a stop more useful than another.
SCORED_FIELDS = ["common_name", "locality_name", "latitude", "longitude"]

UNKNOWN_STOP = "Unknown stop"


def combine_stop_records(annotated: DataFrame, local: DataFrame) -> DataFrame:
    return annotated.unionByName(local)


def keep_last(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row of each key that comes last in ``order``; the partial step runs map-side."""
    order_by = F.struct(*[text.col(c) for c in order])
    return _keep(df, keys, F.max_by(F.struct(*_others(df, keys)), order_by))


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row of each key that comes first in ``order``."""
    order_by = F.struct(*[text.col(c) for c in order])
    return _keep(df, keys, F.min_by(F.struct(*_others(df, keys)), order_by))


def _others(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def _keep(df: DataFrame, keys: list[str], survivor: Column) -> DataFrame:
    kept = df.groupBy(*keys).agg(survivor.alias("_row"))
    return kept.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def best_stop_records(records: DataFrame, position: list[str | Column]) -> DataFrame:
    """One record per stop: the most complete one, and of equals the first by ``position``.

    An ordered aggregate rather than a window: copies of a stop named in every file are
    reduced before the shuffle, so no task has to hold them all.
    """
    score = text.completeness(SCORED_FIELDS)
    named = records.filter(~text.is_blank("stop_ref"))
    kept = keep_first(named, ["stop_ref"], [-score, *position])
    return kept.select(*STOP_CATALOGUE.fieldNames())


def catalogue_counters(records: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row of element counts, duplicates and coordinate coverage."""
    kind = F.col("source_type")
    elements = records.agg(
        F.count_if(kind == "annotated_reference").alias("annotated_stop_elements_read"),
        F.count_if(kind == "local_definition").alias("local_stop_elements_read"),
        F.count(F.lit(1)).alias("total_stop_elements_read"),
        F.count_if(~text.is_blank("stop_ref")).alias("_named"),
    )
    located = F.col("has_coordinates") == "1"
    unique = catalogue.agg(
        F.count(F.lit(1)).alias("unique_stop_references"),
        F.count_if(kind == "annotated_reference").alias("unique_annotated_stops"),
        F.count_if(kind == "local_definition").alias("unique_local_stops"),
        F.count_if(located).alias("stops_with_coordinates"),
        F.count_if(~located).alias("stops_without_coordinates"),
    )
    names = unique.columns
    return beside(elements, unique).select(
        "annotated_stop_elements_read",
        "local_stop_elements_read",
        "total_stop_elements_read",
        "unique_stop_references",
        (F.col("_named") - F.col("unique_stop_references")).alias("duplicate_stop_references"),
        *names[1:],
        measures.percentage(
            F.col("stops_with_coordinates"), F.col("unique_stop_references")
        ).alias("coordinate_coverage_percentage"),
    )


def normalise_register(register: DataFrame) -> DataFrame:
    """Register rows under one set of names, whatever spelling the headers use.

    Columns of another name (row order, area) are passed through.
    """
    fields = {}
    used = set()
    for name, spellings in REGISTER_SPELLINGS.items():
        found = [s for s in spellings if s in register.columns]
        used.update(found)
        fields[name] = text.first_non_blank(*[F.col(f"`{s}`") for s in found], default="")
    kept = [c for c in register.columns if c not in used]
    return register.select(*kept, *[c.alias(n) for n, c in fields.items()])


def area_codes(catalogue: DataFrame) -> DataFrame:
    """Distinct three-digit areas of the stop references."""
    return (
        catalogue.select(text.area_code("stop_ref").alias("atco_area_code"))
        .filter(F.col("atco_area_code") != "")
        .distinct()
        .orderBy("atco_area_code")
    )


def register_rows_in_catalogue(
    register: DataFrame, catalogue: DataFrame, small: bool | None = None
) -> DataFrame:
    """Register rows of stops that the catalogue names."""
    keys = catalogue.select("stop_ref").distinct()
    return lookup_join(register, keys, {"stop_ref": "stop_ref"}, "left_semi", small=small)


def match_register(
    catalogue: DataFrame, register: DataFrame, order: list[str | Column]
) -> DataFrame:
    """Stop dimension (12 columns): register attributes beside the timetable's own name.

    A code that the register repeats counts with its last row. Both sides end up hashed
    by stop_ref, so the join adds no shuffle to the de-duplication.
    """
    last = keep_last(register, ["stop_ref"], order)
    latitude = geo.valid_coordinate("latitude", geo.LATITUDE_LIMIT)
    longitude = geo.valid_coordinate("longitude", geo.LONGITUDE_LIMIT)
    area = text.first_non_blank(
        *([F.col("atco_area_code")] if "atco_area_code" in register.columns else []),
        text.area_code("stop_ref"),
        default="",
    )
    described = last.select(
        "stop_ref",
        "naptan_common_name",
        "locality_name",
        "town",
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        geo.has_both(latitude, longitude).alias("has_coordinates"),
        "stop_type",
        "status",
        "administrative_area_code",
        area.alias("atco_area_code"),
    )
    names = catalogue.select("stop_ref", text.text_or_blank("common_name").alias("timetable_common_name"))
    return described.join(names, "stop_ref").select(*STOPS.fieldNames()).orderBy("stop_ref")


def unmatched_stops(catalogue: DataFrame, stops: DataFrame) -> DataFrame:
    missing = catalogue.join(stops.select("stop_ref"), "stop_ref", "left_anti")
    return missing.select(
        "stop_ref", text.text_or_blank("common_name").alias("timetable_common_name")
    ).orderBy("stop_ref")


def match_summary(catalogue: DataFrame, register: DataFrame, stops: DataFrame) -> DataFrame:
    """One row of match counters. The area list is bounded: three digits, 1000 values."""
    area = F.nullif(text.area_code("stop_ref"), F.lit(""))
    areas = F.array_sort(F.collect_set(area))
    count = F.count(F.lit(1))
    base = beside(
        catalogue.agg(
            count.alias("timetable_stop_references"),
            F.size(areas).alias("atco_area_codes_requested"),
            F.array_join(areas, "|").alias("atco_area_code_list"),
        ),
        register.agg(count.alias("total_naptan_rows_downloaded")),
        stops.agg(
            count.alias("matched_stop_references"),
            F.count_if(F.col("has_coordinates") == 1).alias("matched_stops_with_coordinates"),
        ),
    )
    whole = F.col("timetable_stop_references")
    return base.withColumns(
        {
            "unmatched_stop_references": whole - F.col("matched_stop_references"),
            "matched_stop_percentage": measures.percentage(F.col("matched_stop_references"), whole),
            "coordinate_coverage_percentage": measures.percentage(
                F.col("matched_stops_with_coordinates"), whole
            ),
        }
    )


def one_row_per_stop(stops: DataFrame) -> DataFrame:
    """Stops with a key, one row each: the row with the most attributes survives."""
    attributes = _others(stops, ["stop_ref"])
    return keep_first(
        stops.filter(F.col("stop_ref").isNotNull()),
        ["stop_ref"],
        [-text.completeness(attributes), *attributes],
    )


def stop_counters(stops: DataFrame) -> DataFrame:
    return stops.agg(
        F.count(F.lit(1)).alias("naptan_stop_records"),
        F.count_distinct("stop_ref").alias("distinct_stop_references"),
        F.count_if(F.col("has_coordinates") == 1).alias("stops_with_coordinates"),
    )
