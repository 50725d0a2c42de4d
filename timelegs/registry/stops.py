"""Stop records, catalogue and register."""

from __future__ import annotations

from pyspark.sql import functions as F

from timelegs.functions import text
from timelegs.operators import stops
from timelegs.registry.book import code, query

CATALOGUE = (
    "stop_ref, common_name, locality_name, latitude, longitude, has_coordinates, source_type, source_file"
)


@query(
    "stop_union",
    """
    SELECT source_type, source_file, count(*) AS record_count, count(DISTINCT stop_ref) AS stop_count
    FROM records GROUP BY ALL
    """,
    ["records"],
)
def stop_union(net):
    records = stops.combine_stop_records(net.annotated_records, net.local_records)
    return records.groupBy("source_type", "source_file").agg(
        F.count(F.lit(1)).alias("record_count"), F.count_distinct("stop_ref").alias("stop_count")
    )


@query("best_stop_record", f"SELECT {CATALOGUE} FROM catalogue", ["catalogue"])
def best_stop_record(net):
    return net.catalogue


@query(
    "completeness",
    "SELECT stop_ref, score, count(*) AS record_count FROM scored GROUP BY ALL",
    ["scored"],
)
def completeness(net):
    score = text.completeness(stops.SCORED_FIELDS).alias("score")
    return net.stop_records.groupBy("stop_ref", score).agg(F.count(F.lit(1)).alias("record_count"))


@query(
    "catalogue_counters",
    """
    SELECT (SELECT count(*) FROM records WHERE source_type = 'annotated_reference')
               AS annotated_stop_elements_read,
           (SELECT count(*) FROM records WHERE source_type = 'local_definition')
               AS local_stop_elements_read,
           (SELECT count(*) FROM records) AS total_stop_elements_read,
           count(*) AS unique_stop_references,
           (SELECT count(*) FROM records) - count(*) AS duplicate_stop_references,
           count(*) FILTER (WHERE source_type = 'annotated_reference') AS unique_annotated_stops,
           count(*) FILTER (WHERE source_type = 'local_definition') AS unique_local_stops,
           count(*) FILTER (WHERE has_coordinates = '1') AS stops_with_coordinates,
           count(*) FILTER (WHERE has_coordinates = '0') AS stops_without_coordinates,
           round(100.0 * count(*) FILTER (WHERE has_coordinates = '1') / count(*), 4)
               AS coordinate_coverage_percentage
    FROM catalogue
    """,
    ["records", "catalogue"],
)
def catalogue_counters(net):
    return stops.catalogue_counters(net.stop_records, net.catalogue)


@query(
    "column_aliases",
    """
    SELECT part, pos AS "row", code AS stop_ref, name AS naptan_common_name, locality AS locality_name,
           town, stop_type, status, area AS administrative_area_code
    FROM register_files
    """,
    ["register_files"],
)
def column_aliases(net):
    return net.register.drop("latitude", "longitude")


@query(
    "stop_semi",
    """
    SELECT code AS stop_ref, count(*) AS register_rows FROM register_files
    WHERE code IN (SELECT stop_ref FROM catalogue) GROUP BY code
    """,
    ["register_files", "catalogue"],
)
def stop_semi(net):
    kept = stops.register_rows_in_catalogue(net.register, net.catalogue)
    return kept.groupBy("stop_ref").agg(F.count(F.lit(1)).alias("register_rows"))


@query(
    "last_wins",
    """
    SELECT code AS stop_ref, part, pos AS "row", name AS naptan_common_name FROM register_files
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY part DESC, pos DESC) = 1
    """,
    ["register_files"],
)
def last_wins(net):
    return stops.keep_last(net.register, ["stop_ref"], ["part", "row"]).select(
        "stop_ref", "part", "row", "naptan_common_name"
    )


@query("stop_match", "SELECT * FROM matched", ["matched"])
def stop_match(net):
    return net.matched_stops


@query(
    "unmatched_stops",
    """
    SELECT stop_ref, common_name AS timetable_common_name FROM catalogue
    WHERE stop_ref NOT IN (SELECT stop_ref FROM matched)
    """,
    ["catalogue", "matched"],
)
def unmatched_stops(net):
    return stops.unmatched_stops(net.catalogue, net.matched_stops)


@query(
    "key_difference",
    "SELECT stop_ref FROM catalogue EXCEPT SELECT stop_ref FROM matched",
    ["catalogue", "matched"],
)
def key_difference(net):
    return net.catalogue.select("stop_ref").subtract(net.matched_stops.select("stop_ref"))


@query(
    "unlabelled_documents",
    "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def unlabelled_documents(net):
    """The same anti join where both sides are large tables."""
    from timelegs.operators.joins import hot_key_join

    documents = net.table("documents").select("doc_id", "source")
    labels = net.table("labels").select("doc_id").distinct()
    return hot_key_join(documents, labels, {"doc_id": "doc_id"}, "left_anti")


@query(
    "area_codes",
    f"""
    SELECT DISTINCT substr(stop_ref, 1, 3) AS atco_area_code FROM (SELECT {code("to_key")} AS stop_ref
    FROM lines UNION ALL SELECT {code("l_suppkey")} FROM lines) s WHERE stop_ref NOT LIKE 'LOCAL%'
    """,
    ["lines"],
)
def area_codes(net):
    return stops.area_codes(net.stop_records)


@query(
    "match_summary",
    """
    SELECT *, timetable_stop_references - matched_stop_references AS unmatched_stop_references,
           round(100.0 * matched_stop_references / timetable_stop_references, 4)
               AS matched_stop_percentage,
           round(100.0 * matched_stops_with_coordinates / timetable_stop_references, 4)
               AS coordinate_coverage_percentage
    FROM (SELECT count(*) AS timetable_stop_references,
                 CAST(count(DISTINCT substr(stop_ref, 1, 3)) FILTER (WHERE stop_ref NOT LIKE 'LOCAL%') AS INT)
                     AS atco_area_codes_requested,
                 (SELECT string_agg(a, '|' ORDER BY a)
                  FROM (SELECT DISTINCT substr(stop_ref, 1, 3) AS a FROM catalogue
                        WHERE stop_ref NOT LIKE 'LOCAL%') s) AS atco_area_code_list,
                 (SELECT count(*) FROM register_files) AS total_naptan_rows_downloaded,
                 (SELECT count(*) FROM matched) AS matched_stop_references,
                 (SELECT count(*) FROM matched WHERE has_coordinates = 1) AS matched_stops_with_coordinates
          FROM catalogue) t
    """,
    ["catalogue", "register_files", "matched"],
)
def match_summary(net):
    return stops.match_summary(net.catalogue, net.register, net.matched_stops)


@query(
    "key_dedup",
    """
    SELECT vehicle_journey_code, line_ref, departure_time, from_stop_ref, to_stop_ref, runtime_minutes
    FROM segments
    QUALIFY row_number() OVER (
        PARTITION BY vehicle_journey_code
        ORDER BY runtime_minutes, line_ref, departure_time, from_stop_ref, to_stop_ref) = 1
    """,
    ["segments"],
)
def key_dedup(net):
    columns = [
        "vehicle_journey_code",
        "line_ref",
        "departure_time",
        "from_stop_ref",
        "to_stop_ref",
        "runtime_minutes",
    ]
    order = ["runtime_minutes", "line_ref", "departure_time", "from_stop_ref", "to_stop_ref"]
    return stops.keep_first(net.segments.select(*columns), ["vehicle_journey_code"], order)
