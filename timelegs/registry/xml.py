"""Journey documents: parsing, link lookup and the counters of an extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from timelegs.operators import shredding
from timelegs.registry.book import query
from timelegs.sources import journeys_xml, xml_elements
from timelegs.sources.stage import new_folder

# A journey takes about half a kilobyte of XML.
JOURNEYS_A_FILE = 500_000


def parsed_legs(net):
    parsed = journeys_xml.parse_documents(
        net.journey_documents, "xml", journeys_xml.LAYOUTS["VehicleJourney"]
    )
    return shredding.explode_journeys(parsed.select("source_file", "document.*"))


@query(
    "xml_round_trip",
    """
    SELECT concat('file_', l_orderkey % 20) AS source_file,
           concat('VJ', l_orderkey) AS vehicle_journey_code, concat('SV', p_size) AS service_ref,
           p_brand AS line_ref, concat('JP', l_suppkey) AS journey_pattern_ref,
           CASE WHEN l_returnflag = 'N' THEN ''
                ELSE concat(lpad(CAST(l_orderkey % 27 AS VARCHAR), 2, '0'), ':',
                            lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0'), ':00') END AS departure_time,
           concat('VL', l_linenumber, s.suffix) AS vehicle_timing_link_id,
           concat('JL', l_partkey) AS journey_pattern_timing_link_ref,
           CASE WHEN s.suffix = 'a' THEN concat('PT', minutes, 'M', l_linenumber, 'S') ELSE '' END
               AS runtime_iso,
           CASE WHEN s.suffix = 'a' THEN minutes * 60 + l_linenumber END AS runtime_seconds
    FROM lines, (VALUES ('a'), ('b')) s(suffix)
    """,
    ["lines"],
)
def xml_round_trip(net):
    from timelegs.functions.durations import duration_seconds

    return parsed_legs(net).select(
        "source_file",
        "vehicle_journey_code",
        "service_ref",
        "line_ref",
        "journey_pattern_ref",
        "departure_time",
        "vehicle_timing_link_id",
        "journey_pattern_timing_link_ref",
        "runtime_iso",
        duration_seconds("runtime_iso").alias("runtime_seconds"),
    )


@query(
    "xml_files",
    """
    SELECT concat('VJ', l_orderkey) AS vehicle_journey_code, p_brand AS line_ref,
           concat('VL', l_linenumber, s.suffix) AS vehicle_timing_link_id,
           concat('JL', l_partkey) AS journey_pattern_timing_link_ref,
           CASE WHEN s.suffix = 'a' THEN concat('PT', minutes, 'M', l_linenumber, 'S') ELSE '' END AS runtime_iso
    FROM lines, (VALUES ('a'), ('b')) s(suffix)
    """,
    ["lines"],
)
def xml_files(net):
    """All journeys written as XML files and taken out of them by the shipped reader.

    The files are compressed, and short enough for one task each.
    """
    parsed = journeys_xml.parse_documents(
        net.journey_documents, "xml", journeys_xml.LAYOUTS["VehicleJourney"]
    )
    path = new_folder(net.spark, "xml")
    writer = parsed.select("document.*").write.format("xml")
    writer = writer.option("compression", "gzip").option("maxRecordsPerFile", JOURNEYS_A_FILE)
    writer.option("rowTag", "VehicleJourney").option("rootTag", journeys_xml.ROOT).save(path)
    journeys = journeys_xml.read_documents(net.spark, path, "VehicleJourney", names="*.xml.gz")
    return shredding.explode_journeys(journeys).select(
        "vehicle_journey_code",
        "line_ref",
        "vehicle_timing_link_id",
        "journey_pattern_timing_link_ref",
        "runtime_iso",
    )


@query(
    "journey_profile",
    """
    SELECT count(*) AS vehicle_journeys,
           count(*) FILTER (WHERE l_returnflag <> 'N') AS journeys_with_departure_time,
           count(*) * 2 AS vehicle_timing_links, count(*) AS positive_runtimes,
           CAST(0 AS BIGINT) AS zero_runtimes, count(*) AS missing_runtimes,
           CAST(0 AS BIGINT) AS invalid_runtimes
    FROM lines
    """,
    ["lines"],
)
def journey_profile(net):
    return shredding.journey_runtime_profile(parsed_legs(net))


@query(
    "first_text",
    """
    SELECT concat('VJ', l_orderkey) AS journey, l_linenumber, p_brand AS first_of_two
    FROM lines
    """,
    ["lines"],
)
def first_text(net):
    """First of two candidate tags in document order, by path over the whole document."""
    return net.journey_documents.select(
        F.regexp_extract("xml", "<VehicleJourneyCode>(VJ\\d+)<", 1).alias("journey"),
        F.regexp_extract("xml", 'id="VL(\\d+)a"', 1).cast("int").alias("l_linenumber"),
        shredding.first_text("xml", ["JourneyPatternRef", "LineRef"]).alias("first_of_two"),
    )


@query(
    "link_profile",
    """
    SELECT count(*) AS total_links,
           count(*) FILTER (WHERE link_run_time NOT IN ('', 'PT1H30') AND minutes > 0) AS positive_runtimes,
           count(*) FILTER (WHERE link_run_time NOT IN ('', 'PT1H30') AND minutes = 0) AS zero_runtimes,
           count(*) FILTER (WHERE link_run_time = '') AS missing_runtimes,
           count(*) FILTER (WHERE link_run_time = 'PT1H30') AS invalid_runtimes,
           min(minutes * 60) FILTER (WHERE link_run_time NOT IN ('', 'PT1H30') AND minutes > 0)
               AS minimum_positive_seconds,
           max(minutes * 60) FILTER (WHERE link_run_time NOT IN ('', 'PT1H30') AND minutes > 0)
               AS maximum_positive_seconds
    FROM links
    """,
    ["links"],
)
def link_profile(net):
    return shredding.link_runtime_profile(net.flat_links)


@query(
    "link_lookup",
    """
    SELECT source_file, link_ref, from_stop_ref, to_stop_ref,
           CAST(l_linenumber AS VARCHAR) AS from_sequence,
           CAST(l_linenumber + 1 AS VARCHAR) AS to_sequence, l_linestatus AS to_timing_status
    FROM lookup
    """,
    ["lookup"],
)
def link_lookup(net):
    return shredding.link_lookup(net.flat_links).select(
        "source_file",
        "link_ref",
        "from_stop_ref",
        "to_stop_ref",
        "from_sequence",
        "to_sequence",
        "to_timing_status",
    )


@query(
    "link_lookup_join",
    """
    SELECT r.source_file, r.vehicle_timing_link_id, r.journey_pattern_timing_link_ref,
           k.from_stop_ref, k.to_stop_ref, k.link_ref IS NOT NULL AS link_matched
    FROM raw r LEFT JOIN lookup k
      ON k.source_file = r.source_file AND k.link_ref = r.journey_pattern_timing_link_ref
    """,
    ["raw", "lookup"],
)
def link_lookup_join(net):
    return net.joined_legs.select(
        "source_file",
        "vehicle_timing_link_id",
        "journey_pattern_timing_link_ref",
        "from_stop_ref",
        "to_stop_ref",
        "link_matched",
    )


@query(
    "extraction_counters",
    """
    SELECT count(*) AS rows_extracted, count(*) FILTER (WHERE r.runtime_seconds > 0) AS positive_runtimes,
           count(*) FILTER (WHERE r.runtime_seconds = 0) AS zero_runtimes,
           count(*) FILTER (WHERE r.runtime_seconds IS NULL) AS invalid_runtimes,
           count(*) FILTER (WHERE k.link_ref IS NULL) AS missing_timing_link_matches
    FROM raw r LEFT JOIN lookup k
      ON k.source_file = r.source_file AND k.link_ref = r.journey_pattern_timing_link_ref
    """,
    ["raw", "lookup"],
)
def extraction_counters(net):
    return shredding.extraction_counters(net.joined_legs)


@query(
    "extracted_segments",
    """
    SELECT r.source_file, r.vehicle_timing_link_id,
           CAST(k.l_linenumber AS INT) AS from_sequence, CAST(k.l_linenumber + 1 AS INT) AS to_sequence,
           k.from_stop_ref, k.to_stop_ref, r.runtime_seconds, r.runtime_minutes
    FROM raw r LEFT JOIN lookup k
      ON k.source_file = r.source_file AND k.link_ref = r.journey_pattern_timing_link_ref
    """,
    ["raw", "lookup"],
)
def extracted_segments(net):
    return shredding.to_raw_segments(net.joined_legs).select(
        "source_file",
        "vehicle_timing_link_id",
        "from_sequence",
        "to_sequence",
        "from_stop_ref",
        "to_stop_ref",
        "runtime_seconds",
        "runtime_minutes",
    )


@query(
    "runtime_examples",
    """
    SELECT runtime_iso FROM raw WHERE runtime_seconds > 0
    ORDER BY source_file, vehicle_journey_code, from_sequence, vehicle_timing_link_id, runtime_iso LIMIT 5
    """,
    ["raw"],
)
def runtime_examples(net):
    return shredding.positive_runtime_examples(net.legs)


@query(
    "nested_journeys",
    """
    SELECT concat('d', l_orderkey % 500) AS source_file, concat('VJ', l_orderkey) AS vehicle_journey_code,
           p_brand AS line_ref, concat('JP', l_suppkey) AS journey_pattern_ref, l_linenumber - 1 AS line,
           concat('VL', l_linenumber, CASE s.n WHEN 0 THEN 'a' ELSE 'n' END) AS vehicle_timing_link_id,
           s.n AS link_position, concat('JL', l_partkey) AS journey_pattern_timing_link_ref,
           CASE s.n WHEN 0 THEN concat('PT', minutes, 'M') ELSE '' END AS runtime_iso
    FROM lines, (VALUES (0), (1)) s(n)
    WHERE l_orderkey % 500 % 9 <> 8
    """,
    ["lines"],
)
def nested_journeys(net):
    """Links at two depths, out of documents of which some are broken."""
    legs = shredding.journey_legs(xml_elements.elements_of_pieces(net.timetable_documents, ["VehicleJourney"]))
    number = F.regexp_extract("vehicle_timing_link_id", r"VL(\d+)", 1).cast("bigint") - 1
    return legs.select(
        "source_file",
        "vehicle_journey_code",
        "line_ref",
        "journey_pattern_ref",
        number.alias("line"),
        "vehicle_timing_link_id",
        "link_position",
        "journey_pattern_timing_link_ref",
        "runtime_iso",
    )


@query(
    "document_links",
    """
    SELECT concat('d', l_orderkey % 500) AS source_file, concat('JL', l_partkey) AS link_ref,
           CAST(l_linenumber AS VARCHAR) AS from_sequence, concat('S', l_suppkey) AS from_stop_ref,
           CASE WHEN l_linestatus = 'F' THEN 'PTP' ELSE '' END AS from_timing_status, '' AS from_activity,
           CAST(l_linenumber + 1 AS VARCHAR) AS to_sequence, concat('T', to_key) AS to_stop_ref,
           '' AS to_timing_status, 'setDown' AS to_activity, concat('RL', p_size) AS route_link_ref
    FROM lines
    WHERE l_orderkey % 500 % 9 <> 8
    QUALIFY row_number() OVER (PARTITION BY l_orderkey % 500, l_partkey
                               ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1
    """,
    ["lines"],
)
def document_links(net):
    """All eleven fields of the last definition of each pattern link, parsed from documents."""
    links = shredding.pattern_links(xml_elements.elements_of_pieces(net.timetable_documents, ["JourneyPatternTimingLink"]))
    return shredding.link_lookup(links)


@query(
    "document_counters",
    """
    SELECT count(DISTINCT l_orderkey % 500) AS xml_files_found,
           count(DISTINCT l_orderkey % 500) FILTER (WHERE l_orderkey % 500 % 9 = 8) AS unreadable_xml_files
    FROM lines
    """,
    ["lines"],
)
def document_counters(net):
    return xml_elements.document_counters(xml_elements.elements_of_pieces(net.timetable_documents, []))


@query(
    "document_stops",
    """
    SELECT concat('A', s_suppkey) AS stop_ref, s_name AS common_name,
           CASE s_suppkey % 3 WHEN 0 THEN concat('LN', s_nationkey) WHEN 1 THEN concat('NR', s_nationkey)
                ELSE '' END AS locality_name,
           CASE WHEN s_suppkey % 4 <> 3 AND s_suppkey % 2 = 0 THEN CAST(s_nationkey + 0.5 AS VARCHAR)
                ELSE '' END AS latitude,
           CASE WHEN s_suppkey % 4 <> 3 AND s_suppkey % 2 = 0 THEN CAST(-s_nationkey - 0.25 AS VARCHAR)
                ELSE '' END AS longitude,
           CASE WHEN s_suppkey % 4 <> 3 AND s_suppkey % 2 = 0 THEN '1' ELSE '0' END AS has_coordinates,
           CASE WHEN s_suppkey % 4 = 3 THEN 'annotated_reference' ELSE 'local_definition' END AS source_type
    FROM supplier
    """,
)
def document_stops(net):
    """Stops with values at any depth and in any order; every third document breaks off after them."""
    records = shredding.stop_records(xml_elements.elements_of_pieces(net.stop_documents, ["StopPoint", "AnnotatedStopPointRef"]))
    return records.drop("source_file", "position")
