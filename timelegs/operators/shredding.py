"""From parsed journey documents to flat segment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timelegs.functions import durations, geo, text
from timelegs.operators.joins import hot_key_join
from timelegs.operators.stops import keep_last
from timelegs.schemas import RAW_SEGMENTS
from timelegs.sources import xml_elements

LINK_FIELDS = [
    "from_sequence",
    "from_stop_ref",
    "from_timing_status",
    "from_activity",
    "to_sequence",
    "to_stop_ref",
    "to_timing_status",
    "to_activity",
    "route_link_ref",
]


def flatten_links(links: DataFrame) -> DataFrame:
    """Pattern links as (source_file, link_ref, position, nine fields, run time)."""

    def end(side: str, prefix: str):
        return [
            text.text_or_blank(f"{side}._SequenceNumber").alias(f"{prefix}_sequence"),
            text.text_or_blank(f"{side}.StopPointRef").alias(f"{prefix}_stop_ref"),
            text.text_or_blank(f"{side}.TimingStatus").alias(f"{prefix}_timing_status"),
            text.text_or_blank(f"{side}.Activity").alias(f"{prefix}_activity"),
        ]

    return links.select(
        "source_file",
        F.coalesce("_id", F.lit("")).alias("link_ref"),
        "position",
        *end("From", "from"),
        *end("To", "to"),
        text.text_or_blank("RouteLinkRef").alias("route_link_ref"),
        text.text_or_blank("RunTime").alias("link_run_time"),
    )


def link_lookup(flat_links: DataFrame) -> DataFrame:
    """One row per (source_file, link_ref); a repeated id counts with its last definition."""
    last = keep_last(flat_links, ["source_file", "link_ref"], ["position"])
    return last.select("source_file", "link_ref", *LINK_FIELDS)


def explode_journeys(journeys: DataFrame) -> DataFrame:
    """One row per timing link of a journey; a journey without links keeps one NULL link."""
    return journeys.select(
        "source_file",
        text.text_or_blank("VehicleJourneyCode").alias("vehicle_journey_code"),
        text.text_or_blank("ServiceRef").alias("service_ref"),
        text.text_or_blank("LineRef").alias("line_ref"),
        text.text_or_blank("JourneyPatternRef").alias("journey_pattern_ref"),
        text.text_or_blank("DepartureTime").alias("departure_time"),
        F.posexplode_outer("VehicleJourneyTimingLink").alias("link_position", "_link"),
    ).select(
        "source_file",
        "vehicle_journey_code",
        "service_ref",
        "line_ref",
        "journey_pattern_ref",
        "departure_time",
        "link_position",
        F.col("_link").isNotNull().alias("has_link"),
        F.coalesce("_link._id", F.lit("")).alias("vehicle_timing_link_id"),
        text.text_or_blank("_link.JourneyPatternTimingLinkRef").alias(
            "journey_pattern_timing_link_ref"
        ),
        text.text_or_blank("_link.RunTime").alias("runtime_iso"),
    )


def join_links(legs: DataFrame, lookup: DataFrame) -> DataFrame:
    """Legs with the fields of the pattern link they cite, within the same file.

    Both sides grow with the documents, so neither is broadcast by hand. A link that very
    many journeys cite is split.
    """
    cited = lookup.withColumns(
        {"_file": F.col("source_file"), "_link": F.col("link_ref"), "_matched": F.lit(True)}
    ).drop("source_file", "link_ref")
    on = {"source_file": "_file", "journey_pattern_timing_link_ref": "_link"}
    joined = hot_key_join(legs, cited, on, "left")
    return joined.withColumn("link_matched", F.coalesce("_matched", F.lit(False))).drop("_matched")


def to_raw_segments(joined: DataFrame) -> DataFrame:
    """The 20-column raw layout. Empty text stands for a missing value and becomes NULL."""
    seconds = durations.duration_seconds("runtime_iso")
    shaped = joined.filter("has_link").withColumns(
        {"runtime_seconds": seconds, "runtime_minutes": durations.seconds_to_minutes(seconds)}
    )

    def field(f):
        c = F.col(f.name)
        if f.dataType.simpleString() == "string":
            return F.nullif(c, F.lit("")).alias(f.name)
        return c.try_cast(f.dataType).alias(f.name)

    return shaped.select(*[field(f) for f in RAW_SEGMENTS.fields])


def extract_segments(journeys: DataFrame, links: DataFrame) -> DataFrame:
    """Parsed journeys and pattern links to raw segment rows."""
    return to_raw_segments(join_links(explode_journeys(journeys), link_lookup(flatten_links(links))))


def leg_counts() -> list[Column]:
    """Aggregates over joined legs: rows, run-time classes, links without a match."""
    kind, present = durations.runtime_class("runtime_iso"), F.col("has_link")
    return [
        F.count_if(present).alias("rows_extracted"),
        F.count_if(present & (kind == "positive")).alias("positive_runtimes"),
        F.count_if(present & (kind == "zero")).alias("zero_runtimes"),
        F.count_if(present & kind.isin("missing", "invalid")).alias("invalid_runtimes"),
        F.count_if(present & ~F.col("link_matched")).alias("missing_timing_link_matches"),
    ]


def extraction_counters(joined: DataFrame) -> DataFrame:
    """One row of ``leg_counts``."""
    return joined.agg(*leg_counts())


def _class_counts(run_time: str, present):
    kind = durations.runtime_class(run_time)
    return [
        F.count_if(present & (kind == name)).alias(f"{name}_runtimes")
        for name in ("positive", "zero", "missing", "invalid")
    ]


def link_runtime_profile(flat_links: DataFrame) -> DataFrame:
    """Run-time classes of the pattern links with the extremes of the positive ones."""
    seconds = durations.duration_seconds("link_run_time")
    positive = F.when(seconds > 0, seconds)
    return flat_links.agg(
        F.count(F.lit(1)).alias("total_links"),
        *_class_counts("link_run_time", F.lit(True)),
        F.min(positive).alias("minimum_positive_seconds"),
        F.max(positive).alias("maximum_positive_seconds"),
    )


def journey_runtime_profile(legs: DataFrame) -> DataFrame:
    """Journeys, journeys with a departure time, and run-time classes of their links."""
    first_row = F.coalesce(F.col("link_position"), F.lit(0)) == 0
    present = F.col("has_link")
    return legs.agg(
        F.count_if(first_row).alias("vehicle_journeys"),
        F.count_if(first_row & (F.col("departure_time") != "")).alias(
            "journeys_with_departure_time"
        ),
        F.count_if(present).alias("vehicle_timing_links"),
        *_class_counts("runtime_iso", present),
    )


def positive_runtime_examples(legs: DataFrame, rows: int = 5) -> DataFrame:
    """The first few positive run times, in a stated order."""
    order = ["source_file", "vehicle_journey_code", "link_position", "vehicle_timing_link_id"]
    return (
        legs.filter(durations.runtime_class("runtime_iso") == "positive")
        .orderBy(*order, "runtime_iso")
        .select("runtime_iso")
        .limit(rows)
    )


def annotated_stop_records(elements: DataFrame) -> DataFrame:
    """Referenced stops as catalogue records; they carry no coordinates."""
    return elements.select(
        text.text_or_blank("StopPointRef").alias("stop_ref"),
        text.text_or_blank("CommonName").alias("common_name"),
        text.first_non_blank(
            "LocalityName", "LocalityQualifier", "NptgLocalityRef", default=""
        ).alias("locality_name"),
        F.lit("").alias("latitude"),
        F.lit("").alias("longitude"),
        F.lit("0").alias("has_coordinates"),
        F.lit("annotated_reference").alias("source_type"),
        "source_file",
        "position",
    )


def local_stop_records(elements: DataFrame) -> DataFrame:
    """Locally defined stops as catalogue records, with checked coordinates."""

    def first(*paths: str):
        return text.first_non_blank(*paths, default="")

    latitude = geo.valid_coordinate(
        first("Latitude", "Place.Location.Latitude", "Place.Location.Translation.Latitude"),
        geo.LATITUDE_LIMIT,
    )
    longitude = geo.valid_coordinate(
        first("Longitude", "Place.Location.Longitude", "Place.Location.Translation.Longitude"),
        geo.LONGITUDE_LIMIT,
    )
    return elements.select(
        first("AtcoCode", "StopPointRef").alias("stop_ref"),
        first("CommonName", "Descriptor.CommonName").alias("common_name"),
        first(
            "LocalityName",
            "LocalityQualifier",
            "NptgLocalityRef",
            "Place.NptgLocalityRef",
            "Place.LocalityName",
            "Place.LocalityQualifier",
        ).alias("locality_name"),
        F.coalesce(latitude.cast("string"), F.lit("")).alias("latitude"),
        F.coalesce(longitude.cast("string"), F.lit("")).alias("longitude"),
        geo.has_both(latitude, longitude).cast("string").alias("has_coordinates"),
        F.lit("local_definition").alias("source_type"),
        "source_file",
        "position",
    )


def first_text(document, tags: list[str]):
    """First non-blank text, in document order, among the named descendants of XML text."""
    either = " or ".join(f"local-name()='{t}'" for t in tags)
    path = f"(//*[{either}][normalize-space(text())])[1]/text()"
    return F.coalesce(text.stripped(F.xpath_string(text.col(document), F.lit(path))), F.lit(""))


def journey_legs(elements: DataFrame) -> DataFrame:
    """``explode_journeys`` of elements that were taken apart in one pass; links at any depth count."""
    journeys = elements.filter((F.col("tag") == "VehicleJourney") & ~F.col("broken"))
    own = {
        "vehicle_journey_code": "VehicleJourneyCode",
        "service_ref": "ServiceRef",
        "line_ref": "LineRef",
        "journey_pattern_ref": "JourneyPatternRef",
        "departure_time": "DepartureTime",
    }
    legs = journeys.select(
        "source_file",
        *[xml_elements.child_text("fields", tag).alias(name) for name, tag in own.items()],
        F.posexplode_outer("parts").alias("link_position", "_link"),
    )
    return legs.select(
        "source_file",
        *own,
        "link_position",
        F.col("_link").isNotNull().alias("has_link"),
        F.coalesce(F.col("_link.attributes").getItem("id"), F.lit("")).alias("vehicle_timing_link_id"),
        xml_elements.child_text("_link.fields", "JourneyPatternTimingLinkRef").alias(
            "journey_pattern_timing_link_ref"
        ),
        xml_elements.child_text("_link.fields", "RunTime").alias("runtime_iso"),
    )


def pattern_links(elements: DataFrame) -> DataFrame:
    """``flatten_links`` of elements that were taken apart in one pass."""
    links = elements.filter((F.col("tag") == "JourneyPatternTimingLink") & ~F.col("broken"))

    def end(side: str, prefix: str):
        found = xml_elements.part(side)
        sequence = F.coalesce(found.getField("attributes").getItem("SequenceNumber"), F.lit(""))
        tags = {"stop_ref": "StopPointRef", "timing_status": "TimingStatus", "activity": "Activity"}
        inner = found.getField("fields")
        return [
            sequence.alias(f"{prefix}_sequence"),
            *[xml_elements.descendant_text(inner, tag).alias(f"{prefix}_{c}") for c, tag in tags.items()],
        ]

    return links.select(
        "source_file",
        F.coalesce(F.col("attributes").getItem("id"), F.lit("")).alias("link_ref"),
        F.struct("path", F.col("place").alias("row")).alias("position"),
        *end("From", "from"),
        *end("To", "to"),
        xml_elements.child_text("fields", "RouteLinkRef").alias("route_link_ref"),
        xml_elements.child_text("fields", "RunTime").alias("link_run_time"),
    )


def stop_records(elements: DataFrame) -> DataFrame:
    """Catalogue records of all stops, also of those before the break of a broken document.

    Each value is the first one in document order, at any depth.
    """
    local = F.col("tag") == "StopPoint"
    found = elements.filter(F.col("tag").isin("StopPoint", "AnnotatedStopPointRef"))
    # The names under which a stop's values stand.
    localities = ["LocalityName", "LocalityQualifier", "NptgLocalityRef"]

    def coordinate(tag: str, limit: float):
        given = F.when(local, xml_elements.first_text("fields", [tag]))
        return geo.valid_coordinate(given, limit)

    latitude, longitude = coordinate("Latitude", geo.LATITUDE_LIMIT), coordinate("Longitude", geo.LONGITUDE_LIMIT)
    ref = F.when(local, xml_elements.first_text("fields", ["AtcoCode", "StopPointRef"])).otherwise(
        xml_elements.first_text("fields", ["StopPointRef"])
    )
    return found.select(
        ref.alias("stop_ref"),
        xml_elements.first_text("fields", ["CommonName"]).alias("common_name"),
        xml_elements.first_text("fields", localities).alias("locality_name"),
        F.coalesce(latitude.cast("string"), F.lit("")).alias("latitude"),
        F.coalesce(longitude.cast("string"), F.lit("")).alias("longitude"),
        F.coalesce(geo.has_both(latitude, longitude).cast("string"), F.lit("0")).alias("has_coordinates"),
        F.when(local, "local_definition").otherwise("annotated_reference").alias("source_type"),
        "source_file",
        F.struct("path", F.col("place").alias("row")).alias("position"),
    )
