"""Journey documents (XML) as DataFrames, one reader per element.

Each reader streams one element type out of every file below a directory, in any
namespace. A file that breaks off before its end counts as unreadable: no segments are
taken from it, while the stops that stand before the break are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from timelegs.operators.joins import lookup_join
from timelegs.operators.records import beside

CORRUPT = "_corrupt_record"
DOCUMENTS = "*.xml"
ROOT = "TransXChange"

_END = "struct<_SequenceNumber:string,Activity:string,StopPointRef:string,TimingStatus:string>"
_POSITION = "Latitude:string,Longitude:string"

# Row element -> layout. All text: numbers are read by the operators, with their own rules.
LAYOUTS = {
    "VehicleJourney": (
        "VehicleJourneyCode string, ServiceRef string, LineRef string, JourneyPatternRef string, "
        "DepartureTime string, VehicleJourneyTimingLink "
        "array<struct<_id:string,JourneyPatternTimingLinkRef:string,RunTime:string>>"
    ),
    "JourneyPatternTimingLink": (
        f"_id string, From {_END}, To {_END}, RouteLinkRef string, RunTime string"
    ),
    "AnnotatedStopPointRef": (
        "StopPointRef string, CommonName string, LocalityName string, "
        "LocalityQualifier string, NptgLocalityRef string"
    ),
    "StopPoint": (
        "AtcoCode string, StopPointRef string, CommonName string, "
        "Descriptor struct<CommonName:string>, LocalityName string, LocalityQualifier string, "
        "NptgLocalityRef string, Latitude string, Longitude string, "
        "Place struct<NptgLocalityRef:string,LocalityName:string,LocalityQualifier:string,"
        f"Location:struct<{_POSITION},Translation:struct<{_POSITION}>>>"
    ),
}


def layout(element: str) -> StructType:
    return StructType.fromDDL(LAYOUTS[element])


def file_name() -> Column:
    """The name of the row's file as stored: percent-escapes undone, ``+`` kept."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def document_paths(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the documents below ``path``; their contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.xml")
        .load(path)
        .select("path")
    )


def require_documents(spark: SparkSession, path: str) -> None:
    """An error when there is no document below ``path``."""
    if document_paths(spark, path).isEmpty():
        raise FileNotFoundError(f"no XML documents below {path}")


def document_counters(spark: SparkSession, path: str) -> DataFrame:
    """One row: documents found, and those that could not be read to their end."""
    count = F.count(F.lit(1))
    found = document_paths(spark, path).agg(count.alias("xml_files_found"))
    return beside(
        found, unreadable_files(spark, path).agg(count.alias("unreadable_xml_files"))
    )


def _read(spark: SparkSession, path: str, element: str, schema: StructType, names: str = DOCUMENTS) -> DataFrame:
    return (
        spark.read.format("xml")
        .option("rowTag", element)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreNamespace", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", names)
        .schema(schema.add(CORRUPT, "string"))
        .load(path)
    )


def read_element(spark: SparkSession, path: str, element: str, names: str = DOCUMENTS) -> DataFrame:
    """Every ``element`` below ``path`` with source_file, position and the corrupt-row text."""
    return _read(spark, path, element, layout(element), names).select(
        file_name().alias("source_file"),
        F.struct(
            F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("row")
        ).alias("position"),
        "*",
    )


def unreadable_files(spark: SparkSession, path: str, root: str = ROOT, names: str = DOCUMENTS) -> DataFrame:
    """Paths of the files whose root element is not well formed to its end, each once.

    Only the root's own attributes are kept, so a file passes through its task as a stream.
    The reader refuses a query over the corrupt column alone, hence the second count.
    """
    documents = _read(spark, path, root, StructType().add("_id", "string"), names)
    per_file = documents.groupBy(F.col("_metadata.file_path").alias("bad_path")).agg(
        F.count_if(F.col(CORRUPT).isNotNull()).alias("_corrupt"),
        F.count("_id").alias("_with_id"),
    )
    broken = per_file.filter((F.col("_corrupt") > 0) & (F.col("_with_id") >= 0))
    return broken.select("bad_path")


def complete_rows(rows: DataFrame) -> DataFrame:
    """Elements that were read whole, also those before the break of a broken file.

    The second condition always holds. It names a data column, since the reader refuses a
    query over the corrupt column alone.
    """
    data = next(c for c in rows.columns if c not in ("source_file", "position", CORRUPT))
    whole = F.col(CORRUPT).isNull() & (F.coalesce(F.length(data), F.lit(0)) >= 0)
    return rows.filter(whole).drop(CORRUPT)


def read_documents(
    spark: SparkSession, path: str, element: str, bad_files: DataFrame | None = None, names: str = DOCUMENTS
) -> DataFrame:
    """Every ``element`` of every readable file below ``path`` whose name is like ``names``.

    Compressed files (``*.xml.gz``) are read as a stream, each by one task.

    The list of bad files comes from a map-side aggregate and is counted before it is
    broadcast; no task ever holds the rows of a whole file. Pass it in when several
    elements are read from one folder.
    """
    bad = unreadable_files(spark, path, names=names) if bad_files is None else bad_files
    rows = complete_rows(read_element(spark, path, element, names))
    rows = rows.withColumn("_path", F.col("position.path"))
    return lookup_join(rows, bad, {"_path": "bad_path"}, "left_anti").drop("_path")


def read_partial_documents(spark: SparkSession, path: str, element: str) -> DataFrame:
    """Every whole ``element`` below ``path``, also from files that break off later."""
    return complete_rows(read_element(spark, path, element))


def parse_documents(documents: DataFrame, column: str, ddl: str) -> DataFrame:
    """XML text held in a column, parsed to a struct column ``document``."""
    options = {"mode": "PERMISSIVE", "ignoreNamespace": "true"}
    return documents.withColumn("document", F.from_xml(column, ddl, options))
