from __future__ import annotations

from pathlib import Path

import pytest

from timelegs.operators import shredding, stops
from timelegs.plans import batch
from timelegs.sources import journeys_xml, xml_elements

NS = 'xmlns="http://www.transxchange.org.uk/"'


def link(ref, a, b, run="PT1M", seq=1):
    return (
        f'<JourneyPatternTimingLink id="{ref}"><From SequenceNumber="{seq}"><Activity>pickUp</Activity>'
        f"<StopPointRef>{a}</StopPointRef><TimingStatus>PTP</TimingStatus></From>"
        f'<To SequenceNumber="{seq + 1}"><StopPointRef> {b} </StopPointRef></To>'
        f"<RouteLinkRef>RL</RouteLinkRef><RunTime>{run}</RunTime></JourneyPatternTimingLink>"
    )


def journey(code, *links, departure="08:00:00"):
    body = "".join(
        f'<VehicleJourneyTimingLink id="{i}"><JourneyPatternTimingLinkRef>{ref}</JourneyPatternTimingLinkRef>'
        + (f"<RunTime>{run}</RunTime>" if run is not None else "")
        + "</VehicleJourneyTimingLink>"
        for i, (ref, run) in enumerate(links)
    )
    time = f"<DepartureTime>{departure}</DepartureTime>" if departure else ""
    return (
        f"<VehicleJourney><VehicleJourneyCode>{code}</VehicleJourneyCode><ServiceRef>S</ServiceRef>"
        f"<LineRef>L</LineRef><JourneyPatternRef>JP</JourneyPatternRef>{time}{body}</VehicleJourney>"
    )


def document(*parts):
    return f'<?xml version="1.0" encoding="UTF-8"?><TransXChange {NS}><A><B>{"".join(parts)}</B></A></TransXChange>'


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("xml")
    (base / "sub").mkdir()
    (base / "a b&c+d.xml").write_text(
        document(
            link("J1", "100A", "100B", "PT0S"),
            link("J2", "100B", "100C", ""),
            link("J2", "100B", "100D", "P1D", seq=5),  # the last definition counts
            journey("V1", ("J1", "PT2M30S"), ("J2", None), ("J9", "PT1H30")),
            journey("V2", departure=None),
            "<AnnotatedStopPointRef><StopPointRef>100A</StopPointRef><CommonName>A</CommonName>"
            "<LocalityQualifier>Town</LocalityQualifier></AnnotatedStopPointRef>",
            "<AnnotatedStopPointRef><CommonName>no ref</CommonName></AnnotatedStopPointRef>",
            "<StopPoint><AtcoCode>100A</AtcoCode><Descriptor><CommonName>A local</CommonName></Descriptor>"
            "<Place><NptgLocalityRef>N1</NptgLocalityRef><Location><Translation><Latitude>50.5</Latitude>"
            "<Longitude>0.0</Longitude></Translation></Location></Place></StopPoint>",
            "<StopPoint><AtcoCode>100Z</AtcoCode><Place><Location><Latitude>91</Latitude>"
            "<Longitude>abc</Longitude></Location></Place></StopPoint>",
        )
    )
    # The same ids in another file mean other links.
    (base / "sub" / "z.xml").write_text(
        document(link("J1", "100X", "100Y"), journey("V1", ("J1", "PT1M"), departure="25:00:00"))
    )
    whole = document(link("J1", "BAD", "BAD"), journey("VB1", ("J1", "PT1M")), journey("VB2", ("J1", "PT1M")))
    (base / "broken.xml").write_text(whole[: whole.index("VB2") + 2])
    # All its elements are whole, but the document is not.
    late = document(link("J1", "BAD", "BAD"), journey("VL", ("J1", "PT1M")))
    (base / "late_break.xml").write_text(late[: late.index("</TransXChange>")])
    (base / "other.txt").write_text("not a document")
    return str(base)


def read(spark, folder, element):
    return journeys_xml.read_documents(spark, folder, element)


def test_files_below_the_folder_are_found_under_their_own_names(spark, folder):
    names = {r[0] for r in read(spark, folder, "VehicleJourney").select("source_file").distinct().collect()}
    assert names == {"a b&c+d.xml", "z.xml"}


def test_missing_folder_is_an_error(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read(spark, folder + "/nowhere", "VehicleJourney")


def test_broken_files_are_reported_and_left_out(spark, folder):
    bad = {r[0].rsplit("/", 1)[1] for r in journeys_xml.unreadable_files(spark, folder).collect()}
    assert bad == {"broken.xml", "late_break.xml"}
    codes = {r["VehicleJourneyCode"] for r in read(spark, folder, "VehicleJourney").collect()}
    assert codes == {"V1", "V2"}


def test_whole_elements_before_a_break_can_be_kept(spark, folder):
    rows = journeys_xml.read_partial_documents(spark, folder, "VehicleJourney").collect()
    assert {r["VehicleJourneyCode"] for r in rows} == {"V1", "V2", "VB1", "VL"}


def test_segments_from_documents(spark, folder):
    raw = shredding.extract_segments(
        read(spark, folder, "VehicleJourney"), read(spark, folder, "JourneyPatternTimingLink")
    )
    found = {
        (r["source_file"][0], r["vehicle_timing_link_id"]): r
        for r in raw.collect()
    }
    assert len(found) == 4
    first = found[("a", "0")]
    assert (first["from_stop_ref"], first["to_stop_ref"]) == ("100A", "100B")
    assert (first["from_sequence"], first["to_sequence"]) == (1, 2)
    assert (first["runtime_seconds"], first["runtime_minutes"]) == (150, 2.5)
    assert first["to_timing_status"] is None and first["from_timing_status"] == "PTP"
    second = found[("a", "1")]
    assert (second["to_stop_ref"], second["from_sequence"], second["runtime_seconds"]) == ("100D", 5, None)
    third = found[("a", "2")]
    assert (third["from_stop_ref"], third["runtime_iso"], third["runtime_seconds"]) == (None, "PT1H30", None)
    assert found[("z", "0")]["from_stop_ref"] == "100X"


def test_profiles_and_counters(spark, folder):
    legs = shredding.explode_journeys(read(spark, folder, "VehicleJourney"))
    flat = shredding.flatten_links(read(spark, folder, "JourneyPatternTimingLink"))
    journeys = shredding.journey_runtime_profile(legs).first().asDict()
    assert journeys == {
        "vehicle_journeys": 3,
        "journeys_with_departure_time": 2,
        "vehicle_timing_links": 4,
        "positive_runtimes": 2,
        "zero_runtimes": 0,
        "missing_runtimes": 1,
        "invalid_runtimes": 1,
    }
    links = shredding.link_runtime_profile(flat).first().asDict()
    assert links["total_links"] == 4
    assert (links["zero_runtimes"], links["missing_runtimes"], links["invalid_runtimes"]) == (1, 1, 1)
    assert (links["minimum_positive_seconds"], links["maximum_positive_seconds"]) == (60, 60)
    joined = shredding.join_links(legs, shredding.link_lookup(flat))
    counters = shredding.extraction_counters(joined).first().asDict()
    assert counters == {
        "rows_extracted": 4,
        "positive_runtimes": 2,
        "zero_runtimes": 0,
        "invalid_runtimes": 2,
        "missing_timing_link_matches": 1,
    }
    examples = shredding.positive_runtime_examples(legs).collect()
    assert [r[0] for r in examples] == ["PT2M30S", "PT1M"]


def test_stop_catalogue_keeps_the_most_complete_record(spark, folder, tmp_path):
    out = batch.Layout(str(tmp_path))
    rows = {r["stop_ref"]: r for r in batch.extract_stop_catalogue(spark, folder, out).collect()}
    assert set(rows) == {"100A", "100Z"}
    a, z = rows["100A"], rows["100Z"]
    assert (a["source_type"], a["common_name"], a["locality_name"]) == ("local_definition", "A local", "N1")
    assert (a["latitude"], a["longitude"], a["has_coordinates"]) == ("50.5", "0.0", "1")
    assert (z["latitude"], z["longitude"], z["has_coordinates"]) == ("", "", "0")
    annotated = shredding.annotated_stop_records(read(spark, folder, "AnnotatedStopPointRef"))
    local = shredding.local_stop_records(read(spark, folder, "StopPoint"))
    records = stops.combine_stop_records(annotated, local)
    counters = stops.catalogue_counters(records, spark.read.parquet(out.at("stop_catalogue"))).first()
    assert counters["total_stop_elements_read"] == 4
    assert counters["duplicate_stop_references"] == 1
    assert counters["coordinate_coverage_percentage"] == 50.0


def test_prefixed_names_are_read_like_unprefixed_ones(spark, tmp_path):
    text = (
        '<t:Root xmlns:t="urn:x"><t:VehicleJourney><t:VehicleJourneyCode>P</t:VehicleJourneyCode>'
        "</t:VehicleJourney></t:Root>"
    )
    (tmp_path / "p.xml").write_text(text)
    rows = read(spark, str(tmp_path), "VehicleJourney").collect()
    assert [r["VehicleJourneyCode"] for r in rows] == ["P"]


def test_first_text_follows_document_order(spark):
    xml = f"<S {NS}><LocalityQualifier> </LocalityQualifier><D><NptgLocalityRef>N</NptgLocalityRef></D><LocalityName>L</LocalityName></S>"
    df = spark.createDataFrame([(xml,), ("<S/>",)], "x string")
    tags = ["LocalityName", "LocalityQualifier", "NptgLocalityRef"]
    assert [r[0] for r in df.select(shredding.first_text("x", tags)).collect()] == ["N", ""]


def test_documents_are_counted_and_required(spark, folder, tmp_path):
    assert tuple(journeys_xml.document_counters(spark, folder).first()) == (4, 2)
    journeys_xml.require_documents(spark, folder)
    with pytest.raises(FileNotFoundError, match="no XML documents"):
        journeys_xml.require_documents(spark, str(tmp_path))


NESTED = (
    "<VehicleJourney><Times><DepartureTime>no child</DepartureTime></Times><VehicleJourneyCode>\n V9 </VehicleJourneyCode>"
    '<VehicleJourneyTimingLink id="1"><JourneyPatternTimingLinkRef>N1</JourneyPatternTimingLinkRef><RunTime>PT1M</RunTime></VehicleJourneyTimingLink>'
    '<Wrap><Deep><VehicleJourneyTimingLink id="2"><In><RunTime>PT9M</RunTime></In><JourneyPatternTimingLinkRef>N1</JourneyPatternTimingLinkRef>'
    "</VehicleJourneyTimingLink></Deep></Wrap></VehicleJourney>"
)
STOPS = (
    "<AnnotatedStopPointRef><R><StopPointRef>R1</StopPointRef></R><D><E><CommonName>deep</CommonName></E></D><CommonName>later</CommonName></AnnotatedStopPointRef>"
    "<StopPoint><Place><LocalityName>LN</LocalityName></Place><NptgLocalityRef>NR</NptgLocalityRef><X><Y><AtcoCode>S1</AtcoCode></Y></X>"
    "<Descriptor><More><CommonName> deep name </CommonName></More></Descriptor><P><Q><Latitude>51</Latitude><Longitude>-0.5</Longitude></Q></P>"
    "<StopPoint><AtcoCode>S2</AtcoCode><Latitude>1</Latitude></StopPoint></StopPoint>"
)


@pytest.fixture(scope="module")
def nested(tmp_path_factory):
    base = tmp_path_factory.mktemp("nested")
    (base / "a+b c.xml").write_text(document(link("N1", "F", "T"), NESTED, STOPS))
    latin = document(STOPS.replace("R1", "Ré")).replace("UTF-8", "ISO-8859-1")
    (base / "cut.xml").write_bytes(latin.encode("latin-1")[:-10])
    (base / "none.xml").write_text(" ")
    return str(base)


def test_one_pass_finds_every_depth_in_document_order(spark, nested, tmp_path):
    out = batch.Layout(str(tmp_path))
    elements = batch.parse(spark, nested, out)
    raw = batch.extract(spark, elements, out).orderBy("vehicle_timing_link_id").collect()
    assert [(r["source_file"], r["vehicle_journey_code"], r["departure_time"], r["vehicle_timing_link_id"], r["runtime_iso"], r["to_stop_ref"]) for r in raw] == [
        ("a+b c.xml", "V9", None, "1", "PT1M", "T"),
        ("a+b c.xml", "V9", None, "2", None, "T"),
    ]
    found = {r["stop_ref"]: r for r in batch.extract_stop_catalogue(spark, elements, out).collect()}
    assert set(found) == {"R1", "Ré", "S1", "S2"}  # stops before the break are kept
    assert (found["R1"]["common_name"], found["R1"]["has_coordinates"]) == ("deep", "0")
    s1 = found["S1"]
    assert (s1["common_name"], s1["locality_name"], s1["latitude"], s1["longitude"], s1["source_file"]) == ("deep name", "LN", "51.0", "-0.5", "a+b c.xml")
    assert (found["S2"]["latitude"], found["S2"]["has_coordinates"]) == ("1.0", "0")

    def metrics(name):
        return {r[0]: r[1] for r in spark.read.option("header", True).csv(out.at(f"reports/{name}")).collect()}

    extraction = metrics("extraction_summary")
    assert (extraction["xml_files_found"], extraction["unreadable_xml_files"]) == ("3", "2")
    assert (extraction["rows_extracted"], extraction["invalid_runtimes"], extraction["missing_timing_link_matches"]) == ("2", "1", "0")
    assert metrics("stop_catalogue_summary")["total_stop_elements_read"] == "6"
    assert metrics("vehicle_journey_profile")["vehicle_timing_links"] == "2"
    assert metrics("pattern_link_profile")["total_links"] == "1"


def test_one_pass_agrees_with_the_reader_of_single_elements(spark, folder):
    elements = xml_elements.read_elements(spark, folder)
    same = [
        (shredding.journey_legs(elements), shredding.explode_journeys(read(spark, folder, "VehicleJourney"))),
        (
            shredding.link_lookup(shredding.pattern_links(elements)),
            shredding.link_lookup(shredding.flatten_links(read(spark, folder, "JourneyPatternTimingLink"))),
        ),
    ]
    for one, other in same:
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.select(*one.columns).collect()))
    assert tuple(xml_elements.document_counters(elements).first()) == (4, 2)


def test_descendants_and_children(spark):
    fields = "array<struct<tag:string,depth:int,text:string>>"
    rows = [("A", 2, "deep"), ("A", 1, None), ("A", 1, "later"), ("B", 1, "\t "), ("B", 3, "x ")]
    df = spark.createDataFrame([(rows,), ([],)], f"f {fields}")
    got = df.select(
        xml_elements.child_text("f", "A"), xml_elements.descendant_text("f", "A"), xml_elements.descendant_text("f", "B"), xml_elements.first_text("f", ["B", "C"])
    ).collect()
    assert [tuple(r) for r in got] == [("", "deep", "", "x"), ("", "", "", "")]


def test_elements_are_handed_on_while_a_document_is_read():
    read = []

    def pieces():
        yield b"<Root>"
        for i in range(1000):
            read.append(i)
            yield b"<StopPoint><AtcoCode>S</AtcoCode></StopPoint>"
        yield b"</Cut>"

    found = xml_elements.take_apart(pieces())
    next(found)
    assert len(read) < 10
    assert sum(1 for _ in found) == 999 and xml_elements.is_broken(pieces())


def test_documents_in_pieces_agree_with_whole_ones(spark):
    bodies = {"a": document(link("N1", "F", "T"), NESTED, STOPS), "b": document(STOPS)[:-10], "c": " ", "d": ""}
    whole = spark.createDataFrame([(n, f"/{n}", bytearray(t, "utf-8")) for n, t in bodies.items()], "source_file string, path string, content binary")
    cut = [(n, f"/{n}", bytearray(t[at : at + 7], "utf-8")) for n, t in bodies.items() for at in range(0, max(len(t), 1), 7)]
    pieces = spark.createDataFrame(cut, whole.schema).coalesce(1)

    def rows(elements):
        return sorted(map(str, elements.collect()))

    assert rows(xml_elements.elements_of_pieces(pieces)) == rows(xml_elements.elements_of(whole))
    assert tuple(xml_elements.document_counters(xml_elements.elements_of_pieces(pieces, [])).first()) == (4, 3)
    links = xml_elements.elements_of_pieces(pieces, ["JourneyPatternTimingLink"]).filter("place >= 0")
    assert {r["tag"] for r in links.collect()} == {"JourneyPatternTimingLink"}


def test_a_document_is_read_once_and_a_break_marks_all_its_rows():
    def pieces(tail):
        yield b'<?xml version="1.0"?><Root xmlns:p="urn:p">'
        for i in range(5000):  # more than a batch
            yield b'<StopPoint p:id="%d"><AtcoCode>S<!-- no child -->%d</AtcoCode><StopPoint/></StopPoint><X/>' % (i, i)
        yield tail

    documents = [("whole", "/w", pieces(b"</Root>")), ("cut", "/c", pieces(b"</Cut>")), ("small", "/s", iter([b"<StopPoint/>"]))]
    rows = [row for batch in xml_elements._batches(documents, ["StopPoint"]) for row in batch.to_pylist()]
    assert len(rows) == 2 * (2 * 5000 + 1) + 2
    assert {r["source_file"] for r in rows if r["broken"]} == {"cut"} and not any(r["broken"] for r in rows if r["source_file"] != "cut")
    outer = {r["place"]: r for r in rows if r["source_file"] == "cut" and r["attributes"]}
    assert sorted(outer) == [1 + 4 * i for i in range(5000)]
    assert outer[1 + 4 * 7]["attributes"] == [("urn:p}id", "7")]
    assert [tuple(f.values()) for f in outer[1 + 4 * 7]["fields"]] == [("AtcoCode", 1, "S7"), ("StopPoint", 1, None)]


def test_an_entity_of_an_external_definition_is_no_break():
    for begin, broken in (("<!DOCTYPE r SYSTEM 'x.dtd'>", False), ("", True)):
        text = f"{begin}<r><StopPoint><AtcoCode>a&other;b</AtcoCode></StopPoint></r>".encode()
        breaks: list = []
        found = list(xml_elements.take_apart([text], ["StopPoint"], breaks))
        assert bool(breaks) == broken == xml_elements.is_broken([text])
        assert [[tuple(f) for f in e.fields] for e in found] == ([] if broken else [[("AtcoCode", 1, "ab")]])


def test_written_journeys_are_compressed_and_read_whole(spark, network, monkeypatch):
    from timelegs.registry import xml

    monkeypatch.setattr(xml, "JOURNEYS_A_FILE", 700)
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.glob("timelegs-xml-*"))
    read = xml.xml_files(network)
    [written] = set(folder.glob("timelegs-xml-*")) - before
    files = list(written.glob("part-*"))
    assert len(files) > 4 and all(f.name.endswith(".xml.gz") for f in files)
    lines = network.table("lineitem").count()
    assert read.count() == 2 * lines
    assert sum(f.stat().st_size for f in files) < 100 * lines  # a journey is more than 400 bytes
