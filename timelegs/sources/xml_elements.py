"""Documents taken apart in one pass: every wanted element as a row, at any depth, in document order.

A row holds an element's attributes and, in the order of the document, the elements below it with
their depth and text, so that what a stage asks of an element (its own child, its first descendant
of some names) is an expression over an array. Elements that repeat within one, like the links of a
journey, are its parts and carry their own attributes and fields.

Spark's readers find one element type per pass, keep siblings of different names in no order and
miss what a layout doesn't foresee; hence the parser of Python's standard library inside the tasks,
a document per call. Broken documents are known when they end: their elements carry ``broken``, so all
of a document's rows wait for its end, packed, on the task's disk if they are many, and a row with the
tag ``#document`` stands for each document, read or not. So memory doesn't follow a document's size.
"""

from __future__ import annotations

import gc
import re
import tempfile
from collections.abc import Callable, Collection, Iterable, Iterator, Mapping, Sequence
from itertools import chain, groupby
from xml.etree import ElementTree as etree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timelegs.functions import text
from timelegs.sources.journeys_xml import file_name

DOCUMENT = "#document"

# Wanted elements with the elements that are their parts.
PARTS = {
    "VehicleJourney": {"VehicleJourneyTimingLink"},
    "JourneyPatternTimingLink": {"From", "To"},
    "AnnotatedStopPointRef": set(),
    "StopPoint": set(),
}
# A stop within another stop is a stop of its own, not a part of the outer one's description.
CLOSED = {"AnnotatedStopPointRef", "StopPoint"}

_FIELDS = "array<struct<tag:string,depth:int,text:string>>"
_PART = f"struct<tag:string,depth:int,attributes:map<string,string>,fields:{_FIELDS}>"
SCHEMA = f"source_file string, path string, place bigint, broken boolean, tag string, attributes map<string,string>, fields {_FIELDS}, parts array<{_PART}>"

_ATTRIBUTES = pa.map_(pa.string(), pa.string())
_FIELD_LIST = pa.list_(pa.struct([("tag", pa.string()), ("depth", pa.int32()), ("text", pa.string())]))
_PART_LIST = pa.list_(pa.struct([("tag", pa.string()), ("depth", pa.int32()), ("attributes", _ATTRIBUTES), ("fields", _FIELD_LIST)]))
_ARROW = pa.schema(
    [
        ("source_file", pa.string()),
        ("path", pa.string()),
        ("place", pa.int64()),
        ("broken", pa.bool_()),
        ("tag", pa.string()),
        ("attributes", _ATTRIBUTES),
        ("fields", _FIELD_LIST),
        ("parts", _PART_LIST),
    ]
)
ROWS_A_BATCH = 2_000
# Elements of one batch with all that is below them, so that a batch of large elements is short.
FIELDS_A_BATCH = 100_000
PIECE = 1 << 16
# The begin of a document without a document type declaration.
NO_DOCTYPE = re.compile(rb"\s*(<\?xml[^>]*\?>\s*)?<[A-Za-z_]")
# So many bytes of a document's rows that wait for its end are held in memory; beyond, all are on the task's disk.
BYTES_HELD = 16 << 20


class _LocalNames(dict):
    """Names without their namespace."""

    def __missing__(self, name: str) -> str:
        self[name] = local = name.rsplit("}", 1)[-1]
        return local


class Element:
    """A wanted element with what is below it: fields (tag, depth, text) and parts (tag, depth, attributes, fields)."""

    __slots__ = ("tag", "place", "attributes", "fields", "parts")

    def __init__(self, tag: str, place: int, node: etree.Element, names: Mapping[str, str]):
        self.tag, self.place, self.attributes = tag, place, _attributes(node)
        self.fields, self.parts = [], []
        part_tags, above = PARTS[tag], []
        children, level, into, base = iter(node), 1, self.fields, 0
        while True:
            for child in children:
                name, inner, start = names[child.tag], into, base
                if name in part_tags:
                    inner, start = [], level
                    self.parts.append((name, level, _attributes(child), inner))
                inner.append((name, level - start, child.text))
                if len(child) and name not in CLOSED:
                    above.append((children, level, into, base))
                    children, level, into, base = iter(child), level + 1, inner, start
                    break
            else:
                if not above:
                    break
                children, level, into, base = above.pop()

    def size(self) -> int:
        """The element with all that is below it, in fields."""
        return len(self.fields) + sum(len(part[3]) + 1 for part in self.parts)


def _parser(builder: etree.TreeBuilder | None, first: bytes) -> tuple[Callable, Callable]:
    """Two functions, to read a piece and to end the document.

    The tree's own parser is the faster one. It takes an entity that only an external definition knows for
    a break, so documents that may have one are read by the plain parser, as those of which nothing is wanted.
    """
    if builder is not None and NO_DOCTYPE.match(first):
        parser = etree.XMLParser(target=builder)
        return parser.feed, parser.close
    plain = expat.ParserCreate(namespace_separator="}")
    if builder is not None:
        plain.StartElementHandler, plain.EndElementHandler, plain.CharacterDataHandler = builder.start, builder.end, builder.data
    return lambda piece: plain.Parse(piece, False), lambda: plain.Parse(b"", True)


def _attributes(node: etree.Element) -> dict[str, str]:
    """An element's attributes; a namespace ends in a brace, whichever parser has read it."""
    found = node.attrib
    for name in found:
        if name[0] == "{":
            return {name.removeprefix("{"): value for name, value in found.items()}
    return found


def take_apart(pieces: Iterable[bytes], tags: Collection[str] = tuple(PARTS), breaks: list | None = None) -> Iterator[Element]:
    """The wanted elements of those tags that were read whole, one by one; a break ends them and goes to ``breaks``.

    The document is given as its bytes in order. What is held is the elements that are open, with the last
    child of each and, of wanted ones, all that is below. An element's text is what stands before its first child.
    """
    builder, names = etree.TreeBuilder(), _LocalNames()
    top = builder.start("", {})
    line = [top]  # below top, the elements that may be open and are not wanted: each the first child of the one before
    place = 0  # elements counted so far, those of the line among them
    done: list[Element] = []

    def close(node, level):
        """The wanted elements in a child of the line's element at that level, which is known to be closed."""
        nonlocal place
        if line[level + 1 :] and line[level + 1] is node:
            place -= len(line) - level - 1
            del line[level + 1 :]
        at = place
        for at, inner in enumerate(node.iter(), place):
            if names[inner.tag] in tags:
                done.append(Element(names[inner.tag], at, inner, names))
        place = at + 1

    def advance():
        """All children but the last are closed. They are taken and let go of."""
        nonlocal place
        level = 0
        while len(children := line[level]):
            for child in children[:-1]:
                close(child, level)
            del children[:-1]
            if level + 1 == len(line):
                if names[children[0].tag] in tags:
                    return
                line.append(children[0])
                place += 1
            level += 1

    def finish():
        """What is left. After a break the elements that are open were not read whole."""
        nonlocal place
        still_open = [builder.end("")]
        while still_open[-1] is not top:
            still_open.append(builder.end(""))
        for level, node in enumerate(reversed(still_open)):
            inner = still_open[-level - 2] if level + 1 < len(still_open) else None
            for child in node:
                if child is not inner:
                    close(child, level)
                elif level + 1 == len(line):
                    line.append(child)
                    place += 1

    pieces = iter(pieces)
    first = next(pieces, b"")
    feed, close_parser = _parser(builder if tags else None, first)
    try:
        for piece in chain.from_iterable([[first], pieces]):
            feed(piece)
            advance()
            yield from done
            done.clear()
        close_parser()
    except (expat.ExpatError, etree.ParseError) as error:
        if breaks is not None:
            breaks.append(str(error))  # the error itself would hold all that is open
    finish()
    yield from done


def is_broken(pieces: Iterable[bytes]) -> bool:
    """Whether a document, given as its bytes in order, can't be read to its end. Keeps nothing of it."""
    breaks: list = []
    for _ in take_apart(pieces, (), breaks):
        pass
    return bool(breaks)


def _sliced(content: bytes) -> Iterator[bytes]:
    return (content[at : at + PIECE] for at in range(0, len(content), PIECE))


def _joined(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The same bytes in pieces that are worth a call of the parser."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece)
        if size >= PIECE:
            yield from _sliced(b"".join(held))
            held, size = [], 0
    yield from _sliced(b"".join(held))


def _whole_documents(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for source_file, path, content in zip(*(batch.column(k) for k in range(3)), strict=True):
            yield source_file.as_py(), path.as_py(), _sliced(content.as_py() or b"")


def _documents_in_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Pieces of one document follow each other."""
    pieces = (
        ((source_file, path), content or b"")
        for batch in batches
        for source_file, path, content in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
    )
    for (source_file, path), group in groupby(pieces, key=lambda piece: piece[0]):
        yield source_file, path, _joined(content for _, content in group)


def _offsets(lists: Sequence) -> pa.Array:
    """Where each list begins among all their items; None for a list that isn't there."""
    begins, at = [], 0
    for items in lists:
        begins.append(None if items is None else at)
        at += len(items or ())
    return pa.array([*begins, at], pa.int32())


def _items(lists: Sequence, width: int) -> Iterable[tuple]:
    """The items of all lists as columns."""
    return [*zip(*chain.from_iterable(filter(None, lists)))] or [()] * width


def _attribute_maps(found: Sequence) -> pa.Array:
    names, values = _items([a if a is None else a.items() for a in found], 2)
    return pa.MapArray.from_arrays(_offsets(found), pa.array(names, pa.string()), pa.array(values, pa.string()))


def _structs(kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays(columns, fields=[*kind.value_type])


def _field_lists(found: Sequence) -> pa.Array:
    tags, depths, texts = _items(found, 3)
    columns = pa.array(tags, pa.string()), pa.array(depths, pa.int32()), pa.array(texts, pa.string())
    return pa.ListArray.from_arrays(_offsets(found), _structs(_FIELD_LIST, *columns))


def _part_lists(found: Sequence) -> pa.Array:
    tags, depths, attributes, fields = _items(found, 4)
    columns = pa.array(tags, pa.string()), pa.array(depths, pa.int32()), _attribute_maps(attributes), _field_lists(fields)
    return pa.ListArray.from_arrays(_offsets(found), _structs(_PART_LIST, *columns))


def _batch(rows: Sequence[tuple]) -> pa.RecordBatch:
    """Rows (source file, path, broken, element), column by column; a row without element is the document's own."""
    source_files, paths, broken, elements = zip(*rows)

    def each(name: str, of_document=None) -> list:
        return [of_document if e is None else getattr(e, name) for e in elements]

    columns = [
        pa.array(source_files, pa.string()),
        pa.array(paths, pa.string()),
        pa.array(each("place", -1), pa.int64()),
        pa.array(broken, pa.bool_()),
        pa.array(each("tag", DOCUMENT), pa.string()),
        _attribute_maps(each("attributes")),
        _field_lists(each("fields")),
        _part_lists(each("parts")),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _marked(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows as those of a broken document."""
    at = _ARROW.get_field_index("broken")
    return batch.set_column(at, _ARROW.field(at), pa.array([True] * batch.num_rows, pa.bool_()))


def _batches(documents: Iterable[tuple], tags: Collection[str]) -> Iterator[pa.RecordBatch]:
    """The elements of documents (source file, path, pieces) and the documents' own rows, in batches.

    A document is read once. Its rows wait for its end, since a break there marks all of them: one batch
    of them in memory, those before it in a file without a name.
    """
    collects = gc.isenabled()
    gc.disable()  # no cycles are made here; the collector would go over the rows again and again
    try:
        yield from _batches_of(documents, tags)
    finally:
        if collects:
            gc.enable()


def _batches_of(documents: Iterable[tuple], tags: Collection[str]) -> Iterator[pa.RecordBatch]:
    ready: list[tuple] = []
    ready_size = 0
    for source_file, path, pieces in documents:
        waiting, size, breaks, written = [], 0, [], None
        with tempfile.SpooledTemporaryFile(BYTES_HELD) as file:
            for element in take_apart(pieces, tags, breaks):
                waiting.append((source_file, path, False, element))
                size += element.size()
                if len(waiting) >= ROWS_A_BATCH or size >= FIELDS_A_BATCH:
                    written = written or pa.ipc.new_stream(file, _ARROW, options=pa.ipc.IpcWriteOptions(compression="lz4"))
                    written.write_batch(_batch(waiting))
                    waiting, size = [], 0
                    gc.collect(1)  # what others have made
            broken = bool(breaks)
            if written:
                written.close()
                file.seek(0)
                for batch in pa.ipc.open_stream(file):
                    yield _marked(batch) if broken else batch
        ready += [(source_file, path, broken, element) for *_, element in waiting]
        ready.append((source_file, path, broken, None))
        ready_size += size
        if len(ready) >= ROWS_A_BATCH or ready_size >= FIELDS_A_BATCH:
            yield _batch(ready)
            ready, ready_size = [], 0
            gc.collect(1)
    if ready:
        yield _batch(ready)


def elements_of(documents: DataFrame, tags: Collection[str] = tuple(PARTS)) -> DataFrame:
    """The wanted elements of documents given as (source_file, path, content binary).

    Of the wanted elements only those of ``tags`` are given out; without any, a document is only
    read to its end. What a task holds is a batch of rows and the elements that are open, beside
    the document's bytes.
    """
    tags = tuple(tags)
    return documents.select("source_file", "path", "content").mapInArrow(lambda batches: _batches(_whole_documents(batches), tags), SCHEMA)


def elements_of_pieces(pieces: DataFrame, tags: Collection[str] = tuple(PARTS)) -> DataFrame:
    """``elements_of`` documents whose content comes in pieces, so that none is ever held whole.

    The rows of a document (source_file, path, content binary) are in one partition, one after the
    other and in order.
    """
    tags = tuple(tags)
    return pieces.select("source_file", "path", "content").mapInArrow(lambda batches: _batches(_documents_in_pieces(batches), tags), SCHEMA)


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """The wanted elements of every document below ``path``; each document is read and parsed once.

    Spark's file sources list no file without a byte, so such a file isn't counted as a document.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.xml")
        .load(path)
        .select(file_name().alias("source_file"), F.col("_metadata.file_path").alias("path"), "content")
    )
    return elements_of(found)


def document_counters(elements: DataFrame) -> DataFrame:
    """One row: documents found, and those that could not be read to their end."""
    return elements.filter(F.col("tag") == DOCUMENT).agg(F.count(F.lit(1)).alias("xml_files_found"), F.count_if("broken").alias("unreadable_xml_files"))


def _first(fields: Column | str, condition) -> Column:
    """The text of the first field that meets the condition, without white space around it; blank if none does."""
    found = F.get(F.filter(text.col(fields), condition), F.lit(0)).getField("text")
    return F.coalesce(text.stripped(found), F.lit(""))


def child_text(fields: Column | str, tag: str) -> Column:
    """The text of the first child of that name."""
    return _first(fields, lambda f: (f.depth == 1) & (f.tag == tag))


def descendant_text(fields: Column | str, tag: str) -> Column:
    """The first text of an element of that name, the element itself included."""
    return _first(fields, lambda f: (f.tag == tag) & f.text.isNotNull())


def first_text(fields: Column | str, tags: list[str]) -> Column:
    """The first text that isn't blank of an element of any of the names, in document order."""
    return _first(fields, lambda f: f.tag.isin(tags) & (text.stripped(f.text) != ""))


def part(tag: str) -> Column:
    """The first part of that name that is a child of the element."""
    return F.get(F.filter("parts", lambda p: (p.depth == 1) & (p.tag == tag)), F.lit(0))
