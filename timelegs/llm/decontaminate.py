"""Benchmark decontamination with suffix arrays over shards of the training texts.

A shard is a few megabytes of documents within a task. Its suffix array holds the word positions
that can begin a match, those whose first words begin a test window, sorted by the ten words that
follow. Every test suffix is looked up in it by binary search, and each match found is extended to
the longest one. The benchmark comes in slices of bounded size, one pass each, so that what is
broadcast has a bound whatever the benchmark's size.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from timelegs.llm.store import Workspace, row_and, row_and_text, text_of
from timelegs.llm.textkeys import NON_WORD, U64, distinct, grams, utf8, words

WINDOW = 10
SHARD_BYTES = 2 << 20
SLICE_BYTES = 8 << 20
MATCH = "array<struct<item_id:string,item_word:int,doc_word:int,n_words:int>>"
MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("n_words", pa.int32())]))


@dataclass
class Tests:
    """The words of a slice of the benchmark, and its windows as suffixes of bounded length."""

    item_id: list[str | None]
    hashes: np.ndarray
    last: np.ndarray  # for each word, the end of its item
    start: np.ndarray  # the windows' first words
    size: np.ndarray
    item: np.ndarray
    lead: int  # words that every window has
    leads: np.ndarray  # sorted distinct hashes of the windows' first words
    gate: np.ndarray


def prepare(rows: list, window: int = WINDOW) -> Tests:
    texts = [(r[1] or "").encode() for r in rows]
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    starts, _, hashes = words(data, NON_WORD, lower=True)
    cuts = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    begin, size, item = [], [], []
    for k in range(len(texts)):
        n = int(cuts[k + 1] - cuts[k])
        here = np.arange(cuts[k], cuts[k] + max(n - window, 0) + (n > 0))
        begin.append(here)
        size.append(np.full(len(here), min(n, window)))
        item.append(np.full(len(here), k))
    begin, size, item = (np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (begin, size, item))
    lead = int(min(3, size.min())) if len(size) else 1
    leads = distinct(grams(hashes, lead)[begin])[0] if len(begin) else np.empty(0, U64)
    gate = np.zeros(1 << 20, bool)
    gate[(leads >> U64(44)).astype(np.int64)] = True
    last = np.repeat(cuts[1:], np.diff(cuts))
    return Tests([None if r[0] is None else str(r[0]) for r in rows], hashes, last, begin, size, item, lead, leads, gate)


def suffix_rows(hashes: np.ndarray, at: np.ndarray, last: np.ndarray, depth: int) -> np.ndarray:
    """The words that follow each place, zero past the end of its text."""
    place = at[:, None] + np.arange(depth)
    return np.where(place < last[:, None], hashes[np.minimum(place, len(hashes) - 1)], U64(0))


def bound(array: np.ndarray, tests: np.ndarray, size: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of every test suffix in a sorted suffix array, all at once."""
    low, high = np.zeros(len(tests), np.int64), np.full(len(tests), len(array), np.int64)
    counted = np.arange(tests.shape[1]) < size[:, None]
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        row, test = array[mid], tests[open_]
        differs = (row != test) & counted[open_]
        some, first = differs.any(axis=1), differs.argmax(axis=1)
        every = np.arange(len(open_))
        up = np.where(some, row[every, first] < test[every, first], right)
        low[open_[up]] = mid[up] + 1
        high[open_[~up]] = mid[~up]
    return low


def matches(hashes: np.ndarray, cuts: np.ndarray, t: Tests):
    """Every longest match of a shard: item, the item's word, the shard's word, number of words."""
    none = (np.empty(0, np.int64),) * 4
    if len(hashes) < t.lead or not len(t.start):
        return none
    last = np.repeat(cuts[1:], np.diff(cuts))
    first = grams(hashes, t.lead)
    at = np.flatnonzero(t.gate[(first >> U64(44)).astype(np.int64)])
    near = np.minimum(np.searchsorted(t.leads, first[at]), len(t.leads) - 1)
    at = at[(t.leads[near] == first[at]) & (at + t.lead <= last[at])]
    if not len(at):
        return none
    depth = int(t.size.max())
    rows = suffix_rows(hashes, at, last[at], depth)
    order = np.lexsort(rows.T[::-1])
    rows, at = rows[order], at[order]
    tests = suffix_rows(t.hashes, t.start, t.last[t.start], depth)
    low, high = bound(rows, tests, t.size, False), bound(rows, tests, t.size, True)
    count = high - low
    which = np.repeat(np.arange(len(tests)), count)
    place = at[np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)]
    start = t.start[which]
    # A match whose words before also match belongs to the one that begins there.
    before, item_first = np.maximum(place - 1, 0), np.maximum(start - 1, 0)
    inner = (place > 0) & (start > 0) & (last[before] == last[place]) & (t.last[item_first] == t.last[start])
    inner &= (hashes[before] == t.hashes[item_first])
    which, place, start = which[~inner], place[~inner], start[~inner]
    long = t.size[which].copy()
    going = np.arange(len(which))
    while len(going):
        a, b = place[going] + long[going], start[going] + long[going]
        inside = (a < last[place[going]]) & (b < t.last[start[going]])
        same = inside & (hashes[np.minimum(a, len(hashes) - 1)] == t.hashes[np.minimum(b, len(t.hashes) - 1)])
        going = going[same]
        long[going] += 1
    return t.item[which], start, place, long


def scan(batches, t: Tests, text_column: str):
    """Add the matches of one slice of the benchmark to those found before."""
    item_first = np.searchsorted(t.last, np.unique(t.last)) if len(t.last) else np.empty(0, np.int64)
    for batch in batches:
        data, offsets = utf8(text_of(batch, text_column))
        n_words, found = [], [x or [] for x in batch.column("found").to_pylist()]
        k = 0
        while k < batch.num_rows:
            upto = max(k + 1, int(np.searchsorted(offsets, offsets[k] + SHARD_BYTES, side="right")) - 1)
            sizes = offsets[k + 1 : upto + 1] - offsets[k:upto]
            shard = np.full(int(sizes.sum()) + len(sizes), 0x0A, np.uint8)
            keep = np.ones(len(shard), bool)
            keep[np.cumsum(sizes + 1) - 1] = False
            shard[keep] = data[offsets[k] : offsets[upto]]
            starts, _, hashes = words(shard, NON_WORD, lower=True)
            cuts = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes + 1))))
            n_words.append(np.diff(cuts))
            item, start, place, long = matches(hashes, cuts, t)
            doc = np.searchsorted(cuts, place, side="right") - 1
            begin = item_first[np.searchsorted(item_first, start, side="right") - 1]
            for d, i, s, p, n in zip(doc, item, start - begin, place - cuts[doc], long, strict=True):
                found[k + d].append({"item_id": t.item_id[i], "item_word": int(s), "doc_word": int(p), "n_words": int(n)})
            k = upto
        counts = np.concatenate(n_words).astype(np.int64) if n_words else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(found, MATCH_TYPE), pa.array(counts)], [*batch.schema.names, "n_words"]
        )


def summarise(found: list[dict]) -> tuple[int, int, str]:
    """Words in matches, items that match, and the digest of the items' names."""
    n_hit, upto = 0, 0
    for begin, end in sorted((m["doc_word"], m["doc_word"] + m["n_words"]) for m in found):
        n_hit += max(0, end - max(begin, upto))
        upto = max(upto, end)
    items = sorted({m["item_id"] for m in found} - {None})
    return n_hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest()


def digest(batches):
    """Instead of the text, what the matches come to."""
    for batch in batches:
        told = [summarise(x or []) for x in batch.column("found").to_pylist()]
        hit, items, names = zip(*told, strict=True) if told else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("n_words"), batch.column("found"), pa.array(hit, pa.int64()), pa.array(items, pa.int64()), pa.array(names, pa.string())],
            ["row", "n_words", "found", "n_hit", "n_items", "items_sha256"],
        )


def find_matches(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", keep: list[str] | None = None, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """row (the input row, or its columns ``keep``), n_words, found (longest matches), n_hit, n_items, items_sha256.

    Words are runs of digits, letters and characters beyond ASCII, lower-cased A-Z. A match is at
    least ten words of an item of ``benchmark`` (item_id, text), or all words of a shorter item.
    ``n_hit`` counts the document's words in matches. Null and empty texts have no words, an empty
    benchmark no matches; items with equal texts are all named, items without item_id count
    in ``n_hit`` and are not among the items named, repeated rows are treated alike. Words are compared by 64-bit hashes. A benchmark
    beyond ``slice_bytes`` takes several passes, with a table written after each.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).distinct()
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    slices = int(total / slice_bytes) + 1
    space = Workspace(spark, "decontaminate")
    frame = docs.select(*row_and_text(docs, text_column, keep), F.lit(None).cast(MATCH).alias("found"))
    for k in range(slices):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k).orderBy("item_id", "text").collect()
        tests = spark.sparkContext.broadcast(prepare(mine))
        if k < slices - 1:
            kinds = StructType([*frame.schema.fields, StructField("n_words", LongType())])
            frame = frame.mapInArrow(lambda batches, t=tests: scan(batches, t.value, text_column), kinds).drop("n_words")
            frame = space.write(frame, f"slice-{k}")
    kinds = row_and(frame, f"n_words bigint, found {MATCH}, n_hit bigint, n_items bigint, items_sha256 string")
    return frame.mapInArrow(lambda batches: digest(scan(batches, tests.value, text_column)), kinds)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark, with all their columns."""
    return find_matches(docs, benchmark, text_column).filter("n_hit = 0").select("row.*")
