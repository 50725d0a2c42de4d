"""Removal of repeated byte strings with suffix buckets and difference-cover ranks.

Every suffix that is long enough goes to a bucket that depends only on its first ``length`` bytes:
the one named by the least fingerprint among the short grams of those bytes. Equal prefixes meet
in one bucket, and neighbouring suffixes mostly share it, so a bucket receives stretches of text
instead of single suffixes, about three bytes for each suffix, and holds the text it needs.

Buckets are sorted one at a time, each of bounded size. Within a bucket the cover sample comes
first: windows of ``length`` - 12 bytes that start where the place modulo 13 is in a difference
cover are sorted and ranked. A suffix with no shared rank among its next 13 places is alone and
is not sorted. The others are sorted by their first and last 16 bytes and, to resolve the long
tie between, by the rank of the aligned cover sample: for any two places there is an offset
below 13 at which both are in the cover, so one of four sorted orders puts equals side by side.
Ranks are taken from fingerprints and checked byte by byte, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.llm.blocks import give_back
from timelegs.llm.store import row_and, row_and_text, text_of
from timelegs.llm.textkeys import U64, mix, running, utf8, window

# Every residue modulo 13 is a difference of two of these.
PERIOD, COVER = 13, (0, 1, 3, 9)
GRAM = 16
PIECE = 1 << 21
BUCKET_BYTES = 3 << 20
ROWS_A_CUT = 256  # texts that are cut and handed on together
SPREAD = 3.3  # text bytes in buckets for each byte of input, about

SEGMENTS = "bucket int, texts binary, lengths binary, occurrences binary, doc_id array<bigint>, sig array<bigint>"


def words64(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place, as one number."""
    raw = np.ndarray(max(0, len(data) - 7), "<u8", data, 0, (1,))
    return raw[at]


def minimizers(data: np.ndarray, length: int) -> np.ndarray:
    """For each start of ``length`` bytes, the least fingerprint of the grams within."""
    n = len(data) - GRAM + 1
    view = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
    prints = mix(view[:n] * U64(0x9E3779B97F4A7C15) + np.roll(view, -8)[:n] * U64(0xC2B2AE3D27D4EB4F))
    width = length - GRAM + 1
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(U64).max, U64)
    padded[:n] = prints
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - width + 1
    return np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])


def cut_segments(data: np.ndarray, bounds: np.ndarray, length: int):
    """Stretches of suffixes with one minimizer: first start, number of suffixes, minimizer, piece.

    ``bounds`` are the ends of the pieces of text in ``data``; no suffix reaches over one.
    """
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, U64), none
    least = minimizers(data, length)
    starts = np.arange(len(least))
    piece = np.searchsorted(bounds, starts, side="right")
    valid = starts + length <= bounds[np.minimum(piece, len(bounds) - 1)]
    new = np.append(True, (least[1:] != least[:-1]) | (piece[1:] != piece[:-1]) | (valid[1:] != valid[:-1]))
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(least)))
    keep = valid[first]
    return first[keep], size[keep], least[first[keep]], piece[first[keep]]


def pieces(batch: pa.RecordBatch, length: int):
    """Groups of (row, offset, bytes), each group of bounded size; a long text comes in overlapping pieces."""
    data, offsets = utf8(batch.column("text"))
    group, held = [], 0
    for k in range(batch.num_rows):
        begin, end = offsets[k], offsets[k + 1]
        at = begin
        while end - at >= length:
            upto = min(end, at + PIECE)
            group.append((k, at - begin, data[at:upto]))
            held += upto - at
            if held >= PIECE:
                yield group
                group, held = [], 0
            if upto == end:
                break
            at = upto - length + 1
    if group:
        yield group


def spread(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The segments of the texts by bucket; equal segments of a group of texts go out once."""
    for batch in batches:
        ids, sigs = batch.column("doc_id").to_pylist(), batch.column("sig").to_pylist()
        for group in pieces(batch, length):
            data = np.concatenate([x for _, _, x in group])
            bounds = np.cumsum([len(x) for _, _, x in group])
            begins = bounds - [len(x) for _, _, x in group]
            first, size, least, piece = cut_segments(data, bounds, length)
            bucket = (least % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            raw = data.tobytes()
            squeeze = zstandard.ZstdCompressor(level=3)
            out = {k: [] for k in ("bucket", "texts", "lengths", "occurrences", "doc_id", "sig")}
            rows = np.array([k for k, _, _ in group])
            offset = np.array([o for _, o, _ in group])
            for j in np.flatnonzero(np.diff(cuts)):
                mine = order[cuts[j] : cuts[j + 1]]
                ends = (first[mine] + size[mine] + length - 1).tolist()
                known: dict[bytes, int] = {}
                which = [known.setdefault(raw[a:b], len(known)) for a, b in zip(first[mine].tolist(), ends, strict=True)]
                where = rows[piece[mine]]
                used, local = np.unique(where, return_inverse=True)
                place = first[mine] - begins[piece[mine]] + offset[piece[mine]]
                out["bucket"].append(int(j))
                out["texts"].append(squeeze.compress(b"".join(known)))
                out["lengths"].append(np.array([len(x) for x in known], np.int32).tobytes())
                out["occurrences"].append(squeeze.compress(np.array([which, local, place], np.int32).tobytes()))
                out["doc_id"].append([ids[k] for k in used])
                out["sig"].append([sigs[k] for k in used])
            yield pa.RecordBatch.from_pydict(
                out,
                pa.schema([("bucket", pa.int32()), ("texts", pa.binary()), ("lengths", pa.binary()), ("occurrences", pa.binary()), ("doc_id", pa.list_(pa.int64())), ("sig", pa.list_(pa.int64()))]),
            )


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorted order of rows, and whether a row of it equals the one before."""
    order = np.lexsort(columns)
    same = np.append(False, np.ones(len(order) - 1, bool)) if len(order) else np.empty(0, bool)
    for c in columns:
        ranked = c[order]
        same[1:] &= ranked[1:] == ranked[:-1]
    return order, same


def cover_ranks(data: np.ndarray, sums: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The places whose window of ``width`` bytes occurs again among ``at``, and the rank of each."""
    prints = window(sums, at, at + width)
    # Only the upper part of the prints is sorted first, with the place in the lower bits.
    low = U64(max(1, int(len(at)).bit_length()))
    packed = np.sort((prints >> low << low) | np.arange(len(at), dtype=U64))
    top = packed >> low
    twin = np.append(False, top[1:] == top[:-1])
    twin[:-1] |= twin[1:].copy()
    some = (packed[twin] & ((U64(1) << low) - U64(1))).astype(np.int64)
    order, same = _runs(prints[some])
    some = some[order]
    for step in [*range(0, width - 7, 8), width - 8]:  # equal prints must be equal bytes
        word = words64(data, at[some] + step)
        same[1:] &= word[1:] == word[:-1]
    rank = np.cumsum(~same) - 1
    shared = same.copy()
    shared[:-1] |= same[1:]
    return at[some[shared]], rank[shared]


def repeated_starts(data: np.ndarray, lengths: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from each place of ``data`` also start elsewhere in it.

    ``data`` is segments of the given lengths, one after the other; no string reaches over an end.
    """
    n = len(data)
    ends = np.repeat(np.cumsum(lengths), lengths)
    place = np.arange(n)
    width = length - PERIOD + 1
    covered = np.isin(np.arange(PERIOD), COVER)[place % PERIOD]
    sums = running(np.take(mix(np.arange(1, 257, dtype=U64)), data))
    at = np.flatnonzero(covered & (place + width <= ends))
    at, rank = cover_ranks(data, sums, at, width)
    ranks = np.full(n + PERIOD, -1, np.int64)
    ranks[at] = rank
    out = np.zeros(n, bool)
    for offset in range(PERIOD):
        start = at - offset
        start = start[start >= 0]
        start = start[start + length <= ends[start]]
        # The segment of the sample and of the suffix must be one.
        start = start[ends[start] == ends[start + offset]]
        if not len(start):
            continue
        key = ranks[start + offset]
        a, b = words64(data, start), words64(data, start + 8)
        c, d = words64(data, start + length - 16), words64(data, start + length - 8)
        tie = mix(mix(mix(mix(a) ^ b) ^ c) ^ d) ^ mix(key.astype(U64))
        order = np.argsort(tie)
        same = tie[order][1:] == tie[order][:-1]
        for column in (key, a, b, c, d):
            column = column[order]
            same &= column[1:] == column[:-1]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        out[start[order[twice]]] = True
    return out


def sort_bucket(table: pa.Table, length: int) -> pa.Table:
    """Sort one bucket; the stretches of repeated starts of each document in it."""
    known: dict[bytes, int] = {}
    found, squeeze = [], zstandard.ZstdDecompressor()
    for row in range(table.num_rows):
        texts = squeeze.decompress(table.column("texts")[row].as_py())
        ends = np.cumsum(np.frombuffer(table.column("lengths")[row].as_buffer(), np.int32)).tolist()
        name = [known.setdefault(texts[a:b], len(known)) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        which, local, place = np.frombuffer(squeeze.decompress(table.column("occurrences")[row].as_py()), np.int32).reshape(3, -1)
        found.append((np.array(name)[which], local, place.astype(np.int64)))
    lengths = np.array([len(x) for x in known], np.int64)
    data = np.frombuffer(b"".join(known), np.uint8)
    starts = repeated_starts(data, lengths, length)
    begins = np.cumsum(lengths) - lengths
    times = np.bincount(np.concatenate([f[0] for f in found]), minlength=len(known))
    for k in np.flatnonzero(times > 1):
        starts[begins[k] : begins[k] + lengths[k] - length + 1] = True
    # Runs of repeated starts, segment by segment.
    edge = np.diff(np.concatenate(([0], starts.astype(np.int8), [0])))
    run_from, run_to = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(begins, run_from, side="right") - 1
    first_run = np.searchsorted(owner, np.arange(len(known) + 1))
    out = {"doc_id": [], "sig": [], "begin": [], "upto": []}
    for row, (name, local, place) in enumerate(found):
        count = first_run[name + 1] - first_run[name]
        each = np.repeat(np.arange(len(name)), count)
        run = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count) + first_run[name[each]]
        shift = place[each] - begins[name[each]]
        out["doc_id"].append(table.column("doc_id")[row].values.take(pa.array(local[each])))
        out["sig"].append(table.column("sig")[row].values.take(pa.array(local[each])))
        out["begin"].append(pa.array(run_from[run] + shift))
        out["upto"].append(pa.array(run_to[run] + shift))
    return pa.table({k: pa.chunked_array(v) for k, v in out.items()})


def repeated_stretches(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, sig, starts: for each document with repeats, array of (begin, upto) of repeated starts."""
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = max(64, int(total * SPREAD / BUCKET_BYTES) + 1)
    segments = docs.mapInArrow(lambda batches: spread(batches, length, buckets), SEGMENTS)

    def sort_and_give_back(table: pa.Table) -> pa.Table:
        found = sort_bucket(table, length)
        give_back(collect=False)
        return found

    runs = segments.groupBy("bucket").applyInArrow(
        sort_and_give_back, "doc_id bigint, sig bigint, begin bigint, upto bigint"
    )
    return runs.groupBy("doc_id", "sig").agg(F.collect_set(F.struct("begin", "upto")).alias("starts"))


def cut_spans(text: bytes, starts: list[dict], length: int) -> tuple[bytes, list[dict]]:
    """The rest of a text and its maximal removed runs."""
    spans: list[list[int]] = []
    for begin, end in sorted((s["begin"], s["upto"] - 1 + length) for s in starts):
        if spans and begin <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([begin, end])
    kept, at = [], 0
    for begin, end in spans:
        kept.append(text[at:begin])
        at = end
    return b"".join([*kept, text[at:]]), [{"begin": b, "upto": e} for b, e in spans]


def remove_repeats(
    docs: DataFrame, length: int = 200, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Each row of ``docs`` with its repeated strings removed.

    Returned: row (the input row, or its columns ``keep``), n_bytes, kept (binary, the remaining
    bytes), kept_text (the same without characters of which a part was cut; null where nothing
    was) and spans (array of begin, upto: the maximal removed runs of bytes). A byte goes if a
    string of ``length`` bytes that covers it also starts anywhere else, the same document
    included; every copy goes. Null is the empty text; texts shorter than ``length`` lose nothing;
    repeated rows repeat each other. Documents are told apart by their id, null included, and a
    hash of the text.
    """
    if length < 2 * GRAM + PERIOD:
        raise ValueError(f"length must be at least {2 * GRAM + PERIOD}")
    text = docs[f"`{text_column}`"].cast("string")
    key = [docs[f"`{id_column}`"].cast("bigint").alias("doc_id"), F.xxhash64(text).alias("sig")]
    starts = repeated_stretches(docs.select(*key, text.alias("text")), length)
    docs = docs.select(*row_and_text(docs, text_column, keep), *key)
    starts = starts.select(F.col("doc_id").alias("id"), F.col("sig").alias("s"), "starts")

    def cut(batches):
        for batch in (whole.slice(at, ROWS_A_CUT) for whole in batches for at in range(0, whole.num_rows, ROWS_A_CUT)):
            size, kept, texts, spans = [], [], [], []
            for text, found in zip(text_of(batch, text_column), batch.column("starts"), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                rest, runs = cut_spans(raw, found.as_py(), length) if found.is_valid else (raw, [])
                size.append(len(raw))
                kept.append(rest)
                texts.append(rest.decode("utf-8", "ignore") if runs else None)
                spans.append(runs)
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("upto", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(size, pa.int64()), pa.array(kept, pa.binary()), pa.array(texts, pa.string()), pa.array(spans, kind)],
                ["row", "n_bytes", "kept", "kept_text", "spans"],
            )
        give_back()

    joined = docs.join(starts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("sig") == F.col("s")), "left")
    kinds = row_and(docs, "n_bytes bigint, kept binary, kept_text string, spans array<struct<begin:bigint,upto:bigint>>")
    return joined.drop("doc_id", "sig", "id", "s").mapInArrow(cut, kinds)
