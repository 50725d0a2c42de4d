"""A corpus packed into blocks, and totals of keys over all blocks.

A block holds whole documents, about two megabytes of text, compressed. It is written once, so
that its number and content stay the same whenever a task is run again, and so that an answer
about a key can go back to the block instead of the key's positions travelling with it.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.llm.textkeys import U64

BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
SCHEMA = "block bigint, doc_id array<bigint>, sizes array<int>, body binary"
TOTALS = "block bigint, bucket int, body binary, present bigint, mass bigint, largest array<struct<key:bigint,total:bigint>>, binned array<struct<bin:int,mass:bigint,types:bigint>>"
SHIFT = 24  # a block has less documents than 2**SHIFT, since each takes a byte at least


def give_back(collect: bool = True) -> None:
    """Return memory that a task no longer uses: a worker lives on and takes other stages' tasks."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


@dataclass
class Block:
    """Documents of a block: ``data[starts[i]:ends[i]]`` is the text of row ``i``, then one line feed."""

    block: int
    doc_id: list
    sizes: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: dict

    def spans(self, positions: np.ndarray) -> np.ndarray:
        """Where each document begins in a sorted list of positions; one more entry than rows."""
        return np.searchsorted(positions, np.append(self.starts, len(self.data)))


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    ids, sizes, texts, held = [], [], [], 0

    def flush():
        nonlocal ids, sizes, texts, held, made
        body = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
        row = {"block": [(part << 24) | made], "doc_id": [ids], "sizes": [sizes], "body": [body]}
        ids, sizes, texts, held, made = [], [], [], 0, made + 1
        return pa.RecordBatch.from_pydict(row, pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("body", pa.binary())]))

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else None
            ids.append(doc_id)
            sizes.append(-1 if raw is None else len(raw))
            texts.append((raw or b"") + b"\n")
            held += len(texts[-1])
            if held >= BLOCK_BYTES:
                yield flush()
    if ids:
        yield flush()
    give_back()


def make_blocks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per block of documents. No shuffle; write the result before using its numbers."""
    return docs.select(F.col(id_column).cast("bigint"), F.col(text_column).cast("string")).mapInArrow(pack, SCHEMA)


def open_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
            sizes = np.array(row["sizes"].as_py(), np.int64)
            data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["body"].as_py()), np.uint8)
            ends = np.cumsum(np.maximum(sizes, 0) + 1) - 1
            yield Block(row["block"].as_py(), row["doc_id"].as_py(), sizes, data, ends - np.maximum(sizes, 0), ends, row)
    give_back()


def bucket_count(blocks: DataFrame, bytes_per_byte: float) -> int:
    """Buckets so that each holds about ``BUCKET_BYTES`` of keys, from the exact size of the text."""
    total = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    return max(64, int(total * bytes_per_byte / BUCKET_BYTES) + 1)


def key_totals(
    blocks: DataFrame,
    emit: Callable[[Block], tuple[np.ndarray, np.ndarray]],
    answer: Callable[[np.ndarray], np.ndarray],
    buckets: int,
    weight: str = "u1",
    top: int = 0,
    bits: int = 0,
    key_bytes: int = 8,
) -> DataFrame:
    """For each block, what ``answer`` makes of the totals of its keys over all blocks.

    ``emit`` gives a block's sorted distinct keys and their counts (capped at the largest value
    of ``weight``). A key goes out once per block, however often it occurs, so no key's share of
    the rows matters. ``answer`` maps totals to an array of bytes; ``read_answers`` puts the
    answers in the order of the block's keys. Returned: block, bucket, body, and on one row of
    each bucket the number of its keys with a total above zero, the sum of all its totals, its
    ``top`` keys of largest total and, if ``bits`` are given, sum and number by the keys' first bits.

    With fewer ``key_bytes`` than 8 a key goes out as its place in its bucket's range, rounded to so
    many bytes. Two keys may then count as one: totals can be too large, never too small.
    """
    edges = np.array([-(-(j << 64) // buckets) for j in range(1, buckets)], U64)
    shift = U64(max(0, (-(-(1 << 64) // buckets)).bit_length() - 8 * key_bytes))

    def sent(keys: np.ndarray, bucket: int) -> bytes:
        if key_bytes == 8:
            return keys.tobytes()
        places = (keys - (edges[bucket - 1] if bucket else U64(0))) >> shift
        return places.view(np.uint8).reshape(-1, 8)[:, :key_bytes].tobytes()

    def received(cell: pa.Scalar) -> np.ndarray:
        if key_bytes == 8:
            return np.frombuffer(cell.as_buffer(), U64)
        places = np.frombuffer(cell.as_buffer(), np.uint8).reshape(-1, key_bytes)
        return np.pad(places, ((0, 0), (0, 8 - key_bytes))).view(U64)[:, 0]

    def spread(batches):
        most = np.iinfo(weight).max
        for b in open_blocks(batches):
            keys, counts = emit(b)
            counts = np.minimum(counts, most).astype(weight)
            cuts = np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))
            used = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": np.full(len(used), b.block, np.int64),
                    "bucket": used.astype(np.int32),
                    "keys": pa.array([sent(keys[cuts[j] : cuts[j + 1]], j) for j in used], pa.binary()),
                    "counts": pa.array([counts[cuts[j] : cuts[j + 1]].tobytes() for j in used], pa.binary()),
                }
            )

    def total(table: pa.Table) -> pa.Table:
        parts = [received(x) for x in table.column("keys")]
        keys = np.concatenate(parts)
        counts = np.concatenate([np.frombuffer(x.as_buffer(), weight) for x in table.column("counts")])
        order = np.argsort(keys)
        keys = keys[order]
        new = np.append(True, keys[1:] != keys[:-1])
        sums = np.add.reduceat(counts[order].astype(np.int64), np.flatnonzero(new))
        back = np.empty(len(keys), np.int64)
        back[order] = sums[np.cumsum(new) - 1]
        ends = np.cumsum([len(p) for p in parts])
        squeeze = zstandard.ZstdCompressor(level=1)
        first = np.zeros(len(parts), np.int64)
        present, mass = first.copy(), first.copy()
        present[0], mass[0] = np.count_nonzero(sums), sums.sum()
        names = keys[new]
        best = np.lexsort((names, -sums))[:top]
        largest = [[{"key": int(k), "total": int(n)} for k, n in zip(names[best].view(np.int64), sums[best], strict=True)]] + [[]] * (len(parts) - 1)
        bins = [[]] * len(parts)
        if bits and len(names):
            which = (names >> U64(64 - bits)).astype(np.int64)
            at = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            heaps = zip(which[at].tolist(), np.add.reduceat(sums, at).tolist(), np.add.reduceat((sums > 0).astype(np.int64), at).tolist(), strict=True)
            bins[0] = [{"bin": k, "mass": n, "types": v} for k, n, v in heaps if v]
        return pa.table(
            {
                "block": table.column("block"),
                "bucket": table.column("bucket"),
                "body": pa.array([squeeze.compress(answer(back[e - len(p) : e]).tobytes()) for p, e in zip(parts, ends, strict=True)], pa.binary()),
                "present": present,
                "mass": mass,
                "largest": pa.array(largest, pa.list_(pa.struct([("key", pa.int64()), ("total", pa.int64())]))),
                "binned": pa.array(bins, pa.list_(pa.struct([("bin", pa.int32()), ("mass", pa.int64()), ("types", pa.int64())]))),
            }
        )

    spread_out = blocks.mapInArrow(spread, "block bigint, bucket int, keys binary, counts binary")
    return spread_out.groupBy("bucket").applyInArrow(total, TOTALS)


def gather_answers(totals: DataFrame, name: str) -> DataFrame:
    """One row per block with its answers in the order of the buckets."""
    return totals.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "body"))).alias(name))


def read_answers(cell: pa.Scalar, dtype: str) -> np.ndarray:
    """The answers of one block, one for each of its sorted distinct keys."""
    found = cell.as_py() or []
    squeeze = zstandard.ZstdDecompressor()
    parts = [np.frombuffer(squeeze.decompress(x["body"]), dtype) for x in found]
    return np.concatenate(parts) if parts else np.empty(0, dtype)
