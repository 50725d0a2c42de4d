"""Hard negatives by a secondary sort: for each anchor and positive, the nearest rows of other labels.

The score of a row is its integer inner product with the anchor, of components ``floor(256 * x)``.
The anchors, a stated query set, meet all rows in tiles of two bounded blocks. A first round of
tiles finds each anchor's positives, its best rows of the same label, and so the windows of scores
in which its negatives lie. A second round keeps of each tile the rows that can be among the first
of a window, so that few pairs leave a tile. The pairs go out under the key (anchor, descending
score, id); one shuffle by anchor that sorts within partitions brings each anchor's pairs in order,
and an iterator opens a window when a positive passes and gives out the rows that fall into it. It
holds the open windows of one anchor, never the anchor's rows.

This is the DataFrame form of ``repartitionAndSortWithinPartitions``: the key is packed into one
binary column whose byte order is the wanted order, and the sort stays in the JVM, where it spills.

Rows whose label, id or vector is null, or of which a component is null or not finite, take no part.
Rows that repeat an id are rows of their own; each is an anchor if its id is one. A vector that is
shorter than another counts as filled up with zeros. A score beyond 64 bits becomes the nearest
64-bit number. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timelegs.llm.store import Workspace
from timelegs.llm.textkeys import U64, mix

ROWS_A_BLOCK = 1024
TILE_BYTES = 8 << 20  # of vectors, on either side of a tile
LEAST_PARTS = 64  # tiles of a small table, so that all cores have work
RUN = 1 << 18  # rows scored under one numbering; places need 20 bits of a key
NONE = int(np.iinfo(np.int64).min)
LONGEST = int(np.iinfo(np.int64).max)
BODY = "n bigint, dims int, ids binary, labels binary, marks binary, vectors binary, kind string"
PAIR = "anchor bigint, anchor_id bigint, score bigint, id bigint"
MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


class Rows:
    """Vectors with their ids, labels and row numbers as arrays; a row number names a row for good."""

    def __init__(self, ids, labels, numbers, vectors):
        self.ids, self.labels, self.numbers, self.vectors = ids, labels, numbers, vectors

    def __len__(self):
        return len(self.ids)

    def take(self, which) -> Rows:
        return Rows(self.ids[which], self.labels[which], self.numbers[which], self.vectors[which])

    def cells(self) -> dict:
        v = self.vectors
        largest = np.abs(v).max(initial=0)
        kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<f8"
        arrays = {"ids": self.ids.astype("<i8"), "labels": self.labels.astype("<i8"), "marks": self.numbers.astype("<i8"), "vectors": v.astype(kind)}
        return {"n": len(self), "dims": v.shape[1], "kind": kind} | {k: a.tobytes() for k, a in arrays.items()}

    @staticmethod
    def of(cells: dict) -> Rows:
        vectors = np.frombuffer(cells["vectors"], cells["kind"]).astype(np.float64).reshape(cells["n"], cells["dims"])
        return Rows(*(np.frombuffer(cells[k], "<i8") for k in ("ids", "labels", "marks")), vectors)

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        dims = max((p.vectors.shape[1] for p in parts), default=0)
        vectors = [np.pad(p.vectors, ((0, 0), (0, dims - p.vectors.shape[1]))) for p in parts]
        return Rows(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("ids", "labels", "numbers")), np.concatenate(vectors))


def _record(rows: list[dict], ddl_names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(ddl_names, types, strict=True))))


BODY_NAMES = ["n", "dims", "ids", "labels", "marks", "vectors", "kind"]
BODY_TYPES = [pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.string()]
PAIR_NAMES = ["anchor", "anchor_id", "score", "id"]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows that take part; the marks of a block say which of its rows are anchors."""
    part, made = TaskContext.get().partitionId(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_A_BLOCK):
            piece = batch.slice(at, ROWS_A_BLOCK)
            lists = piece.column("vector")
            sizes = np.asarray(lists.value_lengths())
            flat = np.asarray(lists.flatten(), np.float64)
            vectors = np.zeros((len(sizes), sizes.max(initial=0)))
            vectors[np.arange(vectors.shape[1]) < sizes[:, None]] = np.floor(256.0 * flat)
            vectors[np.isinf(vectors)] = np.sign(vectors[np.isinf(vectors)]) * np.finfo(np.float64).max
            rows = Rows(*(np.asarray(piece.column(c)) for c in ("id", "label", "anchor")), vectors)
            yield _record([{"block": (part << 32) | made} | rows.cells()], ["block", *BODY_NAMES], [pa.int64(), *BODY_TYPES])
            made += 1


def _numbered(cells: dict) -> tuple[Rows, np.ndarray]:
    """A block's rows under numbers of their own, and which of them are anchors."""
    rows = Rows.of(cells)
    marks = rows.numbers != 0
    rows.numbers = (cells["block"] * ROWS_A_BLOCK) + np.arange(len(rows))
    return rows, marks


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products as 64-bit numbers."""
    dims = min(anchors.shape[1], rows.shape[1])
    a, r = anchors[:, :dims], rows[:, :dims]
    bound = np.abs(a).max(initial=0) * np.abs(r).max(initial=0) * max(dims, 1)
    if bound < 2.0**53:
        return (a @ r.T).astype(np.int64)
    whole = np.array([[int(x) for x in v] for v in a], object).reshape(a.shape) @ np.array([[int(x) for x in v] for v in r], object).reshape(r.shape).T
    return np.clip(whole, NONE + 1, LONGEST).astype(np.int64)


def _keys(found: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """One number per pair that grows with the score and falls with the row's place.

    Scores too large for 43 bits are replaced by their rank among the scores of this array.
    """
    if np.abs(found).max(initial=0) < 1 << 42:
        return (found << 20) + (RUN - places), None
    values, ranks = np.unique(found, return_inverse=True)
    return (ranks.reshape(found.shape).astype(np.int64) << 20) + (RUN - places), values


def _open(keys: np.ndarray, values: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Scores and places of keys."""
    high, place = keys >> 20, RUN - (keys & ((1 << 20) - 1))
    return (high if values is None else values[high]), place


def _runs(left: pa.Table) -> Iterator[Rows]:
    """The rows of a tile, at most ``RUN`` at a time, in the order of their ids."""
    held, size = [], 0
    for i in range(left.num_rows):
        rows, _ = _numbered({c: left.column(c)[i].as_py() for c in ["block", *BODY_NAMES]})
        if size + len(rows) > RUN:
            yield _by_id(held)
            held, size = [], 0
        held.append(rows)
        size += len(rows)
    if held:
        yield _by_id(held)


def _by_id(parts: list[Rows]) -> Rows:
    rows = Rows.joined(parts)
    return rows.take(np.argsort(rows.ids, kind="stable"))


def _chunks(size: int, step: int) -> Iterator[slice]:
    return (slice(at, min(size, at + step)) for at in range(0, size, step))


def _pairs(anchors: Rows, which: np.ndarray, first: int, score: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (first + which, anchors.ids[which], score, ids)], PAIR_NAMES)


def _best_of_label(rows: Rows, anchors: Rows, first: int, most: int) -> Iterator[pa.RecordBatch]:
    """Each anchor's ``most`` best other rows of its label among ``rows``."""
    for label in np.intersect1d(anchors.labels, rows.labels):
        mine, theirs = np.flatnonzero(anchors.labels == label), np.flatnonzero(rows.labels == label)
        for a in _chunks(len(mine), 256):
            best = np.full((len(mine[a]), 0), NONE)
            kept = (best, best)
            for r in _chunks(len(theirs), 8192):
                found = scores(anchors.vectors[mine[a]], rows.vectors[theirs[r]])
                itself = anchors.numbers[mine[a]][:, None] == rows.numbers[theirs[r]][None, :]
                keys, values = _keys(found, np.broadcast_to(theirs[r], found.shape))
                keys[itself] = NONE
                keys = np.partition(keys, max(0, keys.shape[1] - most), axis=1)[:, -most:]
                none = keys == NONE
                score, place = _open(np.where(none, 0, keys), values)
                score, place = np.where(none, NONE, score), np.where(none, LONGEST, place)
                score, place = np.concatenate([kept[0], score], axis=1), np.concatenate([kept[1], place], axis=1)
                order = np.lexsort((place, -np.maximum(score, -LONGEST)), axis=1)[:, :most]
                kept = (np.take_along_axis(score, order, 1), np.take_along_axis(place, order, 1))
            there = np.nonzero(kept[1] != LONGEST)
            yield _pairs(anchors, mine[a][there[0]], first, kept[0][there], rows.ids[kept[1][there]])


def _in_windows(rows: Rows, anchors: Rows, first: int, low: np.ndarray, high: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of other labels that are among the ``most`` first of a window of an anchor among ``rows``.

    ``low`` and ``high`` are an anchor's windows, inclusive; where low is above high there is none.
    """
    windows = low.shape[1]
    for a in _chunks(len(anchors), 128):
        kept: list[np.ndarray] = []
        for r in _chunks(len(rows), 8192):
            found = scores(anchors.vectors[a], rows.vectors[r])
            other = anchors.labels[a][:, None] != rows.labels[r][None, :]
            keys, values = _keys(found, np.broadcast_to(np.arange(r.start, r.stop), found.shape))
            keys = np.where(other, keys, NONE)
            keys = -np.sort(-np.maximum(keys, -LONGEST), axis=1)
            for w in range(windows):
                lo, hi = low[a, w], high[a, w]
                if values is not None:
                    lo, hi = np.searchsorted(values, lo, "left"), np.searchsorted(values, hi, "right") - 1
                begin = np.count_nonzero(keys >> 20 > hi[:, None], axis=1)
                at = begin[:, None] + np.arange(most)
                taken = np.take_along_axis(keys, np.minimum(at, keys.shape[1] - 1), 1)
                fits = (at < keys.shape[1]) & (taken >> 20 >= lo[:, None]) & (taken >> 20 <= hi[:, None]) & (taken > -LONGEST)
                one, column = np.nonzero(fits)
                score, place = _open(taken[one, column], values)
                kept.append(np.stack([one, np.full(len(one), w), score, place]))
        pairs = np.concatenate(kept, axis=1) if kept else np.empty((4, 0), np.int64)
        one, window, score, place = pairs[:, np.lexsort((pairs[3], -pairs[2], pairs[1], pairs[0]))]
        new = np.append(True, (one[1:] != one[:-1]) | (window[1:] != window[:-1])) if len(one) else np.empty(0, bool)
        rank = np.arange(len(one)) - np.maximum.accumulate(np.where(new, np.arange(len(one)), 0))
        _, once = np.unique(np.stack([one, place])[:, rank < most], axis=1, return_index=True)
        one, score, place = (x[rank < most][once] for x in (one, score, place))
        yield _pairs(anchors, one + a.start, first, score, rows.ids[place])


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(list(batches), pa.schema([(c, pa.int64()) for c in PAIR_NAMES]))


def _sort_key(anchor: Column, score: Column, row_id: Column, negative: int) -> Column:
    """(anchor, descending score, id, positives first) as bytes in the wanted order."""
    sign = F.bitwise_not(F.lit(LONGEST).cast("bigint"))
    parts = [anchor.bitwiseXOR(sign), F.bitwise_not(score).bitwiseXOR(sign), row_id.bitwiseXOR(sign)]
    hexes = [F.lpad(F.hex(p), 16, "0") for p in parts]
    return F.unhex(F.concat(*hexes, F.lit(f"{negative:02x}")))


def _stream(most: int, percent: tuple[int, int]):
    """The iterator over sorted pairs: opens windows at positives and gives out negatives."""
    low, high = percent
    top, mask = 1 << 63, (1 << 64) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, name, windows, zeros = None, None, [], []
        out: list[tuple] = []

        def offer(score, row_id):
            for w in windows:
                if w[2] < most and low * w[1] <= 100 * score <= high * w[1]:
                    w[2] += 1
                    out.append((name, w[0], w[2], row_id, w[1], score))

        for batch in batches:
            for key, anchor_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                number, score, row_id, negative = struct.unpack(">QQQB", key)
                score, row_id = (~(score ^ top)) & mask, row_id ^ top
                score, row_id = score - (score >> 63 << 64), row_id - (row_id >> 63 << 64)
                if number != anchor:
                    anchor, name, windows, zeros = number, anchor_id, [], []
                if not negative:
                    windows.append([row_id, score, 0])
                    if score == 0:  # its window is the score 0 itself, of which rows may have passed
                        passed, before = zeros, windows
                        windows = windows[-1:]
                        for z in passed:
                            offer(0, z)
                        windows = before
                else:
                    if score == 0 and len(zeros) < most:
                        zeros.append(row_id)
                    offer(score, row_id)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), o, strict=True)) for o in out], MINED_TYPE)
                out.clear()

    return run


MINED_TYPE = pa.schema([(c, pa.int32() if c == "rank" else pa.int64()) for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    label_column: str | Column = "label",
    vector_column: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    percent: tuple[int, int] = (30, 90),
) -> DataFrame:
    """For each anchor and each of its first ``positives``, the first ``negatives`` rows in its window.

    A negative has another label, and its score lies between the two percentages of the positive's.
    Rows are ordered by descending score, then id. Columns: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.
    """
    spark = vectors.sparkSession
    space = Workspace(spark, "hard-negatives")
    label = F.col(label_column) if isinstance(label_column, str) else label_column
    given = vectors.select(
        F.col(id_column).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).cast("bigint").alias("anchor"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = given.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    blocks = space.write(usable.mapInArrow(_pack, f"block bigint, {BODY}"), "blocks", "lz4")
    count = blocks.agg(F.sum("n"), F.sum(F.length("vectors"))).first()
    rows, size = count[0] or 0, count[1] or 0
    parts = max(LEAST_PARTS, -(-size // TILE_BYTES), -(-rows // RUN))

    def pick(batches):
        for batch in batches:
            for cells in batch.to_pylist():
                found, marks = _numbered(cells)
                chosen = np.flatnonzero(marks)
                if len(chosen):
                    yield _record([{"block": cells["block"]} | found.take(chosen).cells()], ["block", *BODY_NAMES], [pa.int64(), *BODY_TYPES])

    picked = space.write(blocks.mapInArrow(pick, f"block bigint, {BODY}"), "picked", "lz4")
    count = picked.agg(F.sum(F.length("vectors")), F.sum("n")).first()
    groups = max(1, -(-(count[0] or 0) // TILE_BYTES), -(-(count[1] or 0) // RUN))

    def deal(batches):
        """Each block's anchors to groups by a hash of the row, so that copies are dealt evenly."""
        for batch in batches:
            for cells in batch.to_pylist():
                found = Rows.of(cells)
                group = (mix(found.numbers.view(U64) + U64(1)) % U64(groups)).astype(np.int64)
                rows = [{"tile": int(g)} | found.take(np.flatnonzero(group == g)).cells() for g in np.unique(group)]
                yield _record(rows, ["tile", *BODY_NAMES], [pa.int64(), *BODY_TYPES])

    def gather(table: pa.Table) -> pa.Table:
        parts_of = Rows.joined([Rows.of(c) for c in table.select(BODY_NAMES).to_pylist()])
        parts_of = parts_of.take(np.argsort(parts_of.numbers, kind="stable"))
        return pa.Table.from_batches([_record([{"tile": table.column("tile")[0].as_py()} | parts_of.cells()], ["tile", *BODY_NAMES], [pa.int64(), *BODY_TYPES])])

    dealt = picked.mapInArrow(deal, f"tile bigint, {BODY}").groupBy("tile").applyInArrow(gather, f"tile bigint, {BODY}")
    anchors = space.write(dealt, "anchors", "lz4")

    part = F.pmod(F.xxhash64("block"), F.lit(parts))
    spread = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")).alias("tile"), part.alias("part"), *blocks.columns).groupBy("tile", "part")
    all_parts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")).alias("part")

    def first_round(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table([])
        few = Rows.of({c: right.column(c)[0].as_py() for c in BODY_NAMES})
        first = right.column("tile")[0].as_py() << 20
        return _table(b for rows in _runs(left) for b in _best_of_label(rows, few, first, positives))

    met = spread.cogroup(anchors.select(all_parts, "*").groupBy("tile", "part")).applyInArrow(first_round, PAIR)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    ranked = met.select("*", F.row_number().over(order).alias("nth")).filter(F.col("nth") <= positives)
    chosen = space.write(ranked.select("anchor", "anchor_id", "score", "id"), "positives", "lz4")

    windows = chosen.groupBy(F.shiftright("anchor", 20).alias("tile")).agg(F.collect_list(F.struct("anchor", "score")).alias("positives"))

    def second_round(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows or not right.column("positives")[0].is_valid:
            return _table([])
        few = Rows.of({c: right.column(c)[0].as_py() for c in BODY_NAMES})
        first = right.column("tile")[0].as_py() << 20
        low, high = np.ones((len(few), positives), np.int64), np.zeros((len(few), positives), np.int64)
        filled = np.zeros(len(few), int)
        for p in right.column("positives")[0].as_py():
            i = p["anchor"] - first
            low[i, filled[i]], high[i, filled[i]] = -(-percent[0] * p["score"] // 100), percent[1] * p["score"] // 100
            filled[i] += 1
        return _table(b for rows in _runs(left) for b in _in_windows(rows, few, first, low, high, negatives))

    aimed = anchors.join(windows, "tile", "left").select(all_parts, "*")
    candidates = spread.cogroup(aimed.groupBy("tile", "part")).applyInArrow(second_round, PAIR)
    key = [_sort_key(F.col("anchor"), F.col("score"), F.col("id"), n) for n in (0, 1)]
    keyed = chosen.select("anchor", "anchor_id", key[0].alias("key")).unionByName(candidates.select("anchor", "anchor_id", key[1].alias("key")))
    in_order = keyed.repartition("anchor").sortWithinPartitions("key").select("key", "anchor_id")
    return in_order.mapInArrow(_stream(negatives, percent), MINED)


MINE_SQL = """
WITH given AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM {embeddings}
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM given a JOIN given b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, id, score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
    n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 10
"""
