"""Alignment of two tokenizers by a merge of their token ends that is cut along its merge path.

Each text is encoded by both tokenizers, and each token then is the byte at which it ends. Merging
the two sorted lists of ends finds the bytes where tokens of both end: there the text is cut into
groups, and the two tokens that end there are linked. The texts of a block follow each other in
one long list, so that the work of a merge doesn't depend on where texts begin. Diagonals of the
merge matrix, each found by a binary search, cut the merge into pieces of equal work; a piece is a
row of its own, merged by any task without the others. Ends that are equal stay in one piece, so a
piece finds all its links; what lies open at its borders is stitched where texts were cut.

How often a pair of ids is linked is summed over all pieces. The bytes of one token of a linked pair
end those of the other, and a token of n bytes has n endings, so the pairs are at most the bytes of
both vocabularies together (about half a million), whatever the corpus: their counts are broadcast.

Texts that are null or empty, or of which either side's bytes differ from a space and the text,
have no tokens; their rows have zeros and an empty text of groups. Rows that repeat an id, or have
none, stay rows of their own. Empty tables give no rows. Other columns are not read. A text has to
fit into one row, as do its groups.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from copy import copy
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timelegs.llm.store import Workspace

WORK = 1 << 18  # ends in a piece
BLOCK_BYTES = 1 << 20  # text in a block
CALL_BYTES = 1 << 17  # text encoded in one call
PIECES = "piece bigint, a_from bigint, b_from bigint, a_ids binary, b_ids binary, rows binary, doc_ids array<bigint>"
PIECE_TYPE = pa.schema(
    [("piece", pa.int64()), ("a_from", pa.int64()), ("b_from", pa.int64()), ("a_ids", pa.binary()), ("b_ids", pa.binary()), ("rows", pa.binary()), ("doc_ids", pa.list_(pa.int64()))]
)
OPEN = ["head_a", "head_b", "body", "tail_a", "tail_b"]
FRAGMENT = "uid bigint, place bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, " + ", ".join(f"{c} string" for c in OPEN)
COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


@lru_cache(maxsize=2)
def byte_level(path: str):
    """A byte-level tokenizer and the bytes of each of its ids."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    # Fixed by the format: printable bytes stand for themselves, the others for U+0100 onwards.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    code = {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    entries = [b""] * (max(model.get_vocab().values()) + 1)
    for token, k in model.get_vocab().items():
        entries[k] = bytes(code[c] for c in token) if all(c in code for c in token) else token.encode()
    return model, entries, np.array([len(e) for e in entries], np.int64)


# What splits a text into words is fixed by the format. In these characters, and in words of moderate
# length, both libraries find the same words; elsewhere their Unicode tables might differ.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = re.compile(r"(?!.*\S{1000})[\t\n\r\x20-\x7e\u00a1-\u024f]*", re.DOTALL)


@lru_cache(maxsize=2)
def ranked(path: str):
    """A faster encoder of the same vocabulary and merges, or None if they can't be given as ranks.

    Merges are ranks if the ids of what they make rise from merge to merge.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    vocabulary, merges = given["model"]["vocab"], given["model"]["merges"]
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    ruled = given["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    special = {t["id"] for t in given["added_tokens"]}
    entries = byte_level(path)[1]
    ranks = {entries[k]: k for k in vocabulary.values() if k not in special}
    if any(b <= a for a, b in zip(made, made[1:], strict=False)) or not ruled or given["normalizer"] or len(ranks) != 256 + len(made):
        return None
    return tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def pieces(path: str):
    """A piece tokenizer, which puts a space before the text, and the bytes of each of its ids."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)

    def of(k: int) -> bytes:
        name = model.id_to_piece(k)
        return bytes([int(name[3:-1], 16)]) if model.is_byte(k) else name.replace("▁", " ").encode()

    entries = [of(k) for k in range(model.piece_size())]
    return model, entries, np.array([len(e) for e in entries], np.int64)


def byte_level_ids(texts: list[str], path: str) -> list[list[int]]:
    """The ids of the byte-level tokenizer, by the faster encoder where it gives the same ones."""
    model, fast = byte_level(path)[0], ranked(path)
    out = [fast.encode_ordinary(t) if fast and PLAIN.fullmatch(t) else None for t in texts]
    rest = [k for k, ids in enumerate(out) if ids is None]
    for k, found in zip(rest, model.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False), strict=True):
        out[k] = found.ids
    return out


def encoded(texts: list[str | None], a_path: str, b_path: str) -> tuple[list[list[int]], list[list[int]]]:
    """The ids of each text on both sides; none where either side's bytes aren't a space and the text."""
    a_entries = byte_level(a_path)[1]
    b_model, b_entries, _ = pieces(b_path)
    a_out: list[list[int]] = [[] for _ in texts]
    b_out: list[list[int]] = [[] for _ in texts]
    used = [k for k, t in enumerate(texts) if t]
    at = 0
    while at < len(used):
        upto, size = at, 0
        while upto < len(used) and size < CALL_BYTES:
            size += len(texts[used[upto]])
            upto += 1
        call = used[at:upto]
        a = byte_level_ids([" " + texts[k] for k in call], a_path)
        b = b_model.encode([texts[k] for k in call], num_threads=1)
        for k, x, y in zip(call, a, b, strict=True):
            whole = (" " + texts[k]).encode()
            if b"".join(map(a_entries.__getitem__, x)) == whole and b"".join(map(b_entries.__getitem__, y)) == whole:
                a_out[k], b_out[k] = x, y
        at = upto
    return a_out, b_out


def cut_path(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of two sorted lists crosses every ``work``-th diagonal.

    Returned: places in ``a`` and in ``b``, from 0 to their lengths. A binary search along each
    diagonal finds the split into what is merged before it and after it; an end in ``a`` goes
    before an equal one in ``b``, and a split between two equal ends moves behind both.
    """
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, work), total) if total else np.zeros(2, np.int64)
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while np.any(low < high):
        middle = (low + high) // 2
        # a[middle] is merged before the diagonal if it isn't above b's last element before it
        other = diagonals - middle - 1
        before = (middle < high) & (other >= 0)
        before[before] = a[middle[before]] <= b[other[before]]
        low, high = np.where((low < high) & before, middle + 1, low), np.where((low < high) & ~before, middle, high)
    i, j = low, diagonals - low
    tie = (i > 0) & (j < len(b))
    tie[tie] = a[i[tie] - 1] == b[j[tie]]
    return i, j + tie


def _squeeze(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(x.tobytes())


def _open(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _cut_into_pieces(a_path: str, b_path: str, work: int, block_bytes: int):
    """Encode documents block by block and cut each block's merge into pieces.

    ``rows`` of a piece hold its documents: number, first and last byte in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, first = TaskContext.get().partitionId() << 32, 0
        a_lengths, b_lengths = byte_level(a_path)[2], pieces(b_path)[2]
        a_kind, b_kind = ("<u2" if len(x) <= 1 << 16 else "<u4" for x in (a_lengths, b_lengths))

        def flush(ids, texts):
            nonlocal made, first
            a_lists, b_lists = encoded(texts, a_path, b_path)
            a_arrays, b_arrays = ([np.array(x, np.int64) for x in lists] for lists in (a_lists, b_lists))
            sizes = np.array([a_lengths[x].sum() for x in a_arrays], np.int64)
            last = np.cumsum(sizes)
            a_ids, b_ids = np.concatenate(a_arrays), np.concatenate(b_arrays)
            a, b = np.cumsum(a_lengths[a_ids]), np.cumsum(b_lengths[b_ids])
            i, j = cut_path(a, b, work)
            numbers = (TaskContext.get().partitionId() << 40) + first + np.arange(len(ids))
            for p in range(len(i) - 1):
                a_from, b_from = (int(x[k[p] - 1]) if k[p] else 0 for x, k in ((a, i), (b, j)))
                upto = max([int(x[k[p + 1] - 1]) for x, k in ((a, i), (b, j)) if k[p + 1]], default=0)
                begun = 0 if p == 0 else max(a_from, b_from)
                here = np.flatnonzero((last > begun) & (last - sizes < upto) & (sizes > 0))
                if p == 0:  # documents without tokens go with the first piece
                    here = np.union1d(here, np.flatnonzero(sizes == 0))
                rows = np.stack([numbers[here], (last - sizes)[here], last[here]]).astype("<i8")
                yield {
                    "piece": made,
                    "a_from": a_from,
                    "b_from": b_from,
                    "a_ids": _squeeze(a_ids[i[p] : i[p + 1]].astype(a_kind)),
                    "b_ids": _squeeze(b_ids[j[p] : j[p + 1]].astype(b_kind)),
                    "rows": _squeeze(rows),
                    "doc_ids": [ids[k] for k in here],
                }
                made += 1
            first += len(ids)

        ids, texts, held = [], [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py()
                ids.append(batch.column(0)[k].as_py())
                texts.append(text)
                held += len(text or "") + 1
                if held >= block_bytes:
                    for piece in flush(ids, texts):
                        yield pa.RecordBatch.from_pylist([piece], PIECE_TYPE)
                    ids, texts, held = [], [], 0
        if ids:
            for piece in flush(ids, texts):
                yield pa.RecordBatch.from_pylist([piece], PIECE_TYPE)

    return run


class Piece:
    """One piece of a block's merge: its ids and ends, its links, and the documents that it touches."""

    def __init__(self, cells: dict, a_lengths: np.ndarray, b_lengths: np.ndarray):
        kinds = ("<u2" if len(x) <= 1 << 16 else "<u4" for x in (a_lengths, b_lengths))
        self.a_ids, self.b_ids = (_open(cells[c], k).astype(np.int64) for c, k in zip(("a_ids", "b_ids"), kinds, strict=True))
        self.a, self.b = cells["a_from"] + np.cumsum(a_lengths[self.a_ids]), cells["b_from"] + np.cumsum(b_lengths[self.b_ids])
        self.numbers, self.first, self.last = _open(cells["rows"], "<i8").reshape(3, -1)
        self.doc_ids = cells["doc_ids"]
        self.piece = cells["piece"]
        self.begun = max(cells["a_from"], cells["b_from"])
        self.upto = max(self.a.max(initial=0), self.b.max(initial=0))
        at = np.searchsorted(self.b, self.a)
        linked = np.flatnonzero((at < len(self.b)) & (self.b[np.minimum(at, len(self.b) - 1)] == self.a)) if len(self.b) else np.empty(0, np.int64)
        self.common = self.a[linked]
        self.pairs = (self.a_ids[linked] << 32) | self.b_ids[at[linked]]

    def only(self, a: slice, b: slice, common: slice) -> Piece:
        """The piece with a part of its tokens, those of one document."""
        part = copy(self)
        part.a, part.a_ids, part.b, part.b_ids, part.common = self.a[a], self.a_ids[a], self.b[b], self.b_ids[b], self.common[common]
        return part

    def whole(self) -> np.ndarray:
        """Documents that begin and end in this piece, or have no tokens."""
        return (self.first == self.last) | ((self.first >= self.begun) & (self.last <= self.upto))


@lru_cache(maxsize=4)
def _digits(size: int) -> np.ndarray:
    """The decimal digits of each id as a row of bytes, zero where there is none; one column is left."""
    width = len(str(max(size - 1, 0)))
    text = np.arange(size).astype(f"S{width + 1}")
    return text.view(np.uint8).reshape(size, width + 1)


def render(ids: np.ndarray, marks: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids as decimals, each followed by its mark (0: none); bytes and the bytes used by each id."""
    chars = table[ids]
    length = np.count_nonzero(chars, axis=1)
    chars[np.arange(len(ids)), length] = marks
    return chars, length + (marks > 0)


def _text_of_groups(piece: Piece, a_size: int, b_size: int):
    """A function from a range of bytes to the text of its groups, as the parts named in ``OPEN``.

    The groups of the whole piece are written out at once: first a group's ids of the one side,
    then those of the other, the ids of all groups in the order of the text.
    """
    a_group, b_group = np.searchsorted(piece.common, piece.a), np.searchsorted(piece.common, piece.b)
    groups = len(piece.common) + 1
    a_upto = np.cumsum(np.bincount(a_group, minlength=groups))
    b_upto = np.cumsum(np.bincount(b_group, minlength=groups))
    a_at = np.arange(len(piece.a)) + np.append(0, b_upto)[a_group]
    b_at = np.arange(len(piece.b)) + a_upto[b_group]
    width = max(_digits(a_size).shape[1], _digits(b_size).shape[1])
    chars = np.zeros((len(piece.a) + len(piece.b), width), np.uint8)
    length = np.zeros(len(chars), np.int64)
    for ids, at, group, upto, end, size in ((piece.a_ids, a_at, a_group, a_upto, "|", a_size), (piece.b_ids, b_at, b_group, b_upto, ";", b_size)):
        marks = np.full(len(ids), ord(","), np.uint8)
        closing = np.arange(len(ids)) == upto[group] - 1
        marks[closing & (group < groups - 1)] = ord(end)
        marks[closing & (group == groups - 1)] = 0
        text, used = render(ids, marks, _digits(size))
        chars[at, : text.shape[1]] = text
        length[at] = used
    flat = chars[chars > 0].tobytes()
    start = np.append(0, np.cumsum(length))
    # the text before group g's first id, and before its first id of the second side
    group_at = start[np.append(0, a_upto + b_upto)]
    second_at = start[np.append(0, (a_upto + b_upto)[:-1]) + np.diff(np.append(0, a_upto))]

    def of(low: int, high: int) -> dict:
        # groups that end in the range are low_group .. high_group - 1
        low_group, high_group = np.searchsorted(piece.common, [low, high], "right")
        parts = dict.fromkeys(OPEN, "")

        def two(group: int, names: tuple[str, str]):
            middle, end = second_at[group], group_at[group + 1]
            for name, x in zip(names, (flat[group_at[group] : middle], flat[middle:end]), strict=True):
                parts[name] = x.decode().rstrip("|;")

        if low_group == high_group:
            two(high_group, ("tail_a", "tail_b"))
            return parts
        two(low_group, ("head_a", "head_b"))
        parts["body"] = flat[group_at[low_group + 1] : group_at[high_group]].decode().rstrip(";")
        if high_group == groups - 1 and high > piece.upto:
            two(high_group, ("tail_a", "tail_b"))
        return parts

    return of


def stitch(fragments: list[dict]) -> str:
    """The text of a document's groups from its fragments in order."""
    out, open_a, open_b = [], [], []
    for f in fragments:
        if f["n_groups"]:
            left = ",".join(x for x in (*open_a, f["head_a"]) if x)
            right = ",".join(x for x in (*open_b, f["head_b"]) if x)
            out += [f"{left}|{right}"] + ([f["body"]] if f["body"] else [])
            open_a, open_b = [], []
        open_a.append(f["tail_a"])
        open_b.append(f["tail_b"])
    return ";".join(out)


def _fragments(piece: Piece, which: np.ndarray, counts: tuple[np.ndarray, ...], sizes: tuple[int, int]) -> list[dict]:
    """A row for each of a piece's documents ``which``: its tokens, links and groups in this piece."""
    pairs, totals, best = counts
    at = np.searchsorted(pairs, piece.pairs)
    total, first = np.append(0, np.cumsum(totals[at])), np.append(0, np.cumsum(best[at]))
    bounds = [np.searchsorted(x, np.stack([piece.first, piece.last]), "right") for x in (piece.a, piece.b, piece.common)]
    all_groups = _text_of_groups(piece, *sizes) if len(which) > 2 else None
    rows = []
    for k in which:
        (a0, a1), (b0, b1), (c0, c1) = (b[:, k] for b in bounds)
        row = {"uid": int(piece.numbers[k]), "place": piece.piece, "doc_id": piece.doc_ids[k], "n_a": a1 - a0, "n_b": b1 - b0, "n_groups": c1 - c0, "n_links": c1 - c0}
        row |= {"n_best": first[c1] - first[c0], "count_sum": total[c1] - total[c0]}
        row = {c: v if c == "doc_id" else int(v) for c, v in row.items()}
        if piece.first[k] == piece.last[k]:
            rows.append(row | dict.fromkeys(OPEN, ""))
            continue
        text = all_groups or _text_of_groups(piece.only(slice(a0, a1), slice(b0, b1), slice(c0, c1)), *sizes)
        rows.append(row | text(piece.first[k], piece.last[k]))
    return rows


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    of_groups: Callable[[Column], Column] = lambda groups: groups,
    work: int = WORK,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """How the tokens of a byte-level tokenizer (A) and a piece tokenizer (B) lie over each other.

    Columns per document: doc_id, n_a, n_b (tokens), n_groups, n_links (pairs of tokens that end
    together), n_best (links whose pair is linked most often of all pairs of its B id, ties
    included), count_sum (over links, how often the pair is linked in all documents), and groups,
    which is ``of_groups`` of the text ``a1,a2|b1;a3|b2,b3`` of the ids in order. The tokenizers'
    files have to be at their paths on every machine.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "merge-path")
    given = docs.select(F.col(id_column).cast("bigint"), F.col(text_column).cast("string"))
    cut = space.write(given.mapInArrow(_cut_into_pieces(a_path, b_path, work, block_bytes), PIECES), "pieces", "none")

    def lengths():
        return byte_level(a_path)[2], pieces(b_path)[2]

    def opened(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield Piece({c: batch.column(i)[k].as_py() for i, c in enumerate(batch.schema.names)}, *lengths())

    def linked(batches):
        for piece in opened(batches):
            pairs, n = np.unique(piece.pairs, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])

    totals = cut.mapInArrow(linked, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    # at most as many pairs as the vocabularies have bytes
    table = space.write(totals, "totals").toPandas().sort_values("pair")
    pairs, counts = table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64)
    of_b = pairs & 0xFFFFFFFF
    highest = np.zeros(int(of_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, of_b, counts)
    shared = spark.sparkContext.broadcast((pairs, counts, (counts == highest[of_b]).astype(np.int64)))

    def measured(cut_documents: bool):
        def run(batches):
            for piece in opened(batches):
                which = np.flatnonzero(piece.whole() != cut_documents)
                if len(which):
                    rows = _fragments(piece, which, shared.value, tuple(len(x) for x in lengths()))
                    yield pa.RecordBatch.from_pylist([{k: r[k] for k in FRAGMENT_TYPE.names} for r in rows], FRAGMENT_TYPE)

        return run

    def stitched(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        out = {"doc_id": rows[0]["doc_id"]} | {c: sum(r[c] for r in rows) for c in COUNTS} | {"groups": stitch(rows)}
        return pa.Table.from_pylist([out], pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("groups", pa.string())]))

    first = F.concat("head_a", F.lit("|"), "head_b")
    groups = F.when(F.col("n_a") == 0, "").when(F.col("body") == "", first).otherwise(F.concat(first, F.lit(";"), "body"))
    whole = cut.mapInArrow(measured(False), FRAGMENT).select("doc_id", *COUNTS, groups.alias("groups"))
    parts = cut.mapInArrow(measured(True), FRAGMENT).groupBy("uid")
    stitched_rows = parts.applyInArrow(stitched, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", groups string")
    return whole.unionByName(stitched_rows).select("doc_id", *COUNTS, of_groups(F.col("groups")).alias("groups"))


FRAGMENT_TYPE = pa.schema([*((c, pa.int64()) for c in ("uid", "place", "doc_id", *COUNTS)), *((c, pa.string()) for c in OPEN)])
