"""A log-bilinear language model, trained by noise-contrastive estimation, and corpus scoring.

Counts of all tokens come from the whole training side and go back to the blocks that hold the
tokens, so no vocabulary is broadcast. The network predicts a token of a vocabulary, or the bin of
a token outside it, from the token or bin before: its score is the product of two vectors plus a
bias. Bins are ranges of the tokens' hashes, about the square root of the number of outside tokens.
The network is fitted to the bigram counts of the whole training side, split by context into
shards whose number follows the count of tokens; every round a task improves the network on its
shard, each counted bigram once, and the rounds' results are averaged. A token outside the
vocabulary has the probability of its bin, times its share of the bin's tokens, with one added to
each count, so probabilities add up to one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.llm.blocks import Block, bucket_count, gather_answers, key_totals, make_blocks, open_blocks, read_answers
from timelegs.llm.store import Workspace
from timelegs.llm.textkeys import SPACES, U64, distinct, words

END = U64(0x5EED0FE11D000001)
VOCABULARY = 2048
FINEST = 16  # bits of the hash that name the finest bins
DIMENSIONS = 24
SHARDS = 16  # at least; more for more tokens than
SHARD_TOKENS = 1 << 25
RANGES = 4  # groups in which a shard's pairs are added up
MERGED = 1 << 21  # pairs that a task adds up before it sends them
ROUNDS = 2
STEPS = 120  # at least; a round takes every pair of a shard
BATCH = 2048
CHUNK = 1 << 21
NOISE = 64
RATE = 0.1
START = 1e-3


class Tokens:
    """The tokens of a block: its words in lower case, and one end after each document."""

    def __init__(self, b: Block, trains: Callable[[int | None], bool]):
        starts, _, hashes = words(b.data, SPACES, lower=True)
        cuts = b.spans(starts)
        docs = len(b.sizes)
        self.cuts = cuts + np.arange(docs + 1)
        at = np.arange(len(hashes)) + np.repeat(np.arange(docs), np.diff(cuts))
        self.hashes = np.full(len(hashes) + docs, END, U64)
        self.hashes[at] = hashes
        train = np.array([trains(x) for x in b.doc_id], bool)
        self.train_docs = train
        self.train = np.repeat(train, np.diff(self.cuts))
        order = np.argsort(self.hashes)
        ranked = self.hashes[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
        self.keys = ranked[new]
        self.counts = np.add.reduceat(self.train[order].astype(np.int64), np.flatnonzero(new))
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1


@dataclass
class Model:
    """The network and the counts that it needs; all but the bins of fixed size."""

    keys: np.ndarray  # sorted hashes of the vocabulary
    counts: np.ndarray  # training counts, after the vocabulary those of the outside tokens of each bin
    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    tokens: int  # N
    types: int  # V
    kinds: np.ndarray | None = None  # outside types of each bin
    _norm: np.ndarray | None = field(default=None, repr=False)

    def __post_init__(self):
        if self.kinds is None:
            self.kinds = np.array([self.types - np.count_nonzero(self.counts[:-1])])

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers; the numbers after them are for the bins of outside tokens."""
        bits = (len(self.bias) - len(self.keys)).bit_length() - 1
        outside = len(self.keys) + ((hashes >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64))
        if not len(self.keys):
            return outside
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, outside)

    def log_norm(self) -> np.ndarray:
        """The log of the sum of exponential scores after every token, in batches of contexts."""
        if self._norm is None:
            parts = []
            for k in range(0, len(self.context), 256):
                score = self.context[k : k + 256] @ self.target.T + self.bias
                top = score.max(axis=1)
                parts.append(top + np.log(np.exp(score - top[:, None]).sum(axis=1)))
            self._norm = np.concatenate(parts)
        return self._norm

    def log_pairs(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Normalised log-probability of each number after the one before."""
        out = self.bias[ids] - self.log_norm()[before]
        for k in range(0, len(ids), 1 << 16):
            here = slice(k, k + (1 << 16))
            out[here] += np.einsum("ij,ij->i", self.context[before[here]], self.target[ids[here]])
        return out

    def log_table(self) -> np.ndarray:
        """Normalised log-probability of every next token after every token."""
        return self.context @ self.target.T + self.bias - self.log_norm()[:, None]

    def log_outside(self, counts: np.ndarray, bins: np.ndarray | int = 0) -> np.ndarray:
        """Log-probability of an outside token among those of its bin; a bin's unseen ones share one part."""
        mass = self.counts[len(self.keys) :]
        return np.log((counts + 1) / (mass[bins] + self.kinds[bins] + 1))


def add_up(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and the sums of their counts."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    new = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.empty(0, np.int64)
    return codes[new], np.add.reduceat(counts[order], new) if len(new) else counts


def bigrams(blocks: DataFrame, model: Model, trains, shards: int) -> DataFrame:
    """shard, part, codes, counts: how often each pair of numbers occurs in training documents.

    A task adds up the pairs of its blocks before it sends them; the rest is added up by shard and
    range of the second number.
    """
    size = len(model.bias)
    shared = blocks.sparkSession.sparkContext.broadcast(model)
    schema = "shard int, part int, codes binary, counts binary"
    kinds = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())])

    def packed(values: np.ndarray) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(np.diff(values, prepend=0).astype("<i8").tobytes())

    def send(codes, counts):
        group = codes // size % shards * RANGES + codes % size % RANGES
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(shards * RANGES + 1))
        used = np.flatnonzero(np.diff(cuts))
        mine = [order[cuts[g] : cuts[g + 1]] for g in used]
        body = [packed(codes[m]) for m in mine], [packed(counts[m]) for m in mine]
        return pa.RecordBatch.from_arrays([pa.array(used // RANGES, pa.int32()), pa.array(used % RANGES, pa.int32()), pa.array(body[0], pa.binary()), pa.array(body[1], pa.binary())], schema=kinds)

    def count(batches):
        held, waiting, merged = [], 0, 0
        for b in open_blocks(batches):
            t = Tokens(b, trains)
            ids = shared.value.ids(t.keys)[t.which]
            before = np.empty_like(ids)
            before[1:] = ids[:-1]
            before[t.cuts[:-1]] = shared.value.ids(np.array([END]))[0]
            held.append(distinct((before * size + ids)[t.train]))
            waiting += len(held[-1][0])
            if waiting >= MERGED + merged:
                held = [add_up(*map(np.concatenate, zip(*held, strict=True)))]
                waiting = merged = len(held[0][0])
                if merged >= MERGED:
                    yield send(*held[0])
                    held, waiting, merged = [], 0, 0
        if waiting:
            yield send(*add_up(*map(np.concatenate, zip(*held, strict=True))))

    def add(table: pa.Table) -> pa.Table:
        codes, counts = (np.concatenate([unpacked(x) for x in table.column(c)]) for c in ("codes", "counts"))
        codes, counts = add_up(codes, counts)
        return pa.table([table.column("shard").slice(0, 1), table.column("part").slice(0, 1), pa.array([packed(codes)], pa.binary()), pa.array([packed(counts)], pa.binary())], schema=kinds)

    return blocks.mapInArrow(count, schema).groupBy("shard", "part").applyInArrow(add, schema)


def unpacked(cell: pa.Scalar) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(cell.as_py()), "<i8"))


def occurrences(codes: np.ndarray, counts: np.ndarray, rng: np.random.Generator, least: int, chunk: int = CHUNK):
    """Every pair as often as it was counted, in random order and chunks of bounded size.

    A pair's count is spread evenly over the chunks. Fewer than ``least`` are repeated in full.
    """
    mass = int(counts.sum())
    if mass <= chunk:
        picked = np.repeat(codes, counts * max(1, -(-least // max(mass, 1))))
        rng.shuffle(picked)
        yield picked
        return
    parts, phase = -(-mass // chunk), rng.random(len(codes))
    given = np.zeros(len(codes), np.int64)
    for j in range(1, parts + 1):
        upto = np.floor(counts * (j / parts) + phase).astype(np.int64)
        picked = np.repeat(codes, upto - given)
        rng.shuffle(picked)
        given = upto
        yield picked


def _descend(value: np.ndarray, past: np.ndarray, at: np.ndarray, slopes: np.ndarray) -> None:
    """A step on the rows ``at``, which may repeat."""
    used = np.bincount(at, minlength=len(value)) > 0
    rows, width = np.flatnonzero(used), value[0].size
    place = (np.cumsum(used) - 1)[at]
    cell = (place[:, None] * width + np.arange(width)).ravel()
    slope = np.bincount(cell, slopes.ravel(), minlength=len(rows) * width).astype(np.float32).reshape(len(rows), *value.shape[1:]) / BATCH
    seen = past.take(rows, axis=0) + slope * slope
    past[rows] = seen
    value[rows] -= RATE * slope / np.sqrt(seen)


def contrast(model: Model, codes: np.ndarray, counts: np.ndarray, seed: int, steps: int) -> tuple[np.ndarray, ...]:
    """Noise-contrastive steps on all bigrams of one shard, ``steps`` at least; the network after them.

    Each batch takes pairs by their counts and draws one set of noise tokens from the unigram counts;
    a pair's true token and the noise tokens are told apart by their scores against the noise.
    """
    rng = np.random.default_rng(seed)
    size = len(model.bias)
    c, q, b = (v.astype(np.float32) for v in (model.context, model.target, model.bias))
    gc, gq, gb = (np.full(v.shape, START, np.float32) for v in (c, q, b))
    share = model.counts + 1.0
    share = share / share.sum()
    odds = np.log(NOISE * share).astype(np.float32)
    noise_draw = np.cumsum(share)
    for chunk in occurrences(codes, counts, rng, steps * BATCH):
        for k in range(0, len(chunk), BATCH):
            pick = chunk[k : k + BATCH]
            x, y = pick // size, pick % size
            z = np.minimum(np.searchsorted(noise_draw, rng.random(NOISE)), size - 1)
            cx, qy, qz = (v.take(i, axis=0) for v, i in ((c, x), (q, y), (q, z)))
            good = 1 / (1 + np.exp(-(np.einsum("ij,ij->i", cx, qy) + b[y] - odds[y]))) - 1
            bad = 1 / (1 + np.exp(-(cx @ qz.T + (b[z] - odds[z]))))
            _descend(c, gc, x, good[:, None] * qy + bad @ qz)
            both = np.concatenate((y, z))
            _descend(q, gq, both, np.concatenate((good[:, None] * cx, bad.T @ cx)))
            _descend(b, gb, both, np.concatenate((good, bad.sum(axis=0))))
    return c, q, b


def fit(pairs: DataFrame, model: Model, shards: int, rounds: int = ROUNDS, steps: int = STEPS) -> Model:
    """Average the shards' networks after each round. What tasks return has the network's size.

    A context's vector moves in its own shard alone and is taken from there; targets and biases are
    averaged by the shards' tokens, first over some of the shards, so that few networks are collected.
    """
    size = len(model.bias)
    schema = "shard int, mass bigint, context binary, rest binary"

    def improving(start, number):
        def improve(table: pa.Table) -> pa.Table:
            shard = table.column("shard")[0].as_py()
            codes, counts = (np.concatenate([unpacked(x) for x in table.column(c)]) for c in ("codes", "counts"))
            c, q, b = contrast(start.value, codes, counts, 1000 * number + shard, steps)
            rest = np.concatenate((q.ravel(), b)).astype("<f4").tobytes()
            return pa.table({"shard": pa.array([shard], pa.int32()), "mass": [int(counts.sum())], "context": pa.array([c[shard::shards].astype("<f4").tobytes()], pa.binary()), "rest": pa.array([rest], pa.binary())})

        return improve

    def mean(table: pa.Table) -> pa.Table:
        mass = table.column("mass").to_numpy().astype(float)
        total = sum(m * np.frombuffer(x.as_buffer(), "<f4") for m, x in zip(mass, table.column("rest"), strict=True))
        rest = [(total / mass.sum()).astype("<f4").tobytes()] + [None] * (len(mass) - 1)
        return table.set_column(3, "rest", pa.array(rest, pa.binary())).set_column(1, "mass", pa.array([int(mass.sum())] + [0] * (len(mass) - 1)))

    for number in range(rounds):
        start = pairs.sparkSession.sparkContext.broadcast(model)
        moved = pairs.groupBy("shard").applyInArrow(improving(start, number), schema)
        rows = moved.groupBy(F.col("shard") % 8).applyInArrow(mean, schema).collect()
        if not rows:
            break
        context = model.context.copy()
        for r in rows:
            context[r["shard"] :: shards] = np.frombuffer(r["context"], "<f4").reshape(-1, context.shape[1])
        rows = [r for r in rows if r["mass"]]
        rows.sort(key=lambda r: r["shard"])
        mass = np.array([r["mass"] for r in rows], float)
        rest = np.tensordot(mass / mass.sum(), np.array([np.frombuffer(r["rest"], "<f4") for r in rows], float), 1)
        model = Model(model.keys, model.counts, context, rest[:-size].reshape(size, -1), rest[-size:], model.tokens, model.types, model.kinds)
    return model


def score_corpus(docs: DataFrame, trains: Callable[[int | None], bool], vocabulary: int = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    ``trains`` tells from a doc_id whether the document is learned from. Tokens are runs of other
    than ASCII white space, lower-cased A-Z, and an end; a null or blank text is its end alone.
    ``base_score`` is the add-one unigram log10 probability, ``score`` the network's. Without
    training documents all counts are zero. Tokens are told apart by 64-bit hashes.
    """
    space = Workspace(docs.sparkSession, "lbl")
    blocks = space.write(make_blocks(docs), "blocks", "none")

    def emit(b: Block):
        t = Tokens(b, trains)
        return t.keys, t.counts

    totals = space.write(
        key_totals(blocks, emit, lambda n: n.astype("<i8"), bucket_count(blocks, 1.0), "u4", vocabulary, FINEST), "totals"
    )
    n, v = totals.agg(F.sum("mass"), F.sum("present")).first()
    n, v = n or 0, v or 0
    best = totals.select(F.explode("largest").alias("t")).select("t.*").filter("total > 0").orderBy(F.desc("total"), "key").limit(vocabulary).collect()
    keys = np.array([r["key"] for r in best], np.int64).view(U64)
    order = np.argsort(keys)
    counts = np.array([r["total"] for r in best], np.int64)[order]
    keys = keys[order]
    binned = totals.select(F.explode("binned").alias("t")).groupBy("t.bin").agg(F.sum("t.mass").alias("mass"), F.sum("t.types").alias("types")).collect()
    mass, kinds = np.zeros((2, 1 << FINEST), np.int64)
    for r in binned:
        mass[r["bin"]], kinds[r["bin"]] = r["mass"], r["types"]
    known = (keys >> U64(64 - FINEST)).astype(np.int64)
    np.subtract.at(mass, known, counts)
    np.subtract.at(kinds, known, 1)
    bits = min(FINEST, int(max(0, kinds.sum() - 1)).bit_length() + 1 >> 1)
    mass, kinds = (x.reshape(1 << bits, -1).sum(axis=1) for x in (mass, kinds))
    counts = np.append(counts, mass)
    size = len(counts)
    rng = np.random.default_rng(7)
    start = np.log((counts + 1.0) / (counts + 1.0).sum())
    model = Model(keys, counts, rng.normal(0, 0.1, (size, DIMENSIONS)), rng.normal(0, 0.1, (size, DIMENSIONS)), start, n, v, kinds)
    shards = max(SHARDS, -(-n // SHARD_TOKENS))
    pairs = space.write(bigrams(blocks, model, trains, shards), "bigrams")
    model = fit(pairs, model, shards)
    model.log_norm()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        end = m.ids(np.array([END]))[0]
        for b in open_blocks(batches):
            t = Tokens(b, trains)
            seen = read_answers(b.row["totals"], "<i8")
            base = np.log10((seen + 1) / (m.tokens + m.types + 1))
            number = m.ids(t.keys)
            outside = np.where(number >= len(m.keys), m.log_outside(seen, np.maximum(number - len(m.keys), 0)), 0.0)
            ids = number[t.which]
            before = np.empty_like(ids)
            before[1:] = ids[:-1]
            before[t.cuts[:-1]] = end
            logs = m.log_pairs(before, ids) + outside[t.which]
            first = t.cuts[:-1]
            docs = len(b.sizes)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(b.doc_id, pa.int64()),
                    "held_out": ~t.train_docs,
                    "n_tokens": np.diff(t.cuts).astype(np.int64),
                    "n_known": np.add.reduceat((seen > 0)[t.which].astype(np.int64), first),
                    "train_tokens": np.full(docs, m.tokens, np.int64),
                    "base_score": np.add.reduceat(base[t.which], first),
                    "score": np.add.reduceat(logs, first) / np.log(10),
                }
            )

    answers = space.write(gather_answers(totals, "totals"), "answers")
    return blocks.join(answers, "block").mapInArrow(
        score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
