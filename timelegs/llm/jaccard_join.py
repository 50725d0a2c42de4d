"""Similarity join of documents on word shingles, as a blocked sparse product.

Rows of the incidence matrix are documents, columns are shingles. Three bounds that follow from
the sizes keep the product sparse, and none loses a pair at or above the threshold:

* Of a document with n shingles only the n - ceil(t n) + 1 first columns, in one order that all
  documents share, can start a product: a partner shares at least ceil(t n) shingles. The order
  is by document frequency, and a column of one document multiplies nothing, so most documents
  have no column left.
* Sizes of partners differ by a factor t at most.
* A pair stays if its accumulated overlap reaches t times the union.

Documents with equal sets are one row of the matrix. The product is first taken of each column's
leader (of a group of edited copies, the one nearest to all) with the column's other documents.
Columns whose documents are then all in one component are done, since more links would not change
it. Of the other columns, the documents outside the most frequent component are multiplied with
all, in pairs of tiles of bounded size, each in a task of its own; tiles return links, never all
pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.llm.blocks import SHIFT, Block, bucket_count, gather_answers, key_totals, make_blocks, open_blocks, read_answers
from timelegs.llm.components import connected_components
from timelegs.llm.store import Workspace
from timelegs.llm.textkeys import SPACES, U64, grams, mix, words

TILE = 64
SENT_BYTES = 5  # of a shingle's place in its bucket
COLUMNS_A_STEP = 8192


def document_sets(b: Block, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a block."""
    starts, _, hashes = words(b.data, SPACES, lower=True)
    shingles = grams(hashes, width)
    cuts = b.spans(starts)
    out = []
    for k in range(len(b.sizes)):
        first, last = cuts[k], cuts[k + 1]
        if last - first >= width:
            s = np.sort(shingles[first : last - width + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif last > first:  # a short text is one shingle; its length keeps it apart from the others
            out.append(mix(grams(hashes[first:last], last - first) + U64(last - first)))
        else:
            out.append(shingles[:0])
    return out


def shared_sets(docs: DataFrame, space: Workspace, width: int, percent: int) -> DataFrame:
    """uid, doc_id, n, alone, sig, postings, shingles of each document; see the module for postings.

    ``alone`` counts the shingles that no other document has; they come first in the order.
    ``shingles`` is null for documents without postings, which link with no other set.
    """
    blocks = space.write(make_blocks(docs), "blocks", "none")

    def emit(b: Block):
        sets = document_sets(b, width)
        keys = np.sort(np.concatenate(sets)) if sets else np.empty(0, U64)
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        return keys[first], np.diff(np.append(first, len(keys)))

    def frequency_class(totals: np.ndarray) -> np.ndarray:
        return np.ceil(np.log2(np.maximum(totals, 1))).astype(np.uint8)  # 0: in one document

    # a false meeting of two shingles makes their class larger: one that is alone is only taken for shared
    totals = key_totals(blocks, emit, frequency_class, bucket_count(blocks, 1.0), key_bytes=SENT_BYTES)
    answers = space.write(gather_answers(totals, "classes"), "classes")

    def rows(batches: Iterator[pa.RecordBatch]):
        for b in open_blocks(batches):
            sets = document_sets(b, width)
            keys = np.sort(np.concatenate(sets))
            if len(keys):
                keys = keys[np.append(True, keys[1:] != keys[:-1])]
            classes = read_answers(b.row["classes"], "u1")
            sig, postings, kept, single = [], [], [], []
            for s in sets:
                sig.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                c = classes[np.searchsorted(keys, s)]
                prefix = len(s) - -(-percent * len(s) // 100) + 1
                alone = np.count_nonzero(c == 0)
                single.append(alone)
                if len(s) and alone < prefix:
                    shared = np.flatnonzero(c)
                    order = shared[np.argsort(c[shared], kind="stable")]
                    postings.append(s[order[: prefix - alone]].view(np.int64))
                else:
                    postings.append(None)
                kept.append(s.tobytes() if postings[-1] is not None and len(postings[-1]) else None)
            yield pa.RecordBatch.from_pydict(
                {
                    "uid": (np.int64(b.block) << SHIFT) + np.arange(len(sets)),
                    "doc_id": pa.array(b.doc_id, pa.int64()),
                    "n": np.array([len(s) for s in sets], np.int64),
                    "alone": np.array(single, np.int64),
                    "sig": pa.array(sig, pa.binary()),
                    "postings": pa.array(postings, pa.list_(pa.int64())),
                    "shingles": pa.array(kept, pa.binary()),
                }
            )

    out = blocks.join(answers, "block", "left").mapInArrow(
        rows, "uid bigint, doc_id bigint, n bigint, alone bigint, sig binary, postings array<bigint>, shingles binary"
    )
    out = space.write(out, "sets")
    space.drop("blocks")
    space.drop("classes")
    return out


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def live_columns(sets: DataFrame, percent: int) -> DataFrame:
    """h, node, n, alone: the columns of the matrix, without entries that can start no pair.

    If a column is the first that two sets of sizes n and m share, and it is at place p of the
    first set (from 0), they share n - p at most, which must reach the overlap that the threshold
    asks for, t / (1 + t) (n + m). An entry that fails this for the smallest m of its column goes.
    """
    entries = sets.select("node", "n", "alone", F.posexplode("postings").alias("p", "h"))
    smallest = entries.groupBy("h").agg(F.min("n").alias("m"), F.count("*").alias("k")).filter("k > 1")
    enough = (F.col("n") - F.col("alone") - F.col("p")) * (100 + percent) >= (F.col("n") + F.col("m")) * percent
    return entries.join(smallest, "h").filter(enough).select("h", "node", "n", "alone")


def may_link(a: str, b: str, percent: int):
    """Whether sizes and shared shingles of two sets allow the threshold."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    shared = F.least(n - F.col(f"{a}.alone"), m - F.col(f"{b}.alone"))
    return (shared * (100 + percent) >= (n + m) * percent) & (F.least(n, m) * 100 >= F.greatest(n, m) * percent)


def leader_links(columns: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between a leader of each column and the column's other sets.

    The leader is the set with the least share of shingles of its own: of a group of edited
    copies, the one that the others are nearest to.
    """
    rank = F.struct((F.col("alone") / F.col("n")).alias("share"), "n", "alone", "node")
    leaders = columns.groupBy("h").agg(F.min(rank).alias("lead"))
    pairs = (
        columns.withColumn("own", F.struct("n", "alone"))
        .join(leaders, "h")
        .filter(F.col("node") != F.col("lead.node"))
        .filter(may_link("lead", "own", percent))
        .select(F.col("lead.node").alias("a"), F.col("node").alias("b"))
        .distinct()
    )

    def verify(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = [_similar(np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64), percent) for x, y in zip(a, b, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(verify, "a bigint, b bigint")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``left`` shares with each of ``right``: a sparse matrix product.

    The shingles that both sides hold are the columns, taken some thousands at a time; each step
    adds the product of two blocks of the incidence matrix to the counts.
    """
    counts = np.zeros((len(left), len(right)), np.float32)
    held = [np.concatenate(side) for side in (left, right)]
    row_of = [np.repeat(np.arange(len(side)), [len(x) for x in side]) for side in (left, right)]
    columns = np.intersect1d(*held)
    for at in range(0, len(columns), COLUMNS_A_STEP):
        step = columns[at : at + COLUMNS_A_STEP]
        blocks = []
        for values, rows, size in zip(held, row_of, counts.shape, strict=True):
            place = np.minimum(np.searchsorted(step, values), len(step) - 1)
            here = step[place] == values
            block = np.zeros((size, len(step)), np.float32)
            block[rows[here], place[here]] = 1
            blocks.append(block)
        counts += blocks[0] @ blocks[1].T
    return counts.astype(np.int64)


def multiply_tiles(percent: int):
    """The links between the two tiles of a task; of a component that they make, only enough to join it."""

    def run(table: pa.Table) -> pa.Table:
        node, component, n = (table.column(c).to_numpy() for c in ("node", "component", "n"))
        other = np.array(table.column("other").to_pylist())
        found = [np.frombuffer(x.as_buffer(), U64) for x in table.column("shingles")]
        x, y = np.flatnonzero(other), np.flatnonzero(~other)
        a, b, of = [], [], {}

        def root(c):
            while of.get(c, c) != c:
                c = of[c]
            return c

        if len(x) and len(y):
            smaller, larger = np.minimum(n[x][:, None], n[y]), np.maximum(n[x][:, None], n[y])
            possible = (100 * smaller >= percent * larger) & (component[x][:, None] != component[y])
            x, y = x[possible.any(1)], y[possible.any(0)]
        if len(x) and len(y):
            both = overlaps([found[k] for k in x], [found[k] for k in y])
            linked = 100 * both >= percent * (n[x][:, None] + n[y] - both)
            for i, j in zip(*np.nonzero(linked & (component[x][:, None] != component[y])), strict=True):
                rx, ry = root(int(component[x[i]])), root(int(component[y[j]]))
                if rx != ry:
                    of[rx] = ry
                    a.append(int(node[x[i]]))
                    b.append(int(node[y[j]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def tile_links(columns: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components within columns, tile by tile.

    Columns with the same documents are taken once. In a column, the documents outside its most
    frequent component are multiplied with all of its documents: tiles of the former with tiles of
    all, two tiles a task. Tiles are cut within classes of sizes, and only tiles of the same or of
    neighbouring classes meet, since sizes further apart can't reach the threshold.
    """
    labelled = columns.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = labelled.groupBy("h", "component").agg(
        F.count("*").alias("c"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x"),
    )
    opened = (
        sizes.groupBy("h")
        .agg(F.count("*").alias("d"), F.sum("c").alias("k"), F.sum("s").alias("s"), F.bit_xor("x").alias("x"), F.max(F.struct("c", "component")).alias("most"))
        .filter("d > 1")
        .groupBy("k", "s", "x")
        .agg(F.min(F.struct("h", "most")).alias("one"))
        .select(F.col("one.h").alias("h"), F.col("one.most.component").alias("most"))
    )
    # a hair wider than the threshold asks for, so that rounding never parts two sizes that fit
    step = math.log(100 / percent) * 1.000001
    size_class = F.floor(F.log(F.col("n").cast("double")) / step).cast("int")
    placed = labelled.join(opened, "h").select("h", "node", "component", "most", F.xxhash64("node").alias("at"), size_class.alias("own"))
    counted = placed.groupBy("h", "own").agg(F.count("*").alias("k"), F.count_if(F.col("component") != F.col("most")).alias("o"))
    tiles = F.ceil(F.col("k") / TILE).cast("int").alias("tiles")
    others = F.ceil(F.col("o") / TILE).cast("int").alias("others")
    near = F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1))
    asking = counted.filter("o > 0").select("h", F.col("own").alias("s"), others, near.alias("c"))
    meeting = asking.join(counted.select("h", F.col("own").alias("c"), tiles), ["h", "c"])
    every = placed.join(meeting.withColumnRenamed("c", "own"), ["h", "own"]).select(
        "h", "s", F.col("own").alias("c"), "node", "component", F.lit(False).alias("other"),
        F.pmod("at", "tiles").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("j"),
    )
    other = placed.filter("component <> most").join(meeting.withColumnRenamed("s", "own"), ["h", "own"]).select(
        "h", F.col("own").alias("s"), "c", "node", "component", F.lit(True).alias("other"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("i"), F.pmod("at", "others").cast("int").alias("j"),
    )
    together = every.unionByName(other).join(sets.select("node", "n", "shingles"), "node")
    return together.groupBy("h", "s", "c", "i", "j").applyInArrow(multiply_tiles(percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its set size and its component.

    Returned: doc_id, n_shingles, component_id, the smallest doc_id that links reach. Words are
    runs of other than ASCII white space, lower-cased A-Z. A text of fewer than ``width`` words is
    one shingle; a null or blank text has none and links with nothing. Repeated rows are documents
    like others, and a null doc_id counts for no component. Other columns are not read.
    """
    space = Workspace(docs.sparkSession, "jaccard")
    every = shared_sets(docs, space, width, percent)
    classes = space.write(
        every.filter("n > 0").groupBy("sig").agg(F.min("uid").alias("node"), F.min("doc_id").alias("least_id")), "rows"
    )
    sets = space.write(
        every.filter("shingles IS NOT NULL")
        .join(classes.select(F.col("node").alias("uid")), "uid", "left_semi")
        .select(F.col("uid").alias("node"), "n", "alone", "postings", "shingles"),
        "matrix",
    )
    columns = space.write(live_columns(sets, percent), "columns")
    links = space.write_in_small_batches(leader_links(columns, sets, percent), "leader_links")
    labels = space.write(connected_components(links, space, "first"), "labels")
    more = space.write(tile_links(columns, labels, sets, percent), "tile_links")
    labels = space.write(connected_components(links.unionByName(more), space, "second"), "all_labels")
    named = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_sig = space.write(named.join(least, "component").select("sig", "component_id"), "components")
    for name in ("matrix", "columns", "leader_links", "labels", "tile_links", "all_labels", "rows"):
        space.drop(name)  # the result reads the sets and their components
    return every.join(by_sig, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
