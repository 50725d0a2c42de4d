"""Shards of near-equal bytes by Karmarkar-Karp differencing over indivisible groups of equal texts.

Differencing keeps a set of partial partitions, each a tuple of loads, one per shard. It takes the
two whose loads differ most, puts the largest loads of the one on the smallest of the other, and
repeats until one is left. The differences cancel, so that the loads end up closer than those of
any rule that places one group after the other.

What is combined stays bounded however many groups there are. A group of at least an 8,192nd of all
bytes is an item of its own, and there are at most 8,192 of these. All others are dealt by a hash
of the text into 65,536 bundles, each an item of less than an 8,192nd plus its expected share. So
one task combines at most 73,728 items, whose loads Spark has summed, and the answer is a table of
as many rows, which is small enough for a broadcast. Up to about that many groups, most bundles
are single groups; beyond, bundles are finer than the balance that they are combined to.

A group is named by a 64-bit hash of its text: equal texts never part, and two texts of one hash
merely stay together. A group larger than an even share fills a shard of its own; the others then
share the rest evenly.

Rows: null and empty texts have size 1 and form one group; repeated rows are a group like others;
ties are ordered by number, so that a rerun gives the same shards. Slots number the rows of a shard
in the order of the written rows. Empty tables give no rows. Other columns stay within ``row``.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timelegs.llm.store import Workspace, whole_row

HEAVY = 8_192  # a group of at least this part of all bytes is an item of its own
BUNDLES = 65_536
ROWS_A_FILE = 1_000_000


def differencing(loads: list[int], shards: int) -> list[int]:
    """The shard of each load. Loads are spread over ``shards`` by Karmarkar-Karp differencing.

    A node is a pair of nodes that were combined: position ``s`` of the new node holds position
    ``left[s]`` of the one and ``right[s]`` of the other.
    """
    if not loads:
        return []
    heap = [(-load, k, (load,) + (0,) * (shards - 1)) for k, load in enumerate(loads)]
    heapq.heapify(heap)
    made: list[tuple] = []
    upward = range(shards)
    while len(heap) > 1:
        _, a, high = heapq.heappop(heap)
        _, b, low = heapq.heappop(heap)
        # loads fall along ``high`` and, taken backwards, rise along ``low``
        sums = [x + y for x, y in zip(high, reversed(low), strict=True)]
        order = sorted(upward, key=lambda s: -sums[s])
        least = sums[order[-1]]
        joined = tuple(sums[s] - least for s in order)
        made.append((a, b, order))
        heapq.heappush(heap, (-joined[0], len(loads) + len(made) - 1, joined))
    places = {len(loads) + len(made) - 1: list(upward)}
    out = [0] * len(loads)
    for node in range(len(loads) + len(made) - 1, -1, -1):
        place = places.pop(node)
        if node < len(loads):
            out[node] = place[0]
            continue
        a, b, order = made[node - len(loads)]
        left, right = [0] * shards, [0] * shards
        for s, at in enumerate(order):
            left[at], right[shards - 1 - at] = place[s], place[s]
        places[a], places[b] = left, right
    return out


def _divide(shards: int):
    def run(table: pa.Table) -> pa.Table:
        heavy, items, loads = (table.column(c).to_pylist() for c in ("heavy", "item", "load"))
        order = sorted(range(len(items)), key=lambda k: (heavy[k], items[k]))
        found = differencing([loads[k] for k in order], shards)
        return pa.table(
            {
                "heavy": pa.array([heavy[k] for k in order], pa.bool_()),
                "item": pa.array([items[k] for k in order], pa.int64()),
                "shard": pa.array(found, pa.int32()),
            }
        )

    return run


def divide(docs: DataFrame, shards: int = 8, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with its shard, such that shards have nearly equal bytes.

    Columns: row (the columns of ``docs`` or those named), size (bytes of the text plus 1),
    text_crc32, shard, and slot, a number from 0 without gaps in each shard.
    """
    space = Workspace(docs.sparkSession, "shards")
    body = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).cast("binary")
    sized = docs.select(
        whole_row(docs, keep),
        (F.octet_length(body).cast("bigint") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("group"),
    )
    rows = space.write(sized, "rows", "lz4")
    groups = space.write(rows.groupBy("group").agg(F.sum("size").alias("load")), "groups", "lz4")
    total = groups.agg(F.sum(F.col("load").cast("decimal(38,0)"))).first()[0] or 0
    loads = groups.select("group", "load", (F.col("load") >= -(-int(total) // HEAVY)).alias("heavy"))
    own = loads.filter("heavy").select(F.lit(True).alias("heavy"), F.col("group").alias("item"), "load")
    bundle = F.pmod(F.xxhash64(F.col("group"), F.lit(1)), F.lit(BUNDLES))
    rest = loads.filter("NOT heavy").groupBy(bundle.alias("item")).agg(F.sum("load").alias("load"))
    items = own.unionByName(rest.select(F.lit(False).alias("heavy"), "item", "load"))
    # one small group by design: at most HEAVY + BUNDLES rows, each a sum
    answer = space.write(items.groupBy().applyInArrow(_divide(shards), "heavy boolean, item bigint, shard int"), "answer")
    alone = answer.filter("heavy").select(F.col("item").alias("group"), F.col("shard").alias("own_shard"))
    bundled = answer.filter("NOT heavy").select(F.col("item").alias("bundle"), F.col("shard").alias("bundle_shard"))
    placed = rows.withColumn("bundle", bundle).join(F.broadcast(alone), "group", "left").join(F.broadcast(bundled), "bundle", "left")
    shard = F.coalesce("own_shard", "bundle_shard").alias("shard")
    return _with_slots(space, placed.select("row", "size", "text_crc32", shard))


def _with_slots(space: Workspace, placed: DataFrame) -> DataFrame:
    """Number the rows of each shard over the files they were written to.

    A file's rows of a shard are numbered within the file; those in earlier files are counted
    first. A window covers one shard in one part of a file, and no shard is in one task.
    """
    where = F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")
    written = space.write(placed, "placed", "lz4").select("*", *where)
    part = (F.col("place") / ROWS_A_FILE).cast("bigint")
    # a file's name begins with the number of the task and ends with the number of its file
    number = F.regexp_replace("file", r"^.*/part-(\d+)-.*?(-c\d+)?\.[^/]*$", "$1$2")
    parted = written.select("row", "size", "text_crc32", "shard", "place", number.alias("number"), part.alias("part"))
    counts = parted.groupBy("shard", "number", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("number", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "number", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "number", "part").orderBy("place")
    ranked = parted.withColumn("rank", F.row_number().over(within) - 1)
    slot = (F.col("start") + F.col("rank")).alias("slot")
    return ranked.join(starts, ["shard", "number", "part"]).select("row", "size", "text_crc32", "shard", slot)


def write_shards(docs: DataFrame, path: str, shards: int = 8, text_column: str = "text") -> None:
    """Write each shard to a folder of its own; ``slot`` stays as a column that gives the order."""
    mine = ["size", "text_crc32", "shard", "slot"]
    out = divide(docs, shards, text_column, [c for c in docs.columns if c not in mine])
    out.select("row.*", *mine).write.partitionBy("shard").parquet(path)
