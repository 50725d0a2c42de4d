"""Chat formatting of logged conversations, after snapshots of longer ones are dropped.

A service that logs a conversation after every reply logs its beginnings too. The rolling hash of
a conversation's first k turns is an exclusive-or of hashes of (k, role, text), so a running
window gives the hashes of all its beginnings. A conversation whose whole hash is a proper
beginning of another one is a snapshot and is removed by an anti-join; of equal conversations the
one of least conv_id stays. Both sides of the anti-join are distinct hashes, so beginnings that
very many conversations share are one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def rolling_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, k, low, high, last: two hashes of the first k turns, and whether they are all."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text_low", "text_high")
    told = turns.select(
        "conv_id", "turn", "role", F.xxhash64("text").alias("text_low"), F.xxhash64(F.lit(1), "text").alias("text_high")
    ).withColumn("k", F.row_number().over(order))
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return told.select(
        "conv_id",
        "k",
        F.bit_xor(F.xxhash64("k", "role", "text_low")).over(first).alias("low"),
        F.bit_xor(F.xxhash64("k", "role", "text_high")).over(first).alias("high"),
        F.lead("k").over(order).isNull().alias("last"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id of the conversations that begin no longer one, once for equal conversations."""
    hashes = rolling_hashes(turns)
    whole = hashes.filter("last").groupBy("k", "low", "high").agg(F.min("conv_id").alias("conv_id"))
    beginnings = hashes.filter("NOT last").select("k", "low", "high").distinct()
    return whole.join(beginnings, ["k", "low", "high"], "left_anti").select("conv_id")


def rendered(turn: Column) -> Column:
    role = F.coalesce(turn["role"], F.lit("unknown"))
    return F.concat(F.lit(OPEN), role, F.lit("\n"), F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE + "\n"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, chat of every maximal conversation of ``conversations`` (conv_id, turn, role, text).

    Turns are ordered by turn, then role and a hash of the text; a row that repeats another counts
    once. A null role is written ``unknown`` and a null text as empty, but they differ from those
    for the comparison. Rows without conv_id belong to no conversation. A conversation is a row of
    the result and has to fit into one. Other columns are not read.
    """
    turns = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    turns = turns.filter("conv_id IS NOT NULL").distinct()
    order = F.struct("turn", "role", F.xxhash64("text").alias("low"), F.xxhash64(F.lit(1), "text").alias("high"), "text")
    whole = turns.join(maximal(turns), "conv_id", "left_semi").groupBy("conv_id").agg(F.array_sort(F.collect_list(order)).alias("turns"))
    return whole.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.array_join(F.transform("turns", rendered), "").alias("chat"))


#: The same in SQL, for conversations whose turns have numbers of their own.
FORMAT_SQL = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
rolled AS (
  SELECT conv_id, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
    md5(string_agg(coalesce(role, chr(1)) || chr(2) || coalesce(text, chr(1)), chr(3)) OVER w) AS h
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
whole AS (SELECT k, h, min(conv_id) AS conv_id FROM rolled WHERE k = n GROUP BY k, h),
longest AS (SELECT conv_id FROM whole WHERE (k, h) NOT IN (SELECT (k, h) FROM rolled WHERE k < n))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn) AS chat
FROM turns JOIN longest USING (conv_id) GROUP BY conv_id
"""
