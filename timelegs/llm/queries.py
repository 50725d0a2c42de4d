"""The operators over the given tables, under the names that the driver runs."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timelegs.llm import anchor_dedup, chat_snapshots, curriculum, decontaminate, differencing, hard_negatives, jaccard_join, language_id, lbl_model, merge_path, risk_rules, suffix_dedup, weak_quality

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


TOKENIZERS = "/opt/tokenizers"  # public vocabulary files, on every machine
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers find this package where the driver did, unless a path or py-files name it.
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "row.doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["upto"] - s["begin"]).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def remainder(n: int):
    """The fold of a document: crc32 of its doc_id as text; null without a doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"))
    model = language_id.train(docs.filter("NOT held_out"))
    return language_id.predict(docs, model, keep=["doc_id", "held_out"]).select("row.*", "lang_pred", "score")


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken", "position")


ORACLES["op7_curriculum_mix"] = curriculum.MIX_SQL.format(documents="documents")


@query
def op4_lbl_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    # crc32 of doc_id as text, modulo 7, is 2 for the held-out fold
    return lbl_model.score_corpus(table(spark, sf_dir, "documents"), lambda doc_id: zlib.crc32(str(doc_id).encode()) % 7 != 2)


@query
def op8_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op8_risk_rules"] = risk_rules.JUDGE_SQL


@query
def op2_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_snapshots.format_chats(table(spark, sf_dir, "conversations"))


ORACLES["op2_chat_snapshots"] = chat_snapshots.FORMAT_SQL


@query
def op3_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return weak_quality.classify(docs, weak_quality.train(docs))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label_column=label)


ORACLES["op11_hard_negatives"] = hard_negatives.MINE_SQL.format(embeddings="embeddings")


@query
def op12_merge_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [f"{TOKENIZERS}/{name}" for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    digest = lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256))
    return merge_path.align(table(spark, sf_dir, "documents"), *files, of_groups=digest).withColumnRenamed("groups", "groups_sha256")


@query
def op13_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = differencing.divide(table(spark, sf_dir, "documents"), keep=["doc_id"])
    law = [F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")]
    return found.select("row.doc_id", "size", "text_crc32", "shard", "slot", *law)
