"""From raw documents to a training mix: five stages, each written as Parquet and read again.

Language identification drops texts without a language, the similarity join keeps one document of
each near-duplicate group, the suffix arrays cut repeated strings, decontamination drops documents
that quote the benchmark, and mixing gives each document its words and its place in training.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timelegs.llm import curriculum, decontaminate, jaccard_join, language_id, suffix_dedup
from timelegs.llm.queries import remainder, table
from timelegs.llm.store import Workspace

LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those that are undetermined or below ``LEAST_SCORE`` go.

    The model learns from the stage's own documents outside the held-out fold. If none of them
    has a language, nothing can be told and only texts without a letter go.
    """
    model = language_id.train(docs.filter(remainder(5) != 0))
    if not model.languages:
        return docs.filter(F.col("text").rlike("\\p{L}"))
    found = language_id.predict(docs, model)
    return found.filter((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of near duplicates.

    Rows that repeat a doc_id and its text count once. Rows without doc_id belong to no group.
    """
    groups = jaccard_join.near_duplicates(docs)
    stays = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("stays_id")).distinct()
    named = docs.filter("doc_id IS NOT NULL")
    kept = named.join(stays, named["doc_id"] == stays["stays_id"], "left_semi")
    again = Window.partitionBy(F.struct("doc_id", F.xxhash64("text"))).orderBy("source", "lang")
    once = kept.select(F.struct(*kept.columns).alias("row"), F.row_number().over(again).alias("copy"))
    return once.filter("copy = 1").select("row.*").unionByName(docs.filter("doc_id IS NULL"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated strings; n_chars follows the text.

    A character of which only a part is left goes; so does a document of which only white space is
    left. Documents that lose nothing stay as they are.
    """
    found = suffix_dedup.remove_repeats(docs).filter("kept_text IS NULL OR kept_text RLIKE '\\\\S'")
    row, text = F.col("row"), F.coalesce("kept_text", "row.text")
    chars = F.coalesce(F.length("kept_text").cast("bigint"), "row.n_chars")
    return found.select(row.withField("text", text).withField("n_chars", chars).alias("row")).select("row.*")


def off_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word window with the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its share of the mix and its training position, in training order.

    A column of the documents gives way to one of the mix that has its name.
    """
    mine = ["size", "source_size", "target", "taken", "position"]
    out = curriculum.mix(docs, keep=[c for c in docs.columns if c not in mine])
    return out.select("row.*", *mine)


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each_group),
    ("suffix_dedup", without_repeats),
    ("decontamination", off_benchmark),
    ("mix", mixed),
]

# Naive Bayes cannot be stated in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table documents."""
    space = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = space.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
