"""Mixing sources to target weights along a time-varying curriculum.

A source's weight changes during training along a straight line; its integral is the source's
target, so the words that the source has to give up to time t are known in closed form. Within a
source documents queue in the order of a hash. A document's place in the queue, in words, is put
into the inverse of that integral, which gives its training position; the result is range-sorted
by position.

Queue places come from two levels of running sums, so that no source meets in one task: sums per
source and hash bucket, a running sum over these few rows, then one within each bucket. The number
of buckets follows the number of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timelegs.llm.store import whole_row

# Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
# Slopes of the weight schedules, repeating: a weight runs from (1 - slope) to (1 + slope) of its mean.
SLOPES = (-0.5, 0.0, 0.5)
ROWS_PER_BUCKET = 20_000
HEX = 4


def word_count(text: Column) -> Column:
    """Number of runs of other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, weight, slope, target of each source; sizes has source, source_size.

    Sources share ``share`` of all words by weight. A target stops at ``most`` times the source;
    the excess goes to the others by weight until none is above. The sources that stop are those
    of least size per weight, so running sums in that order give the common level of the others.
    One row per source, whose number is taken to be small.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    k = (F.row_number().over(by_name) - 1).cast("int")
    ranked = sizes.select(
        "source",
        F.col("source_size").cast("bigint").alias("source_size"),
        F.element_at(F.array(*map(F.lit, WEIGHTS)), k % len(WEIGHTS) + 1).cast("double").alias("weight"),
        F.element_at(F.array(*map(F.lit, SLOPES)), k % len(SLOPES) + 1).cast("double").alias("slope"),
    ).withColumn("cap", F.lit(most).cast("double") * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (F.lit(share) * total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level)
    free = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    common = F.max(free).over(Window.partitionBy())  # the first level that no later source stops
    return levels.withColumn("common", common).select(
        "source", "source_size", "weight", "slope",
        F.coalesce(F.least("cap", F.col("common") * F.col("weight")), F.col("cap")).alias("target"),
    )


def position(words: Column, target: Column, slope: Column) -> Column:
    """The time at which a source has given so many words: slope t^2 + (1 - slope) t = words / target."""
    x = F.least(F.lit(1.0), words / target)
    linear = 1 - slope
    # The stable form of the root, good for every slope, zero included.
    return 2 * x / (linear + F.sqrt(linear * linear + 4 * slope * x))


def mix(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """row (the input row, or its columns ``keep``), size, source_size, target, taken, position.

    Documents (doc_id, source, text) of a source queue by md5 of doc_id, then doc_id and a hash of
    the text; repeated rows may swap places, with no effect on the result. The queue is gone
    through as often as the target needs; the last document is cut. ``taken`` counts words of all
    passes, at most twice the size; ``position``, from 0 to 1, is where the first pass puts the
    document, null if nothing is taken. A null source is a source, a null text has no words, a null
    doc_id queues first. The result is sorted by position.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        whole_row(docs, keep),
        docs["source"].cast("string").alias("source"),
        docs["doc_id"],
        word_count(docs["text"]).alias("size"),
        key.alias("key"),
        F.xxhash64(docs["text"]).alias("tie"),
    )
    rows = docs.count()
    buckets = 1 << max(4, (max(1, rows // ROWS_PER_BUCKET) - 1).bit_length())
    bucket = F.shiftright(F.conv(F.substring("key", 1, 2 * HEX), 16, 10).cast("bigint"), 8 * HEX - (buckets.bit_length() - 1))
    sized = sized.withColumn("bucket", bucket.cast("int"))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    starts = starts.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "start", "source_size", "target", "slope"
    )
    placed = sized.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    within = (
        Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    goal = F.floor("target").cast("bigint")

    def passed(start: Column) -> Column:
        return F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), goal - start))

    out = placed.withColumn("before", before).select(
        "row", "size", "source_size", "target",
        (passed(F.col("before")) + passed(F.col("before") + F.col("source_size"))).alias("taken"),
        F.when((F.col("size") > 0) & (F.col("before") < goal), position(F.col("before"), F.col("target"), F.col("slope"))).alias("position"),
    )
    return out.orderBy(F.asc_nulls_last("position"), "row.doc_id")


#: The same in SQL over the table documents.
MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM {documents}),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
    [-0.5, 0.0, 0.5][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS slope,
    2.0::DOUBLE * source_size AS cap FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM sources)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
targets AS (
  SELECT source, source_size, slope,
    coalesce(least(cap, (SELECT max(level) FROM levels WHERE level * weight <= cap) * weight), cap) AS target FROM levels),
queue AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.slope, floor(t.target)::BIGINT AS goal,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, '')), s.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
placed AS (
  SELECT *, (greatest(0, least(size, goal - before)) + greatest(0, least(size, goal - before - source_size)))::BIGINT AS taken,
    CASE WHEN size > 0 AND before < goal THEN least(1.0::DOUBLE, before / target) END AS x FROM queue)
SELECT doc_id, size, source_size, target, taken, 2 * x / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * x)) AS position FROM placed
"""
