"""Quality rules whose cutoffs come with a bound on the share of good documents they reject.

A rule rejects a document whose measure is above a cutoff. In each stratum (the language) the
labelled good documents are a holdout: the number of them above a cutoff is binomial, and the
exact tail probability of so few, were the true rate at the limit, is the p-value of that cutoff.
The limit of one rule is the total limit divided by the number of rules, so the rules together
stay below the total. Cutoffs are tried from the mildest on until the first that fails, which
needs no correction; the error of all strata and rules together is divided evenly among them.
A rule without a passing cutoff rejects nothing in that stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timelegs.llm.store import Workspace

LIMIT = 0.05  # most good documents that the rules may reject, per stratum
ERROR = 0.05  # probability that any of the statements is wrong
RULES = {
    "symbols": [k / 100 for k in range(1, 41)],
    "capitals": [k / 40 for k in range(1, 41)],
    "marks": [k / 100 for k in range(1, 41)],
    "repeated_words": [k / 80 for k in range(1, 41)],
    "repeated_lines": [k / 80 for k in range(1, 41)],
    "long_words": [4 + k / 2 for k in range(1, 41)],
}
SPACE = "[\\x20\\x09-\\x0D]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more."""
    grams = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )

    def places(s: Column) -> Column:
        twins = F.filter(s, lambda x, k: F.equal_null(x["h"], F.get(s, k - 1)["h"]) | F.equal_null(x["h"], F.get(s, k + 1)["h"]))
        return F.array_sort(F.transform(twins, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def count(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        some = _let(ranked, lambda s: _let(places(s), covered))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(some)

    return F.when(F.size(words) >= 3, _let(grams, count)).otherwise(F.lit(0)).cast("bigint")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, stratum, the base counts of each text and its ``n_lines``, ``n_capitals``, ``n_marks`` and hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counted = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x)).cast("bigint").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    lined = _let(
        lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))
    )
    return docs.select(
        "doc_id",
        F.col("lang").alias("stratum"),
        counted.alias("w"),
        lined.alias("l"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("bigint").alias("n_capitals"),
        F.regexp_count(text, F.lit("[!?]")).cast("bigint").alias("n_marks"),
        F.xxhash64(text).alias("text_hash"),
    ).select("doc_id", "stratum", "w.*", "l.*", "n_symbols", "n_capitals", "n_marks", "text_hash")


def rule_values() -> dict[str, Column]:
    """The measure of each rule; nothing is above a cutoff in a text without words."""

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))

    return {
        "symbols": ratio("n_symbols", "word_chars"),
        "capitals": ratio("n_capitals", "word_chars"),
        "marks": ratio("n_marks", "word_chars"),
        "repeated_words": ratio("n_repeat_words", "n_words"),
        "repeated_lines": ratio("n_dup_lines", "n_lines"),
        "long_words": ratio("word_chars", "n_words"),
    }


def _log_gamma(x: Column) -> Column:
    """Stirling's series eight above, brought down again; exact to about 1e-14 for x >= 1."""
    z = x + 8
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    below = F.lit(0.0)
    for k in range(8):
        below = below + F.log(x + k)
    return series - below


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) of a binomial below its mean, 1 from there on.

    Terms are added from k downwards, where they fall faster than a geometric series; those left
    out are below the precision of a double.
    """
    k, n = k.cast("double"), n.cast("double")
    first = F.exp(
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate)
    )
    steps = F.least(k, 60 + 12 * F.sqrt(n * rate)).cast("int")
    start = F.struct(first.alias("term"), first.alias("sum"))

    def add(a: Column, j: Column) -> Column:
        i = k - j + 1
        term = a["term"] * i * (1 - rate) / ((n - i + 1) * rate)
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    tail = F.when(steps < 1, first).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), start, add)["sum"])
    return F.when(k < n * rate, tail).otherwise(F.lit(1.0))


def cutoffs(found: DataFrame, labels: DataFrame, limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """stratum, rule, cutoff, false_rejections, holdout of each rule that has a passing cutoff.

    ``labels`` has doc_id, quality; a document is good if all its labels say 1. Copies of a text are
    no independent draws, so a text counts once in a stratum, if any of its documents is good.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    values = F.array(*(F.struct(F.lit(name).alias("rule"), value.alias("value"), F.array(*map(F.lit, RULES[name])).alias("grid")) for name, value in rule_values().items()))
    drawn = found.join(good, "doc_id").dropDuplicates(["stratum", "text_hash"])
    held = drawn.select("stratum", F.explode(values).alias("v")).select("stratum", "v.*")
    above = F.size(F.filter("grid", lambda c: c < F.col("value")))  # cutoffs that reject the document
    bins = held.groupBy("stratum", "rule", "grid", above.alias("above")).agg(F.count("*").alias("n"))
    rated = bins.groupBy("stratum", "rule", "grid").agg(F.sum("n").alias("holdout"), F.collect_list(F.struct("above", "n")).alias("bins"))
    statements = rated.withColumn("statements", F.count("*").over(Window.partitionBy()))
    each = statements.select("stratum", "rule", "holdout", "bins", "statements", F.posexplode("grid").alias("place", "cutoff"))
    rejected = F.aggregate("bins", F.lit(0).cast("bigint"), lambda a, x: a + F.when(x["above"] > F.col("place"), x["n"]).otherwise(F.lit(0)))
    tested = each.withColumn("false_rejections", rejected).withColumn(
        "passes", binomial_tail(F.col("false_rejections"), F.col("holdout"), limit / len(RULES)) <= error / F.col("statements")
    )
    # A stricter cutoff rejects more, so those that pass are the mildest ones.
    return (
        tested.filter("passes")
        .groupBy("stratum", "rule")
        .agg(F.min("cutoff").alias("cutoff"), F.max("false_rejections").alias("false_rejections"), F.max("holdout").alias("holdout"))
    )


def judge(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of every row of ``docs`` (doc_id, text, lang).

    A document fails the base with fewer than 50 words or with more than half of its words in
    repeated three-word windows; otherwise the rules of its stratum decide. A null text has no
    words. A null language is a stratum; one without enough labels rejects nothing by rules.
    Labels of unknown documents do not count; repeated rows are judged alike. Other columns are
    not read.
    """
    space = Workspace(docs.sparkSession, "risk")
    found = space.write(measures(docs), "measures")
    chosen = cutoffs(found, labels.select("doc_id", "quality"), limit, error)
    chosen = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    chosen = space.write(chosen.withColumnRenamed("stratum", "s"), "cutoffs")
    judged = found.join(chosen, F.col("stratum").eqNullSafe(F.col("s")), "left")
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rejected = F.lit(False)
    for name, value in rule_values().items():
        rejected = rejected | F.coalesce(value > F.col("cutoffs")[name], F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~rejected).alias("kept"),
    )


#: The same in SQL.
JUDGE_SQL = """
WITH tokens AS (
  SELECT row_number() OVER () AS r, doc_id, lang AS stratum, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
windows AS (
  SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS g FROM tokens, unnest(range(1, len(w) - 1)) AS u(i)),
twins AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows),
covered AS (SELECT r, count(DISTINCT i + d) AS n_repeat_words FROM twins, unnest([0, 1, 2]) AS u(d) WHERE n > 1 GROUP BY r),
found AS (
  SELECT t.r, doc_id, stratum, md5(text) AS body, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(regexp_extract_all(text, '[A-Z]')) AS n_capitals, len(regexp_extract_all(text, '[!?]')) AS n_marks
  FROM tokens t LEFT JOIN covered c ON t.r = c.r),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
valued AS (
  SELECT r, doc_id, stratum, body, unnest([
    {{'rule': 'symbols', 'value': CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END}},
    {{'rule': 'capitals', 'value': CASE WHEN word_chars > 0 THEN n_capitals / word_chars ELSE 0 END}},
    {{'rule': 'marks', 'value': CASE WHEN word_chars > 0 THEN n_marks / word_chars ELSE 0 END}},
    {{'rule': 'repeated_words', 'value': CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END}},
    {{'rule': 'repeated_lines', 'value': CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END}},
    {{'rule': 'long_words', 'value': CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END}}], recursive := true) FROM found),
grid AS ({grid}),
tested AS (
  SELECT stratum, rule, cutoff, count(DISTINCT body) AS n, count(DISTINCT body) FILTER (value > cutoff) AS k
  FROM valued JOIN good USING (doc_id) JOIN grid USING (rule) GROUP BY ALL),
passing AS (
  SELECT stratum, rule, cutoff FROM tested WHERE k < n * {rate} AND
    list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END - lgamma(n - i + 1)
      + i * ln({rate}) + (n - i) * ln(1 - {rate})))) <= {error} / (SELECT count(*) FROM (SELECT DISTINCT stratum, rule FROM tested))),
chosen AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM passing GROUP BY ALL),
rejected AS (
  SELECT r, bool_or(coalesce(value > cutoff, false)) AS rejected
  FROM valued v LEFT JOIN chosen c ON v.stratum IS NOT DISTINCT FROM c.stratum AND v.rule = c.rule GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT rejected AS kept
FROM found JOIN rejected USING (r)
""".format(
    grid=" UNION ALL ".join(f"SELECT '{rule}' AS rule, unnest({values})::DOUBLE AS cutoff" for rule, values in RULES.items()),
    rate=f"{LIMIT / len(RULES)!r}::DOUBLE",
    error=f"{ERROR!r}::DOUBLE",
)
