"""Language identification, the language model, quality rules and classifier, mixing and chats."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from timelegs.llm import chat_snapshots, curriculum, language_id, lbl_model, risk_rules, weak_quality
from timelegs.llm.queries import QUERIES, remainder


def trains(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 != 2


def test_fold_is_the_checksum(documents):
    for r in documents.select("doc_id", remainder(5).alias("r")).collect():
        assert r["r"] == zlib.crc32(str(r["doc_id"]).encode()) % 5


def test_held_out_languages(spark, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    held = [r for r in QUERIES["op5_language_id"](spark, SF_DIR).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in held)


def test_languages_of_odd_documents(odd):
    model = language_id.train(odd)
    assert model.languages == ["en", "fr"]
    out = language_id.predict(odd, model)
    assert out.select("row.*").columns == odd.columns
    for r in out.collect():
        text = r["row"]["text"] or ""
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text))


def test_naive_bayes_is_the_sum_of_its_parts(spark, here):
    rows = [("le chat est là", "fr"), ("the cat is here", "en"), ("the dog", "en")]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = language_id.train(df)
    counts = {}
    for lang in ("en", "fr"):
        counts[lang] = Counter()
        for t, x in rows:
            if x == lang:
                codes = np.frombuffer((t + "  ").encode("utf-32-le"), np.uint32)
                counts[lang].update(language_id.features(codes)[1].tolist())
    codes = np.frombuffer("the chat  ".encode("utf-32-le"), np.uint32)
    total = {}
    for lang, docs in (("en", 2), ("fr", 1)):
        mass = sum(counts[lang].values()) + 0.5 * language_id.BINS
        total[lang] = math.log(docs / 3) + sum(math.log((counts[lang][b] + 0.5) / mass) for b in language_id.features(codes)[1].tolist())
    best = max(total, key=total.get)
    share = 1 / sum(math.exp(v - total[best]) for v in total.values())
    got = language_id.predict(spark.createDataFrame([("the chat",)], "text string"), model).first()
    assert got["lang_pred"] == best and got["score"] == pytest.approx(share)


def test_languages_without_rows(spark, nothing):
    model = language_id.train(nothing)
    assert language_id.predict(nothing, model).collect() == []
    one = spark.createDataFrame([("words",)], "text string")
    assert tuple(language_id.predict(one, model).first())[1:] == ("und", 0.0)


def test_too_many_languages(spark, here):
    df = spark.createDataFrame([("text", f"l{k}") for k in range(5)], "text string, lang string")
    with pytest.raises(ValueError):
        language_id.train(df, max_languages=4)


def plain_scores(rows):
    tokens = [(d, [*(t or "").encode().lower().split(), None]) for d, t in rows]
    c = Counter()
    for d, t in tokens:
        if trains(d):
            c.update(t)
    n, v = sum(c.values()), len(c)
    return [(d, not trains(d), len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for d, t in tokens]


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_token_counts_and_base_score(request, table):
    df = request.getfixturevalue(table)
    got = lbl_model.score_corpus(df, trains).collect()
    want = plain_scores([(r["doc_id"], r["text"]) for r in df.collect()])
    key = lambda r: (str(r[0]), r[2], r[3])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert tuple(g)[:5] == w[:5]
        assert g["base_score"] == pytest.approx(w[5])
        assert g["score"] < 0


def test_model_probabilities_add_up_to_one():
    rng = np.random.default_rng(1)
    m = lbl_model.Model(np.arange(9, dtype=np.uint64), np.arange(1, 11), rng.normal(size=(10, 4)), rng.normal(size=(10, 4)), rng.normal(size=10), 55, 14)
    assert np.exp(m.log_table()).sum(axis=1) == pytest.approx(np.ones(10), rel=1e-5)
    # Five outside types share the outside mass of ten tokens, and all unseen tokens are one type.
    seen = np.array([4, 2, 2, 1, 1])
    assert np.exp(m.log_outside(np.append(seen, 0))).sum() == pytest.approx(1)


def test_contrast_learns_bigrams(spark, here):
    rng = np.random.default_rng(5)
    docs = []
    for k in range(400):
        at, words = int(rng.integers(20)), []
        for _ in range(60):
            at = (at * 7 + 1) % 20 if rng.random() < 0.9 else int(rng.integers(20))
            words.append(f"w{at}")
        docs.append((k, " ".join(words)))
    out = lbl_model.score_corpus(spark.createDataFrame(docs, "doc_id bigint, text string"), trains)
    held = out.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_no_rows_to_score(nothing):
    assert lbl_model.score_corpus(nothing, trains).collect() == []


def test_nothing_to_learn_from(documents):
    got = lbl_model.score_corpus(documents.limit(20), lambda doc_id: False).collect()
    assert len(got) == 20 and all(r["train_tokens"] == 0 and r["base_score"] == 0 for r in got)


@pytest.mark.parametrize("k, n, rate", [(0, 10, 0.1), (3, 100, 0.1), (90, 1000, 0.1), (0, 5000, 0.01), (40, 5000, 0.01), (49, 5000, 0.01)])
def test_binomial_tail_is_exact(spark, k, n, rate):
    want = sum(math.comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1))
    row = spark.range(1).select(F.lit(k).alias("k"), F.lit(n).alias("n"))
    got = row.select(risk_rules.binomial_tail(F.col("k"), F.col("n"), rate)).first()[0]
    assert got == pytest.approx(want, rel=1e-9)


def test_rules_reject_few_good_documents(spark, here):
    rows = [(k, ("word " * 3 + f"w{k} ") * 1 + " ".join(f"t{k}x{j}" for j in range(60)) + (" ###" * 20 if k % 10 == 0 else ""), "en") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 10 != 0).cast("int").alias("quality"))
    out = {r["doc_id"]: r["kept"] for r in risk_rules.judge(docs, labels).collect()}
    assert not any(out[k] for k in range(0, 3000, 10))
    assert np.mean([out[k] for k in range(3000) if k % 10]) > 1 - risk_rules.LIMIT


def test_few_labels_reject_nothing(odd, spark):
    labels = spark.createDataFrame([(7, 1), (7, 0), (12, 1), (999, 1)], "doc_id bigint, quality int")
    out = risk_rules.judge(odd, labels).collect()
    assert len(out) == odd.count()
    assert all(r["kept"] == (not r["base_failed"]) for r in out)


def test_base_counts(odd, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    want = []
    for r in odd.collect():
        text = r["text"] or ""
        w = [x.decode() for x in text.encode().split()]
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        want.append((r["doc_id"], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)))
    got = [tuple(r)[:6] for r in risk_rules.judge(odd, labels).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_rules_stay_on_the_jvm(documents, spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    for df in (risk_rules.judge(documents, labels), curriculum.mix(documents), risk_rules.measures(documents)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_rules_without_rows(nothing, spark):
    assert risk_rules.judge(nothing, spark.createDataFrame([], "doc_id bigint, quality int")).collect() == []


def test_weak_labels_find_planted_junk(spark, here):
    good = [(k, f"This is text number {k}. It has words like tree{k % 50} and plain sentences.\nAnother line follows here.") for k in range(300)]
    bad = [(300 + k, " ".join(f"X{k}Y{j}###" for j in range(40)).upper()) for k in range(60)]
    mean = [(400 + k, f"{good[k][1]} You are a stupid moron, an idiot.") for k in range(60)]
    docs = spark.createDataFrame(good + bad + mean, "doc_id bigint, text string")
    out = {r["doc_id"]: r["kept"] for r in weak_quality.classify(docs, weak_quality.train(docs)).collect()}
    assert np.mean([out[k] for k in range(300)]) > 0.97
    assert np.mean([out[k] for k in range(300, 360)]) < 0.05
    assert np.mean([out[k] for k in range(400, 460)]) < 0.05


def test_expectation_maximisation_recovers_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.7
    accuracy = [0.9, 0.8, 0.75, 0.85]
    votes = np.array([np.where(rng.random(len(truth)) < a, truth, ~truth) for a in accuracy]).T.astype(int)
    pattern, counts = np.unique(votes, axis=0, return_counts=True)
    chance, _ = weak_quality.expectation_maximisation(pattern, counts.astype(float))
    for j, a in enumerate(accuracy):
        assert chance[j][1, 2] == pytest.approx(a, abs=0.03) and chance[j][0, 0] == pytest.approx(a, abs=0.03)


def test_weak_labels_of_odd_documents(odd, nothing):
    scorer = weak_quality.train(odd)
    out = weak_quality.classify(odd, scorer).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    assert weak_quality.classify(nothing, weak_quality.train(nothing)).collect() == []


def water_fill(sizes, share=1.5):
    """Targets by resharing the excess until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, out, open_ = share * sum(sizes.values()), {}, set(sizes)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_mix_meets_its_targets(request, table):
    df = request.getfixturevalue(table)
    out = curriculum.mix(df).collect()
    assert len(out) == df.count()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in out:
        source = r["row"]["source"]
        assert r["size"] == len((r["row"]["text"] or "").encode().split())
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert (r["position"] is None) == (r["taken"] == 0)
        sizes[source] += r["size"]
        taken[source] += r["taken"]
    want = water_fill(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["row"]["source"]]
        assert r["target"] == pytest.approx(want[r["row"]["source"]])
    for source, t in want.items():
        assert t - 1 <= taken[source] <= t + 1e-6
    places = [r["position"] for r in out if r["position"] is not None]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1


def test_positions_invert_the_schedule(spark):
    for slope in (-0.5, 0.0, 0.5):
        row = spark.range(5).select((F.col("id") / 4.0 * 80).alias("x"), curriculum.position(F.col("id") / 4.0 * 80, F.lit(80.0), F.lit(slope)).alias("t"))
        for r in row.collect():
            assert slope * r["t"] ** 2 + (1 - slope) * r["t"] == pytest.approx(r["x"] / 80)


def test_mix_of_nothing(nothing):
    assert curriculum.mix(nothing).collect() == []


def test_snapshots_collapse(spark, here):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", None), ("assistant", "bye")]
    rows = []
    for conv, n in ((1, 2), (2, 4), (3, 4), (4, 1), (5, 3)):
        rows += [(conv, k, *talk[k]) for k in range(n)]
    rows += [(6, 0, "user", "hi"), (6, 1, "assistant", "other"), (7, 0, None, ""), (8, 0, "user", "hi"), (8, 1, "assistant", ""), (None, 0, "user", "hi")]
    rows += [(6, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("k", F.lit(1))
    got = {r["conv_id"]: r for r in chat_snapshots.format_chats(df.repartition(3)).collect()}
    assert sorted(got) == [2, 6, 7, 8]
    assert got[6]["chat"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nother<|im_end|>\n"
    assert got[2]["n_turns"] == 4 and got[7]["chat"] == "<|im_start|>unknown\n<|im_end|>\n"
    assert chat_snapshots.format_chats(df.filter("false")).collect() == []


def test_outside_words_teach_their_context(spark, here):
    """Words beyond the vocabulary follow each other in a fixed order, which only their bins can learn."""
    rng = np.random.default_rng(9)
    docs = []
    for k in range(600):
        at = int(rng.integers(64))
        docs.append((k, " ".join(f"w{(at + j) % 64}" for j in range(40))))
    out = lbl_model.score_corpus(spark.createDataFrame(docs, "doc_id bigint, text string"), trains, vocabulary=2)
    held = out.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > 0.95 * held[1]


def test_a_round_takes_every_counted_pair():
    rng = np.random.default_rng(4)
    counts = np.append(rng.integers(1, 3000, 500), np.ones(500, np.int64))
    chunks = list(lbl_model.occurrences(np.arange(1000), counts, rng, 100, chunk=50_000))
    assert len(chunks) > 10 and max(map(len, chunks)) < 52_000
    assert np.bincount(np.concatenate(chunks), minlength=1000).tolist() == counts.tolist()


def test_insults_of_other_forms_and_languages_are_voted_bad():
    texts = ["They met some idiots there.", "Such losers came.", "Quel crétin, vraiment.", "Ein Dummkopf ist er.", "We hate you and all of it.", "You 1d10t went home.", "A quiet day at the lake."]
    g = next(weak_quality.groups(pa.array(texts)))
    votes = np.array([g.votes[name] for name in weak_quality.TOXICITY])
    assert (votes == 0).any(axis=0).tolist() == [True] * 6 + [False]
    assert not (votes[:, :6] == 1).all(axis=0).any()


def test_copies_are_no_independent_draws(spark, here):
    """Twenty good texts allow no cutoff, and sixty copies of each, under ids of their own, don't either."""
    texts = [" ".join(f"w{k}x{i}" for i in range(60 + k)) for k in range(20)]
    rows = [(k * 100 + c, texts[k], "en") for k in range(20) for c in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert risk_rules.cutoffs(risk_rules.measures(docs), labels).collect() == []


def test_a_sample_of_any_share_is_drawn(spark, here):
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    assert docs.filter(weak_quality.in_sample(40_000, 40_000)).count() == 200_000
    assert 9_500 < docs.filter(weak_quality.in_sample(50, 1000)).count() < 10_500
    # of 10**11 rows, 200,000 are a 500,000th; a share of 4 * 10**-7 of all hashes isn't none
    limit = int(40_000 / 10**11 * 2**63)
    assert str(limit) in str(weak_quality.in_sample(40_000, 10**11)) and limit > 10**12
