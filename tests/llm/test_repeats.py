"""Suffix arrays, cover anchors, the similarity join and decontamination against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm import brute
from timelegs.llm import anchor_dedup, decontaminate, jaccard_join, suffix_dedup
from timelegs.llm.components import connected_components
from timelegs.llm.queries import QUERIES
from timelegs.llm.store import Workspace

BENCHMARK = [
    (1, "zero one two three four five six seven eight nine ten eleven"),
    (2, "short item"),
    (3, None),
    (4, ""),
    (5, "Zero-one, two three: four five six seven eight NINE"),
    (None, "no name"),
]


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def suffix_rows(df, length=200):
    out = suffix_dedup.remove_repeats(df, length)
    found = out.select("row.doc_id", "n_bytes", "kept", "spans").collect()
    return [(r[0], r[1], sum(s["upto"] - s["begin"] for s in r["spans"]), len(r["spans"]), brute.sha(bytes(r["kept"]))) for r in found]


@pytest.mark.parametrize("name, plain", [("op1_suffix_dedup", brute.byte_repeats), ("op9_jaccard_join", brute.near_duplicates), ("op10_anchor_dedup", brute.word_repeats)])
def test_queries_agree_with_plain_versions(spark, documents, name, plain):
    got = [tuple(r) for r in QUERIES[name](spark, SF_DIR).collect()]
    same(got, plain(pairs(documents)))


def test_decontamination_query(spark, documents):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op6_decontaminate"](spark, SF_DIR).collect()]
    want = brute.benchmark_hits(pairs(documents), items)
    same(got, [(*w, w[2] > 0) for w in want])
    assert any(w[2] for w in want)


def test_odd_documents(odd):
    docs = pairs(odd)
    same(suffix_rows(odd), brute.byte_repeats(docs))
    words = anchor_dedup.remove_repeats(odd).collect()
    same([(r[0], r[1], r[2], brute.sha(bytes(r[3]))) for r in words], brute.word_repeats(docs))
    same([tuple(r) for r in jaccard_join.near_duplicates(odd).collect()], brute.near_duplicates(docs))


def test_decontamination_of_odd_documents(spark, odd):
    more = [(100, "Say: zero, one two three four five six SEVEN eight nine ten!"), (101, "a short item here"), (102, "zero one two three four five six seven eight")]
    odd = odd.unionByName(spark.createDataFrame(more, "doc_id bigint, text string"), allowMissingColumns=True)
    items = spark.createDataFrame(BENCHMARK, "item_id bigint, text string")
    want = brute.benchmark_hits(pairs(odd), [b for b in BENCHMARK if b[0] is not None])
    for size in (8 << 20, 200):  # one slice, and several
        got = decontaminate.find_matches(odd, items, slice_bytes=size).select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256")
        same([tuple(r) for r in got.collect()], want)
    kept = decontaminate.remove_contaminated(odd, items)
    assert kept.columns == odd.columns
    same(pairs(kept), [d for d, w in zip(pairs(odd), brute.benchmark_hits(pairs(odd), [b for b in BENCHMARK if b[0] is not None]), strict=True) if not w[2]])


def test_longest_matches_are_located(spark, here):
    docs = spark.createDataFrame([(1, "x y zero one two three four five six seven eight nine ten z")], "doc_id bigint, text string")
    items = spark.createDataFrame(BENCHMARK[:1], "item_id bigint, text string")
    found = decontaminate.find_matches(docs, items).first()["found"]
    assert [tuple(m) for m in found] == [("1", 0, 2, 11)]


def test_empty_tables(spark, nothing):
    assert suffix_rows(nothing) == []
    assert anchor_dedup.remove_repeats(nothing).collect() == []
    assert jaccard_join.near_duplicates(nothing).collect() == []
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find_matches(nothing, none).collect() == []


def test_empty_benchmark(spark, odd):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.remove_contaminated(odd, none).count() == odd.count()


@pytest.mark.parametrize("seed", range(4))
def test_sorted_bucket_finds_every_repeat(seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab" if seed % 2 else "abcd efg") for _ in range(80)) for _ in range(6)]
    segments = ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 5))).encode() for _ in range(25)]
    got = suffix_dedup.repeated_starts(np.frombuffer(b"".join(segments), np.uint8), np.array([len(s) for s in segments]), 50)
    seen = {}
    for s in segments:
        for i in range(len(s) - 49):
            seen[s[i : i + 50]] = seen.get(s[i : i + 50], 0) + 1
    want = [i + 50 <= len(s) and seen[s[i : i + 50]] > 1 for s in segments for i in range(len(s))]
    assert got.tolist() == want


def test_covers_meet_every_difference():
    for period, cover in ((suffix_dedup.PERIOD, suffix_dedup.COVER), (anchor_dedup.PERIOD, anchor_dedup.COVER)):
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_shortest_lengths_are_checked(nothing):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(nothing, 20)
    with pytest.raises(ValueError):
        anchor_dedup.remove_repeats(nothing, 10)


def test_edited_copies_of_every_distance(spark, here):
    """A group whose members are near the first one, near each other only in chains, or not at all."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(220)]
    docs = []
    for k in range(160):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 8])):
            text[rng.randrange(len(text))] = f"e{k}x{rng.randrange(10**6)}"
        docs.append((k, " ".join(text[: rng.choice([220, 220, 200, 180])])))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    same([tuple(r) for r in jaccard_join.near_duplicates(df).collect()], brute.near_duplicates(docs))


def test_components_of_chains_and_stars(spark, here):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (200, 190)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df, Workspace(spark, "test"), "c").collect()}
    assert got == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {200: 190, 190: 190}


def test_no_shuffle_for_decontamination(spark, documents):
    plan = decontaminate.find_matches(documents, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_only_needed_columns_are_read(documents):
    plan = suffix_dedup.remove_repeats(documents, keep=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "lang" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_rows_survive_in_full(odd):
    out = suffix_dedup.remove_repeats(odd).select("row.*")
    assert out.columns == odd.columns
    assert out.select(F.sum(F.length("text"))).first() == odd.select(F.sum(F.length("text"))).first()


def test_items_without_a_name_are_tested(spark, here):
    docs = spark.createDataFrame([(1, "here is a secret line of text"), (2, "nothing of it")], "doc_id bigint, text string")
    items = spark.createDataFrame([(None, "secret line"), (3, "other words")], "item_id bigint, text string")
    for size in (8 << 20, 60):
        got = decontaminate.find_matches(docs, items, slice_bytes=size).select("row.doc_id", "n_hit", "n_items").collect()
        assert sorted(tuple(r) for r in got) == [(1, 2, 0), (2, 0, 0)]
    assert [r["doc_id"] for r in decontaminate.remove_contaminated(docs, items).collect()] == [2]


def test_overlaps_are_accumulated_over_blocks_of_columns(monkeypatch):
    rng = random.Random(8)
    sides = [[np.array(sorted(rng.sample(range(200), rng.randrange(1, 80))), np.uint64) for _ in range(n)] for n in (7, 12)]
    want = [[len(set(x.tolist()) & set(y.tolist())) for y in sides[1]] for x in sides[0]]
    for step in (1, 13, 8192):
        monkeypatch.setattr(jaccard_join, "COLUMNS_A_STEP", step)
        assert jaccard_join.overlaps(*sides).tolist() == want


def test_tiles_link_what_leaders_miss(spark, here):
    """Templated texts around shared words: many groups in a column, links across sizes, none below 0.8."""
    rng = random.Random(6)
    words = [f"v{k}" for k in range(400)]
    frame = words[:12]
    docs = []
    for group in range(90):
        own = [rng.choice(words) + str(group) for _ in range(rng.choice([40, 60, 90]))]
        docs += [(len(docs) + c, " ".join(frame + own[: len(own) - c] + [f"e{group}"] * c)) for c in range(3)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    same([tuple(r) for r in jaccard_join.near_duplicates(df).collect()], brute.near_duplicates(docs))
