"""Hard negatives, tokenizer alignment and sharding against plain versions."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm import brute
from tests.llm.test_repeats import pairs, same
from timelegs.llm import differencing, hard_negatives, merge_path
from timelegs.llm.queries import QUERIES, TOKENIZERS

FILES = [f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"]
VECTORS = "vec_id bigint, embedding array<float>, label int"


def test_hard_negatives_query(spark, here):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    plain = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in rows]
    got = [tuple(r) for r in QUERIES["op11_hard_negatives"](spark, SF_DIR).collect()]
    want = brute.hard_negatives(plain)
    same(got, want)
    assert want


def odd_vectors():
    """Copies, ties, zero and negative scores, repeated ids, unusable rows, several lengths."""
    rng = random.Random(9)
    rows = [(k, [round(rng.gauss(0, 0.3), 3) for _ in range(6)], k % 3) for k in range(240)]
    rows += [(300 + k, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0], 1) for k in range(30)]  # ties, one label
    rows += [(400 + k, [0.4, 0.2, 0.0, 0.0, 0.0, 0.0], 2) for k in range(30)]
    rows += [(500 + k, [0.0] * 6, 4 + k % 2) for k in range(40)]  # all scores zero
    rows += [(600, [-1.0] * 6, 9), (601, [1.0] * 6, 9), (602, [-0.5] * 6, 8)]  # a negative positive
    rows += [(0, rows[0][1], 0), (0, rows[0][1], 0), (100, [1.0, 2.0], 1), (700, [], 1), (800, [3.5] * 9, 2)]
    rows += [(900, [1e30, 1.0, 0.0, 0.0, 0.0, 0.0], 5), (901, [1e30, 2.0], 5), (902, [3e29, 1.0], 6), (903, [1e9] * 6, 6)]
    bad = [(None, [0.1] * 6, 1), (1000, None, 1), (1001, [0.1] * 6, None), (1002, [0.1, None], 1), (1003, [float("nan")], 1), (1004, [float("inf")], 1)]
    return rows, bad


def test_hard_negatives_of_odd_vectors(spark, here, monkeypatch):
    rows, bad = odd_vectors()
    df = spark.createDataFrame(rows + bad, VECTORS).repartition(5)
    df = df.withColumns({c: F.lit("mine") for c in ("id", "anchor", "tile", "part", "block", "score")})
    plain = [(i, label, [float(np.float32(x)) for x in v]) for i, v, label in rows]
    want = brute.hard_negatives(plain)
    same([tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect()], want)
    assert {w[4] for w in want if w[0] == 500} == {0}


def test_small_tiles_find_the_same(spark, here, monkeypatch):
    rows, bad = odd_vectors()
    df = spark.createDataFrame(rows + bad, VECTORS)
    monkeypatch.setattr(hard_negatives, "TILE_BYTES", 64)  # several groups of anchors
    monkeypatch.setattr(hard_negatives, "LEAST_PARTS", 3)
    plain = [(i, label, [float(np.float32(x)) for x in v]) for i, v, label in rows]
    same([tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect()], brute.hard_negatives(plain))


def test_no_vectors(spark, here):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(none, F.col("vec_id") % 100 == 0).collect() == []
    alone = spark.createDataFrame([(1, [1.0], 1)], VECTORS)
    assert hard_negatives.mine(alone, F.col("vec_id") % 100 == 0).collect() == []


def plain_alignment(docs):
    (a, a_bytes, _), (b, b_bytes, _) = merge_path.byte_level(FILES[0]), merge_path.pieces(FILES[1])
    return brute.alignment(docs, lambda t: a.encode(t, add_special_tokens=False).ids, a_bytes.__getitem__, b.encode, b_bytes.__getitem__)


def aligned(df, **options):
    return [tuple(r) for r in merge_path.align(df, *FILES, **options).collect()]


def test_alignment_query(spark, documents):
    got = [tuple(r) for r in QUERIES["op12_merge_path"](spark, SF_DIR).collect()]
    want = plain_alignment(pairs(documents))
    same(got, [(*w[:-1], brute.sha(w[-1].encode()) if w[-1] else "") for w in want])


@pytest.mark.parametrize("work, block", [(1 << 18, 1 << 20), (7, 1 << 20), (1000, 20_000)])
def test_alignment_of_odd_documents(spark, odd, work, block):
    """Pieces of any size, down to one end each, give the same groups."""
    more = [(900, "▁ under ▁▁"), (901, "<|endoftext|> <s> </s> <0x0A>"), (902, "tab\tnew\n\n line\r\n  two"), (903, "日本語のテキスト \U0001f600\U0001f601"), (904, " "), (905, "é ﬁ  ")]
    df = odd.unionByName(spark.createDataFrame(more, "doc_id bigint, text string"), allowMissingColumns=True)
    if work < 1000:
        df = df.filter("text IS NULL OR length(text) < 6000")
    same(aligned(df, work=work, block_bytes=block), plain_alignment(pairs(df)))


def test_alignment_of_nothing(spark, nothing):
    assert aligned(nothing) == []


def test_merge_path_splits_are_equal_work():
    rng = random.Random(1)
    for _ in range(500):
        a, b = (np.array(sorted(rng.sample(range(1, 60), rng.randrange(20))), np.int64) for _ in range(2))
        work = rng.randrange(1, 12)
        i, j = merge_path.cut_path(a, b, work)
        assert (i[0], j[0], i[-1], j[-1]) == (0, 0, len(a), len(b))
        assert (np.diff(i) + np.diff(j) <= work + 1).all()
        for x, y in zip(i, j, strict=True):
            left, right = [*a[:x], *b[:y]], [*a[x:], *b[y:]]
            assert not left or not right or max(left) < min(right)


def loads_of(loads, shards):
    found = [0] * shards
    for load, shard in zip(loads, differencing.differencing(loads, shards), strict=True):
        found[shard] += load
    return sorted(found)


def test_differencing():
    assert loads_of([8, 7, 6, 5, 4], 2) == [14, 16]  # the textbook example
    assert loads_of([], 3) == [0, 0, 0] and loads_of([5], 3) == [0, 0, 5]
    rng = random.Random(2)
    many = [rng.randrange(1, 100_000) for _ in range(3000)]
    assert loads_of(many, 8)[-1] - loads_of(many, 8)[0] <= 8
    heavy = loads_of([*many, sum(many)], 8)  # one group of half of all; the others follow as if placed one by one
    assert heavy[-1] == sum(many) and heavy[-2] - heavy[0] <= min(many) + 1000


def check_shards(rows, docs, shards=8):
    """``rows`` are (doc_id, size, crc, shard, slot): the law and the numbering."""
    same([r[:3] for r in rows], [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs])
    slots, loads, home = defaultdict(list), Counter(), {}
    for _, size, crc, shard, slot in rows:
        assert 0 <= shard < shards
        slots[shard].append(slot)
        loads[shard] += size
        assert home.setdefault((size, crc), shard) == shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [loads[s] for s in range(shards)]


def test_differencing_query(spark, documents):
    found = QUERIES["op13_differencing"](spark, SF_DIR)
    rows = found.collect()
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    loads = check_shards([tuple(r[c] for c in ("doc_id", "size", "text_crc32", "shard", "slot")) for r in rows], pairs(documents))
    assert max(loads) - min(loads) <= 8


def test_shards_of_odd_documents(spark, odd, nothing, tmp_path):
    keep = [c for c in odd.columns if c != "size"]
    rows = differencing.divide(odd, 3, keep=keep).collect()
    check_shards([(r["row"]["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in rows], pairs(odd), 3)
    assert differencing.divide(nothing).collect() == []
    differencing.write_shards(odd, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    same(pairs(back), pairs(odd))
    assert sorted(f.name for f in (tmp_path / "out").glob("shard=*")) == [f"shard={k}" for k in sorted({r["shard"] for r in rows})]


def test_many_rows_a_file_are_numbered_in_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(differencing, "ROWS_A_FILE", 7)
    rows = differencing.divide(documents, keep=["doc_id"]).collect()
    check_shards([(r["row"]["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in rows], pairs(documents))


def test_the_faster_encoder_gives_the_same_ids():
    rng = random.Random(5)
    plain = [chr(c) for c in [9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250)]]
    texts = ["".join(rng.choice(plain) if rng.random() < 0.7 else rng.choice(" \n\tab'se1") for _ in range(rng.randrange(200))) for _ in range(3000)]
    texts += [c + after for c in plain for after in ("a", " ", "1", "!", "\n")]
    texts += ["<|endoftext|>x<|endoftext|>", "a" * 3000, "日本   \x1c\x85 x", "  \n\n  x "]
    model = merge_path.byte_level(FILES[0])[0]
    assert merge_path.ranked(FILES[0]) is not None
    assert merge_path.byte_level_ids(texts, FILES[0]) == [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
