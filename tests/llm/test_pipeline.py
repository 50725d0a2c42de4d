"""The stages in a row against plain versions of each, on the stage's own input."""

from __future__ import annotations

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_each_other(spark, documents, tmp_path):
    given = {r["doc_id"]: r["text"] for r in documents.collect()}
    docs, seen = documents, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append({r["doc_id"]: r.asDict() for r in docs.collect()})
        if name != "mix":
            assert docs.columns == COLUMNS
    known, once, cut, clean, mix = seen
    assert {d for d, t in given.items() if t and any(c.isalpha() for c in t)} == set(known)
    groups = brute.near_duplicates([(d, r["text"]) for d, r in known.items()])
    assert set(once) == {c for _, _, c in groups}
    removed = {d: n for d, _, n, _, _ in brute.byte_repeats([(d, r["text"]) for d, r in once.items()])}
    for d, r in once.items():
        if not removed[d]:
            assert cut[d] == r
        elif d in cut:
            assert len(r["text"].encode()) - removed[d] - 6 <= len(cut[d]["text"].encode()) <= len(r["text"].encode()) - removed[d]
            assert cut[d]["n_chars"] == len(cut[d]["text"])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    hits = brute.benchmark_hits([(d, r["text"]) for d, r in cut.items()], items)
    assert set(clean) == {d for d, _, n, _, _ in hits if not n}
    assert set(mix) == set(clean) and all(mix[d]["text"] == clean[d]["text"] for d in clean)


def test_odd_documents_pass_every_stage(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR).collect()
        docs = stage(spark, docs, SF_DIR).select(*odd.columns)
        assert out
    assert set(odd.columns) <= set(docs.columns)


def test_empty_documents_pass_every_stage(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.collect() == []
        docs = docs.select(*COLUMNS)
