from __future__ import annotations

import random

from pyspark.sql import functions as F

from timelegs.operators import cleaning, rollups


def test_bitmaps_roll_up_to_any_grouping(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), rng.randrange(4), f"k{rng.randrange(60)}") for _ in range(500)] + [("a", 1, None), (None, 2, "k1"), ("d", 3, None)]
    df = spark.createDataFrame(rows, "line string, hour int, key string").repartition(4)
    rollups.key_bitmaps(df, ["line", "hour"], ["key"]).write.parquet(str(tmp_path / "b"))
    bitmaps = spark.read.parquet(str(tmp_path / "b"))
    for by in (["line", "hour"], ["line"], ["hour"], []):
        got = {tuple(r)[:-1]: r["n"] for r in rollups.distinct_keys(bitmaps, by, "n").collect()}
        want: dict = {}
        for line, hour, key in rows:
            group = tuple({"line": line, "hour": hour}[c] for c in by)
            if key is not None:
                want.setdefault(group, set()).add(key)
        assert got == {g: len(keys) for g, keys in want.items()}


def test_keys_of_several_bitmaps(spark):
    df = spark.range(100_000).select((F.col("id") % 2).alias("side"), (F.col("id") % 70_000).alias("key"), F.lit(1).alias("part"))
    bitmaps = rollups.key_bitmaps(df, ["side"], ["key", "part"])
    assert {r["side"]: r["n"] for r in rollups.distinct_keys(bitmaps, ["side"], "n").collect()} == {0: 35_000, 1: 35_000}
    assert rollups.distinct_keys(bitmaps, [], "n").first()["n"] == 70_000


def test_sketches_merge_within_their_bound(spark):
    df = spark.range(50_000).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("x")).unionByName(
        spark.createDataFrame([(1, None)], "g bigint, x double")
    )
    sketches = rollups.quantile_sketches(df, ["g"], "x")
    found = rollups.quantiles_of(sketches, [], {"low": 0.01, "mid": 0.5, "high": 0.999}).first()
    assert found["rows"] == 50_000
    for name, p in (("low", 0.01), ("mid", 0.5), ("high", 0.999)):
        assert abs(found[name] - p * 50_000) <= 1 + rollups.RANK_ERROR * 50_000


def test_the_funnel_tells_rows_apart_by_their_nulls(spark, raw_row):
    rows = [raw_row(), raw_row(), raw_row(service_ref=None, line_ref="X"), raw_row(service_ref="X", line_ref=None), raw_row(service_ref=""), raw_row(service_ref=None)]
    from timelegs.schemas import RAW_SEGMENTS

    counts = cleaning.quality_funnel(spark.createDataFrame(rows, RAW_SEGMENTS)).first()
    assert (counts["raw_records"], counts["duplicates_removed"]) == (6, 1)


def test_distinct_counts_of_a_line_write_no_table(spark, network, monkeypatch):
    from tests.conftest import SF_DIR
    from timelegs.operators import serving
    from timelegs.registry import QUERIES
    from timelegs.sources import sample_network

    def refused(*_):
        raise AssertionError("a table is written")

    monkeypatch.setattr(sample_network, "stage", refused)
    monkeypatch.setattr(serving, "new_folder", refused)
    got = {r["line_ref"]: (r["unique_segments"], r["unique_vehicle_journeys"]) for r in QUERIES["line_distinct_counts"](spark, SF_DIR).collect()}
    want: dict = {}
    for r in network.enriched.select("line_ref", "segment_key", "source_file", "vehicle_journey_code").collect():
        segments, journeys = want.setdefault(r["line_ref"], (set(), set()))
        segments.add(r["segment_key"])
        journeys.add((r["source_file"], r["vehicle_journey_code"]))
    assert got == {line: (len(segments), len(journeys)) for line, (segments, journeys) in want.items()}
