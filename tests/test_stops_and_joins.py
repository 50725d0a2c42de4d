from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from timelegs.operators import enrichment, joins, stops
from timelegs.plans import inspect
from timelegs.schemas import STOP_CATALOGUE, STOPS
from timelegs.sources import tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def record(ref, name="", locality="", lat="", file="f", pos=0):
    return (ref, name, locality, lat, lat, "1" if lat else "0", "x", file, pos)


RECORD = "stop_ref string, common_name string, locality_name string, latitude string, longitude string, has_coordinates string, source_type string, source_file string, position int"


def test_best_record_and_tie(spark):
    df = spark.createDataFrame(
        [
            record("A", "low", pos=1),
            record("A", "first", "", "1.0", file="f", pos=2),
            record("A", "later", "", "1.0", file="g", pos=0),
            record("", "no ref", "x", "1.0"),
        ],
        RECORD,
    )
    for layout in (df, df.repartition(3)):
        best = stops.best_stop_records(layout, ["source_file", "position"]).collect()
        assert [(r["stop_ref"], r["common_name"]) for r in best] == [("A", "first")]


def test_catalogue_counters_of_nothing(spark):
    empty = spark.createDataFrame([], RECORD)
    counters = stops.catalogue_counters(empty, empty.drop("position")).first()
    assert counters["coordinate_coverage_percentage"] == 0.0


def catalogue(spark, *refs):
    return spark.createDataFrame(
        [(r, f"name {r}", "", "", "", "0", "x", "f") for r in refs], STOP_CATALOGUE
    )


def test_register_files_are_matched(spark, tmp_path):
    (tmp_path / "area_140.csv").write_bytes(
        "﻿ATCOCode,CommonName,Latitude,Longitude,StopType\n"
        "140A,First,50.1,0.1,BCT\n140A,Last,50.2,0.2,BCS\n140X,Elsewhere,1,1,BCT\n"
        "140B,Bad place,far,200,BCT\n".encode()
    )
    register = stops.normalise_register(tables.read_register(spark, str(tmp_path)))
    cat = catalogue(spark, "140A", "140B", "140C")
    kept = stops.register_rows_in_catalogue(register, cat)
    assert kept.count() == 3
    matched = stops.match_register(cat, register, ["row_order"])
    assert matched.columns == STOPS.fieldNames()
    found = {r["stop_ref"]: r for r in matched.collect()}
    assert set(found) == {"140A", "140B"}
    assert found["140A"]["naptan_common_name"] == "Last"
    assert found["140A"]["timetable_common_name"] == "name 140A"
    assert (found["140A"]["latitude"], found["140A"]["atco_area_code"]) == (50.2, "140")
    assert (found["140B"]["latitude"], found["140B"]["has_coordinates"]) == (None, 0)
    assert found["140B"]["town"] == ""
    assert rows(stops.unmatched_stops(cat, matched)) == [("140C", "name 140C")]
    summary = stops.match_summary(cat, register, matched).first()
    assert summary["atco_area_code_list"] == "140"
    assert summary["matched_stop_percentage"] == 66.6667
    assert summary["total_naptan_rows_downloaded"] == 4


@pytest.mark.parametrize("header", ["AtcoCode,commonName", "atcoCode,CommonName"])
def test_header_spellings(spark, tmp_path, header):
    (tmp_path / "r.csv").write_text(header + "\n140A,N\n")
    register = stops.normalise_register(tables.read_register(spark, str(tmp_path)))
    row = register.first()
    assert (row["stop_ref"], row["naptan_common_name"], row["town"]) == ("140A", "N", "")


def test_each_register_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a b_010.csv").write_text("ATCOCode,CommonName,Longitude,Latitude\n010A,Alpha,-0.1,51.1\n")
    (tmp_path / "area_020.csv").write_text("AtcoCode,Longitude,Latitude,CommonName\n020B,-0.2,51.2,Beta\n")
    (tmp_path / "area_030.csv").write_text("status,atcoCode\nactive,\t030C \n")
    (tmp_path / "area_040.csv").write_text("ATCOCode,CommonName,Longitude,Latitude\n040D,Delta,-0.4,51.4\n")
    register = stops.normalise_register(tables.read_register(spark, str(tmp_path)))
    shown = ["stop_ref", "naptan_common_name", "longitude", "latitude", "status", "atco_area_code"]
    assert rows(register.select(*shown)) == [
        ("010A", "Alpha", "-0.1", "51.1", "", "010"),
        ("020B", "Beta", "-0.2", "51.2", "", "020"),
        ("030C", "", "", "", "active", "030"),
        ("040D", "Delta", "-0.4", "51.4", "", "040"),
    ]


def test_one_row_per_stop(spark):
    base = [None] * 12
    full = ["A", "n", "n", "l", "t", 1.0, 1.0, 1, "BCT", "active", "1", "1"]
    df = spark.createDataFrame([tuple(base), ("A", *base[1:]), tuple(full)], STOPS)
    for layout in (df, df.repartition(3)):
        assert [tuple(r) for r in stops.one_row_per_stop(layout).collect()] == [tuple(full)]


# --- joins ---


def sides(spark):
    # one key holds most of the rows
    fact = spark.range(0, 900).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 40).otherwise(F.lit(7)).alias("k"), "id"
    )
    lookup = spark.range(0, 30).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    return fact, lookup


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_split_and_broadcast_joins_agree_with_a_plain_one(spark, how):
    fact, lookup = sides(spark)
    plain = fact.join(lookup, fact["k"] == lookup["key"], how).drop("key")
    broadcast = joins.lookup_join(fact, lookup, {"k": "key"}, how)
    shuffled = joins.lookup_join(fact, lookup, {"k": "key"}, how, row_limit=5)
    uneven = joins.hot_key_join(fact, lookup, {"k": "key"}, how, rows_per_task=20)
    key = lambda r: tuple(-1 if v is None else v for v in r)
    expected = sorted(map(key, plain.collect()))
    for df in (broadcast, shuffled, uneven):
        assert df.columns == plain.columns
        assert sorted(map(key, df.collect())) == expected


def test_null_keys_stay_unmatched(spark):
    fact = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    lookup = spark.createDataFrame([(1, "a"), (None, "b")], "key int, name string")
    found = joins.hot_key_join(fact, lookup, {"k": "key"}, rows_per_task=20)
    assert sorted((r["v"], r["name"]) for r in found.collect()) == [(1, None), (2, None), (3, "a")]


def test_size_decides_the_join(spark):
    fact, lookup = sides(spark)
    assert joins.fits_broadcast(lookup, 30) and not joins.fits_broadcast(lookup, 29)
    small = joins.lookup_join(fact, lookup, {"k": "key"})
    assert inspect.uses_broadcast_join(small) and inspect.exchanges(small) == 0
    large = joins.lookup_join(fact, lookup, {"k": "key"}, row_limit=5)
    assert "_lookup_split" in inspect.plan_text(large, "extended")


def test_hot_keys_are_found_with_their_parts(spark):
    fact, _ = sides(spark)
    count = fact.filter("k = 7").count()
    found = joins.hot_keys(fact, ["k"], rows_per_task=count // 3)
    assert [(r["k"], r["_splits"]) for r in found if r["k"] == 7] == [(7, -(-count // (count // 3)))]
    even = spark.range(0, 1000).select((F.col("id") % 10).alias("k"))
    assert len(joins.hot_keys(even, ["k"], rows_per_task=99)) == 10
    assert joins.hot_keys(even, ["k"], rows_per_task=100) == []


@pytest.mark.parametrize("hot", ["NULL", "3"])
def test_no_partition_gets_a_hot_key_whole(spark, hot):
    """Half of the rows have no key, or one key; adaptive skew handling is off."""
    fact = spark.range(0, 40_000).selectExpr(
        f"CASE WHEN id % 2 = 0 THEN CAST({hot} AS BIGINT) ELSE id END AS k", "id"
    )
    lookup = spark.range(0, 40_000, 3).select(F.col("id").alias("key"), F.lit("x").alias("v"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        joined = joins.hot_key_join(fact, lookup, {"k": "key"}, "left", rows_per_task=400)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * 40_000 / 8


def test_a_hot_key_is_spread_the_same_way_each_time(spark):
    fact, _ = sides(spark)
    hot = fact.filter("k = 7").withColumn("split", F.pmod(F.xxhash64("k", "id"), F.lit(16)))
    once = rows(hot.groupBy("split").count())
    assert len(once) == 16 and once == rows(hot.repartition(5).groupBy("split").count())


# --- enrichment ---


def test_enrichment_keeps_unmatched_rows(spark, network):
    enriched = enrichment.enrich_segments(network.raw, network.stops)
    assert len(enriched.columns) == 20 + 14 + 6
    assert enriched.count() == network.raw.count()
    gaps = enriched.filter("both_stops_matched = 0")
    assert gaps.filter("distance_km IS NOT NULL OR distance_band != 'Missing'").count() == 0
    assert enriched.filter("from_stop_ref = to_stop_ref AND distance_km > 0").count() == 0


def test_enrichment_is_the_same_by_shuffle(spark, network):
    columns = ["vehicle_timing_link_id", "origin_stop_name", "destination_town", "distance_band"]
    small = enrichment.enrich_segments(network.raw, network.stops).select(*columns)
    large = enrichment.enrich_segments(network.raw, network.stops, row_limit=1).select(*columns)
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0


def test_summary_and_counters(spark, network):
    summary = enrichment.feature_summary(network.enriched).first()
    assert summary["enriched_segment_records"] == network.segments.count()
    assert summary["both_stops_matched_records"] + summary["missing_distance_records"] == (
        summary["enriched_segment_records"]
    )
    assert summary["minimum_distance_km"] <= summary["median_distance_km"] <= summary["maximum_distance_km"]
    assert enrichment.unmatched_segments(network.enriched).count() == summary["missing_distance_records"]
    assert stops.stop_counters(network.stops).first()["naptan_stop_records"] == network.stops.count()
