from __future__ import annotations

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from timelegs.functions import clock, durations, geo, measures, text
from timelegs.registry import QUERIES


def values(spark, rows, ddl, *columns):
    df = spark.createDataFrame(rows, ddl)
    return [tuple(r) for r in df.select(*columns).collect()]


def one(spark, value, expression, kind="string"):
    return values(spark, [(value,)], f"v {kind}", expression("v"))[0][0]


@pytest.mark.parametrize(
    "iso, seconds",
    [
        ("PT2M30S", 150),
        ("PT1H", 3600),
        ("PT", 0),
        ("PT0S", 0),
        (" PT5M ", 300),
        ("PT1H2M3S", 3723),
        ("PT1H30", None),
        ("PT1.5S", None),
        ("P1D", None),
        ("", None),
        (None, None),
        ("-PT5M", None),
        ("PT99999999999999999999S", None),
    ],
)
def test_duration_seconds(spark, iso, seconds):
    assert one(spark, iso, durations.duration_seconds) == seconds


@pytest.mark.parametrize(
    "iso, kind",
    [(None, "missing"), (" ", "missing"), ("P1D", "invalid"), ("PT0M", "zero"), ("PT1S", "positive")],
)
def test_runtime_class(spark, iso, kind):
    assert one(spark, iso, durations.runtime_class) == kind


def test_minutes_are_rounded_to_three_places(spark):
    assert one(spark, 100, durations.seconds_to_minutes, "int") == 1.667


@pytest.mark.parametrize(
    "time, hour",
    [("24:05:00", 0), ("7:00:00", 7), ("bad", None), ("26:10:00", 2), ("100:00", None), ("", None)],
)
def test_departure_hour(spark, time, hour):
    assert one(spark, time, clock.departure_hour) == hour


def test_hour_edges(spark):
    hours = [4, 5, 6, 7, 9, 10, 11, 12, 15, 16, 17, 18, 19, 21, 22, None]
    found = values(
        spark, [(h,) for h in hours], "h int", "h", clock.is_peak("h"), clock.time_of_day("h")
    )
    peak = {h for h, p, _ in found if p == 1}
    assert peak == {7, 9, 16, 17, 18}
    period = {h: t for h, _, t in found}
    assert period[4] == period[22] == period[None] == "Night"
    assert period[5] == period[11] == "Morning"
    assert period[12] == period[16] == "Afternoon"
    assert period[17] == period[21] == "Evening"


def km(spark, *points):
    return values(
        spark,
        points,
        "a double, b double, c double, d double",
        geo.haversine_km("a", "b", "c", "d"),
    )


def test_known_distance_and_its_band(spark):
    # A published pair of stops: 162.68 m apart.
    [(distance,)] = km(spark, (50.8554662, 0.5592296, 50.8540424, 0.5597627))
    assert distance == pytest.approx(0.1626820704766919, abs=1e-12)
    assert one(spark, distance, geo.distance_band, "double") == "Under 0.25 km"


def test_distance_needs_all_four_coordinates(spark):
    rows = km(spark, (None, 0.0, 1.0, 1.0), (1.0, 0.0, 1.0, None), (1.0, 1.0, 1.0, 1.0))
    assert rows == [(None,), (None,), (0.0,)]


def test_antipodes_do_not_leave_the_domain(spark):
    [(half,)] = km(spark, (0.0, 0.0, 0.0, 180.0))
    assert half == pytest.approx(math.pi * geo.EARTH_RADIUS_KM)


points = st.tuples(st.floats(-90, 90), st.floats(-180, 180))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(points, points), min_size=1, max_size=20))
def test_distance_is_symmetric_and_bounded(spark, pairs):
    there = km(spark, *[(*a, *b) for a, b in pairs])
    back = km(spark, *[(*b, *a) for a, b in pairs])
    for (x,), (y,) in zip(there, back):
        assert x == pytest.approx(y, abs=1e-6)
        assert 0.0 <= x <= math.pi * geo.EARTH_RADIUS_KM + 1e-6


@pytest.mark.parametrize(
    "km_value, band",
    [
        (None, "Missing"),
        (0.0, "Zero"),
        (0.2499, "Under 0.25 km"),
        (0.25, "0.25-0.50 km"),
        (0.5, "0.50-1.00 km"),
        (1.0, "1.00-2.00 km"),
        (2.0, "2.00 km or more"),
    ],
)
def test_distance_bands(spark, km_value, band):
    assert one(spark, km_value, geo.distance_band, "double") == band


@pytest.mark.parametrize(
    "shown, number",
    [
        ("0.0", 0.0),
        ("91", None),
        ("-90", -90.0),
        ("abc", None),
        ("", None),
        ("NaN", None),
        ("1d", None),
        (" 50.5 ", 50.5),
        ("5e1", 50.0),
        (None, None),
    ],
)
def test_valid_coordinate(spark, shown, number):
    assert one(spark, shown, lambda c: geo.valid_coordinate(c, geo.LATITUDE_LIMIT)) == number


def test_text_helpers(spark):
    rows = [("  ", "b", None), (None, " x ", "TRUE "), ("a", "", "no")]
    found = values(
        spark,
        rows,
        "a string, b string, c string",
        text.first_non_blank("a", "b", default="?"),
        text.segment_key("a", "b"),
        text.text_is_true("c"),
        text.completeness(["a", "b", "c"]),
    )
    assert found == [("b", "  _b", False, 1), ("x", " x ", True, 2), ("a", "a_", False, 2)]


def test_area_code(spark):
    rows = [("140ABC",), ("A140",), ("14",), (None,)]
    found = values(spark, rows, "r string", text.area_code("r"))
    assert found == [("140",), ("",), ("",), (None,)]


def test_sql_literals(spark):
    df = spark.createDataFrame(
        [("O'Brien", 1, 2.5, True), (None, None, None, None)], "s string, i int, d double, b boolean"
    )
    shown = df.select(*[text.sql_literal(f.name, f.dataType.simpleString()) for f in df.schema.fields])
    assert [tuple(r) for r in shown.collect()] == [
        ("'O''Brien'", "1", "2.5", "1"),
        ("NULL", "NULL", "NULL", "NULL"),
    ]


def test_minutes_label(spark):
    found = values(spark, [(1.25,), (None,)], "m double", text.minutes_label("m"))
    assert found == [("1.250 min",), ("N/A",)]


def test_percentage_of_nothing_is_zero(spark):
    found = values(
        spark, [(1, 3), (0, 0)], "a int, b int", measures.percentage(F.col("a"), F.col("b"))
    )
    assert found == [(33.3333,), (0.0,)]


def test_white_space_of_every_kind_is_stripped(spark):
    df = spark.createDataFrame([("\t\n", "\u00a0Alpha \r\n")], "a string, b string")
    assert df.select(text.first_non_blank("a", "b")).first()[0] == "Alpha"


@pytest.mark.parametrize("n", [1, 10_000, 3_000_000])
def test_exact_quantile_is_exact_at_every_size(spark, n):
    df = spark.range(n).select((F.pmod(F.col("id") * 7919, F.lit(n)) * 0.5).alias("x"))
    for p in (0.0, 0.5, 0.95, 1.0):
        assert measures.exact_quantile(df, "x", p) == (max(1, math.ceil(p * n)) - 1) * 0.5


def test_exact_quantile_of_ties_and_gaps(spark):
    df = spark.createDataFrame([(None,)] + [(1.0,)] * 6 + [(2.0,)] * 3 + [(9.0,)], "x double")
    assert [measures.exact_quantile(df, "x", p) for p in (0.1, 0.6, 0.61, 0.9, 0.95)] == [1.0, 1.0, 2.0, 2.0, 9.0]
    assert measures.exact_quantile(df.filter("x > 10"), "x", 0.5) is None


def test_exact_quantiles_of_every_kind_of_number(spark):
    rng = random.Random(4)
    odd = [0.0, -0.0, float("inf"), float("-inf"), 5e-324, -5e-324, 1.7e308, -1.7e308]
    values = odd + [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e-300), rng.gauss(0, 1e300), float(rng.randrange(3))]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(5)
    points = {f"p{i}": i / 10 for i in range(11)}
    got = measures.exact_quantiles(df, "x", points).first().asDict()
    assert got == {k: sorted(values)[max(1, math.ceil(p * len(values))) - 1] for k, p in points.items()}
    none = measures.exact_quantiles(df.filter("x IS NULL"), "x", points).first()
    assert set(none) == {None}


def test_kth_smallest(spark):
    values = [5, -(2**63), 2**63 - 1, 0, -1, 5]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    got = [measures.kth_smallest(df, "x", k).first()[0] for k in (1, 2, 4, 5, 6, 9)]
    assert got == [-(2**63), -1, 5, 5, 2**63 - 1, 2**63 - 1]


def test_exact_quantiles_take_four_scans(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("double").alias("x")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = measures.exact_quantiles(df, "x", {"a": 0.5, "b": 0.9, "c": 0.99})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 4


def test_distances_have_the_bits_of_the_written_formula(spark):
    """Equal distances of the network's grid differ in their last bit; an order by distance shows it."""
    import duckdb

    steps = [(50.0 + a * 0.0001, b * 0.0001, 50.0 + c * 0.0001, d * 0.0001) for a in range(0, 97, 19) for b in range(0, 89, 23) for c in range(0, 97, 13) for d in range(0, 89, 17)]
    df = spark.createDataFrame(steps, "a double, b double, c double, d double")
    got = df.select("a", "b", "c", "d", geo.haversine_km("a", "b", "c", "d").alias("km")).toPandas()
    wanted = duckdb.sql(
        """SELECT 2 * 6371.0088 * asin(sqrt(sin(radians(c - a) / 2) * sin(radians(c - a) / 2)
             + cos(radians(a)) * cos(radians(c)) * sin(radians(d - b) / 2) * sin(radians(d - b) / 2))) AS km, km AS got FROM got"""
    ).fetchall()
    assert sum(1 for km, mine in wanted if km != mine) == 0


def test_sums_of_squares_beyond_a_bigint_are_exact(spark, tmp_path):
    def counts(name, keys):
        rows = spark.createDataFrame([(k,) for k in keys], "l_orderkey bigint")
        rows.write.parquet(str(tmp_path / name / "lineitem.parquet"))
        return QUERIES["modulo_counts"](spark, str(tmp_path / name))

    far = 3_000_000_001  # its square fits into 63 bits, two of them don't
    large = counts("large", [far, far, 4, None])
    assert {r["group_number"]: (r["row_count"], r["even_rows"], r["sum_of_squares"]) for r in large.collect()} == {1: (2, 0, 2 * far * far), 4: (1, 1, 16), None: (1, 0, None)}
    small = counts("small", [far, 4, 14])
    assert dict(small.dtypes)["sum_of_squares"] == "bigint"
    assert [tuple(r) for r in small.collect()] == [(1, 1, 0, far * far), (4, 2, 2, 16 + 196)]
    assert counts("none", []).collect() == []
