from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from timelegs.operators import analytics, cleaning, profiling
from timelegs.schemas import CLEANED_EXTRA, RAW_SEGMENTS


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_SEGMENTS)


def cases(raw_row):
    return [
        raw_row(),
        raw_row(),  # exact duplicate
        raw_row(vehicle_journey_code="blank", line_ref="  "),
        raw_row(vehicle_journey_code="null", departure_time=None),
        raw_row(vehicle_journey_code="zero", runtime_seconds=0, runtime_minutes=0.0),
        raw_row(vehicle_journey_code="none", runtime_seconds=None, runtime_minutes=None),
        raw_row(vehicle_journey_code="order", to_sequence=1),
        raw_row(vehicle_journey_code="same", to_stop_ref="100A"),
        raw_row(vehicle_journey_code="two", runtime_seconds=0, to_stop_ref="100A"),
        raw_row(vehicle_journey_code="late", departure_time="bad"),
    ]


def test_funnel_counts_overlapping_defects(spark, raw_row):
    found = cleaning.quality_funnel(frame(spark, cases(raw_row))).first().asDict()
    assert found == {
        "raw_records": 10,
        "duplicates_removed": 1,
        "missing_required_records_removed": 2,
        "zero_runtime_records": 2,
        "invalid_sequence_records": 1,
        "identical_stop_records": 2,
        "final_cleaned_records": 2,
        "total_records_removed": 8,
    }


def test_clean_keeps_the_valid_rows_with_features(spark, raw_row):
    rows = cleaning.clean_segments(frame(spark, cases(raw_row))).collect()
    assert {r["vehicle_journey_code"] for r in rows} == {"VJ1", "late"}
    late = next(r for r in rows if r["vehicle_journey_code"] == "late")
    assert (late["departure_hour"], late["is_peak_hour"], late["time_of_day"]) == (None, 0, "Night")
    good = next(r for r in rows if r["vehicle_journey_code"] == "VJ1")
    assert (good["departure_hour"], good["is_peak_hour"], good["segment_key"]) == (8, 1, "100A_100B")


def test_cleaned_layout(spark, raw_row):
    flagged = cleaning.cleaned_and_flagged(frame(spark, [raw_row()]))
    assert flagged.columns == RAW_SEGMENTS.fieldNames() + CLEANED_EXTRA.fieldNames()
    assert len(flagged.columns) == 25


def test_empty_input(spark):
    funnel = cleaning.quality_funnel(frame(spark, [])).first()
    assert funnel["raw_records"] == 0 and funnel["total_records_removed"] == 0
    assert cleaning.cleaned_and_flagged(frame(spark, [])).count() == 0


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["L1", "", None]),
            st.sampled_from([0, 60, 300, None]),
            st.sampled_from([1, 2]),
            st.sampled_from(["100A", "100B"]),
        ),
        max_size=30,
    )
)
def test_funnel_identity(spark, raw_row, picks):
    rows = [
        raw_row(line_ref=a, runtime_seconds=b, to_sequence=c, to_stop_ref=d) for a, b, c, d in picks
    ]
    raw = frame(spark, rows)
    f = cleaning.quality_funnel(raw).first()
    assert f["raw_records"] - f["total_records_removed"] == f["final_cleaned_records"]
    once = cleaning.drop_exact_duplicates(raw)
    assert sorted(map(str, cleaning.drop_exact_duplicates(once).collect())) == sorted(
        map(str, once.collect())
    )
    assert cleaning.clean_segments(raw).count() == f["final_cleaned_records"]


def test_fence_and_flag(spark):
    df = spark.createDataFrame([(float(i),) for i in (1, 1, 2, 2, 2, 3, 9)], "runtime_minutes double")
    fence = cleaning.iqr_fence(df)
    row = fence.first()
    assert (row["q1"], row["q3"], row["upper_limit"]) == (1.0, 3.0, 6.0)
    flagged = cleaning.flag_high_durations(df, fence)
    assert [r["runtime_minutes"] for r in flagged.filter("is_iqr_high_duration = 1").collect()] == [9.0]


def test_profile(spark, raw_row):
    raw = frame(spark, cases(raw_row))
    missing = profiling.missing_counts(raw).first()
    assert (missing["line_ref"], missing["departure_time"], missing["runtime_seconds"]) == (1, 1, 1)
    quality = profiling.runtime_quality(raw).first()
    assert tuple(quality) == (7, 2, 1)
    coverage = profiling.coverage(raw).first().asDict()
    assert coverage == {"unique_journeys": 9, "unique_routes": 2, "unique_stops": 2}
    assert profiling.runtime_summary(raw).first()["p50"] == 2.0


def test_even_groups(spark):
    rows = profiling.even_group_counts(spark.range(0, 100)).collect()
    assert [tuple(r) for r in rows] == [(g, 10) for g in (0, 2, 4, 6, 8)]


def test_distinct_counts_skip_incomplete_pairs(spark, raw_row):
    rows = [raw_row(), raw_row(vehicle_journey_code=None), raw_row(source_file=None)]
    df = cleaning.add_time_features(frame(spark, rows)).withColumn("is_iqr_high_duration", F.lit(0))
    assert analytics.distinct_counts(df).first()["unique_vehicle_journeys"] == 1


def test_reports_order_and_limits(spark, network):
    periods = [r["time_of_day"] for r in analytics.time_of_day_summary(network.segments).collect()]
    assert periods == ["Morning", "Afternoon", "Evening", "Night"]
    kinds = [r["period_type"] for r in analytics.peak_summary(network.segments).collect()]
    assert kinds == ["Peak", "Off-peak"]
    routes = analytics.route_summary(network.segments).collect()
    counts = [r["record_count"] for r in routes]
    assert counts == sorted(counts, reverse=True)
    assert sum(counts) == network.segments.count()
    assert analytics.longest_segments(network.segments, 7).count() == 7


def test_histogram_covers_every_row_and_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(81)], "v double")
    rows = analytics.equal_width_histogram(df, "v", 40).collect()
    assert [r["record_count"] for r in rows] == [2] * 39 + [3]
    flat = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    assert [tuple(r)[::3] for r in analytics.equal_width_histogram(flat, "v").collect()] == [(0, 2)]


def test_quantile_is_exact_below_its_accuracy(spark):
    df = spark.range(1, 1000).selectExpr("CAST(id AS DOUBLE) AS v")
    found = profiling.quantiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.99}).first()
    assert tuple(found) == (250.0, 500.0, 990.0)


@pytest.mark.parametrize("rows", [3, 50])
def test_preview_is_repeatable(spark, network, rows):
    columns = ["vehicle_timing_link_id", "runtime_minutes"]
    first = profiling.preview(network.raw, columns, columns, rows).collect()
    again = profiling.preview(network.raw.repartition(7), columns, columns, rows).collect()
    assert first == again and len(first) == rows


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_few_duplicates_are_dropped_without_shuffling_whole_rows(spark, raw_row, monkeypatch, limit):
    rows = [raw_row(vehicle_timing_link_id=f"VL{i}", runtime_iso=None if i % 3 else "PT2M") for i in range(40)]
    raw = frame(spark, rows + rows[:3] + rows[:1])
    monkeypatch.setattr(cleaning, "BROADCAST_ROW_LIMIT", limit)
    once = cleaning.drop_few_duplicates(raw)
    assert sorted(map(str, once.collect())) == sorted(map(str, raw.distinct().collect())) and once.count() == 40
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftAnti" in plan) == (limit > 0)  # unique rows pass by the aggregate
    got = cleaning.clean_mostly_unique(raw).orderBy("vehicle_timing_link_id").collect()
    assert got == cleaning.clean_segments(raw).orderBy("vehicle_timing_link_id").collect()
