"""The stages one after the other, from documents to serving tables."""

from __future__ import annotations

import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from timelegs.operators import cleaning, modelling, quality, serving
from timelegs.plans import batch, inspect
from timelegs.sources import snapshots, tables


def document(file_number: int) -> str:
    """A small network: a ring of stops, journeys around it with run times by distance."""
    stops = [f"1{file_number % 2}0{i:02d}" for i in range(12)]
    parts = [
        f"<AnnotatedStopPointRef><StopPointRef>{s}</StopPointRef><CommonName>Stop {s}</CommonName>"
        "</AnnotatedStopPointRef>"
        for s in stops
    ]
    for i in range(11):
        parts.append(
            f'<JourneyPatternTimingLink id="J{i}"><From SequenceNumber="{i + 1}"><StopPointRef>{stops[i]}'
            f'</StopPointRef></From><To SequenceNumber="{i + 2}"><StopPointRef>{stops[i + 1]}'
            "</StopPointRef></To></JourneyPatternTimingLink>"
        )
    for v in range(30):
        links = "".join(
            f'<VehicleJourneyTimingLink id="{v}_{i}"><JourneyPatternTimingLinkRef>J{i}'
            f"</JourneyPatternTimingLinkRef><RunTime>PT{(i % 4) + v % 2}M</RunTime></VehicleJourneyTimingLink>"
            for i in range(11)
        )
        parts.append(
            f"<VehicleJourney><VehicleJourneyCode>V{v}</VehicleJourneyCode><LineRef>L{v % 3}</LineRef>"
            f"<DepartureTime>{v % 26:02d}:00:00</DepartureTime>{links}</VehicleJourney>"
        )
    return f'<TransXChange xmlns="urn:t">{"".join(parts)}</TransXChange>'


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("batch")
    xml, register = base / "xml", base / "register"
    xml.mkdir()
    register.mkdir()
    for n in range(3):
        (xml / f"f{n}.xml").write_text(document(n))
    for area in (100, 110):
        lines = ["ATCOCode,CommonName,Latitude,Longitude,StopType,Status"]
        lines += [f"{area}{i:02d},N{i},{50 + 0.004 * i * i},{0.001 * i},BCT,active" for i in range(12)]
        (register / f"area_{area}.csv").write_text("\n".join(lines) + "\n")
    out = batch.Layout(str(base / "out"))
    raw = batch.extract(spark, str(xml), out)
    batch.extract_stop_catalogue(spark, str(xml), out)
    stops = batch.match_stops(spark, str(register), out)
    segments = batch.clean(spark, raw, out)
    enriched = batch.enrich(spark, segments, stops, out)
    return {"out": out, "raw": raw, "stops": stops, "segments": segments, "enriched": enriched}


def test_rows_through_the_stages(spark, run):
    assert run["raw"].count() == 3 * 30 * 11
    funnel = cleaning.quality_funnel(run["raw"]).first()
    assert run["segments"].count() == funnel["final_cleaned_records"] == run["enriched"].count()
    assert len(run["segments"].columns) == 25 and len(run["enriched"].columns) == 45
    assert run["enriched"].filter("both_stops_matched = 0").count() == 0
    stops = {r["stop_ref"]: r for r in run["stops"].collect()}
    assert stops["10003"]["timetable_common_name"] == "Stop 10003"
    assert stops["11003"]["atco_area_code"] == "110"


def test_cleaning_shuffles_the_rows_once(spark, run):
    flagged = cleaning.cleaned_and_flagged(run["raw"])
    flagged.collect()
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_enriching_does_not_shuffle_the_segments(run):
    plan = inspect.plan_text(run["enriched"], "simple")
    assert inspect.exchanges(run["enriched"]) == 0, plan


def report(spark, run, name):
    return tables.metrics_record(
        tables.read_metrics(spark, run["out"].at(f"reports/{name}"))
    ).first().asDict()


def test_reports(spark, run):
    batch.write_reports(spark, run["out"])
    cleaned = report(spark, run, "data_cleaning_summary")
    assert int(cleaned["raw_records"]) - int(cleaned["total_records_removed"]) == run["segments"].count()
    assert report(spark, run, "eda_summary")["record_count"] == cleaned["final_cleaned_records"]
    assert report(spark, run, "feature_engineering_summary")["both_stops_match_percentage"] == "100.0"
    read = spark.read.option("header", True)
    routes = read.csv(run["out"].at("reports/route_runtime_summary"))
    assert routes.count() == 3 and len(routes.columns) == 11
    assert read.csv(run["out"].at("reports/peak_hour_summary")).columns[0] == "period_type"
    sample = read.csv(run["out"].at("reports/enriched_segment_sample"))
    assert sample.count() == 100 and len(sample.columns) == 16


def test_training_and_serving(spark, run, monkeypatch):
    io = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}
    monkeypatch.setattr(
        modelling,
        "candidates",
        lambda: [modelling.Candidate("Tree", "dt", DecisionTreeRegressor(maxDepth=4, seed=1, **io))],
    )
    comparison = batch.train(spark, run["enriched"], run["out"])
    assert report(spark, run, "best_model_summary")["best_model_name"] == "Tree"
    assert report(spark, run, "model_split_summary")["overlapping_segments"] == "0"
    anomalies = report(spark, run, "model_anomaly_summary")
    assert float(anomalies["residual_threshold"]) >= 0
    top = spark.read.option("header", True).csv(run["out"].at("reports/top_model_anomalies"))
    assert top.count() == min(100, int(anomalies["model_anomaly_records"]))
    results = tables.read_parquet(spark, run["out"].at("model_results"))
    predictions = tables.read_parquet(spark, run["out"].at("test_predictions"))
    loaded = batch.load_serving(
        spark,
        run["stops"],
        run["enriched"],
        results,
        predictions,
        comparison.best_name,
        run["out"],
    )
    assert loaded["segments"].count() == run["enriched"].count()
    assert loaded["predictions"].count() == results.first()["testing_records"]
    for table, keys in quality.PRIMARY_KEYS.items():
        assert quality.pk_violations(loaded[table], keys).count() == 0
        nulls = quality.null_violations(loaded[table], quality.NOT_NULL[table]).first()
        assert set(nulls) == {0}
        broken = quality.check_violations(loaded[table], quality.RULES[table]).first()
        assert set(broken) == {0}
    assert {r["orphan_rows"] for r in quality.fk_violations(loaded).collect()} == {0}
    assert quality.invalid_segments(loaded["segments"]).first()[0] == 0
    kpis = serving.run_query(spark, "overview_kpis", loaded).first()
    assert kpis["segment_records"] == loaded["segments"].count()
    assert serving.run_query(spark, "best_model", loaded).first()["model_name"] == "Tree"
    counts = {r[0]: r[1] for r in serving.table_counts(loaded).collect()}
    assert counts["model_results"] == 1
    for table in quality.NUMBERED:
        key = quality.PRIMARY_KEYS[table][0]
        n, least, greatest, distinct = loaded[table].agg(F.count("*"), F.min(key), F.max(key), F.count_distinct(key)).first()
        assert (least, greatest, distinct) == (1, n, n)
    batch.write_serving_reports(spark, run["out"])
    shown = {r["table_name"]: int(r["row_count"]) for r in spark.read.option("header", True).csv(run["out"].at("reports/database_summary")).collect()}
    assert shown == counts
    injected = spark.read.option("header", True).csv(run["out"].at("reports/injection_check")).first()
    assert injected["sql_injection_prevented"] == "true"
    statements = spark.read.text(run["out"].at("reports/sample_data")).count()
    assert statements == sum(min(5, n) for n in counts.values())
    far = run["stops"].withColumn("latitude", F.lit(91.0))
    with pytest.raises(quality.ConstraintError, match="stops.latitude_range"):
        batch.load_serving(
            spark, far, run["enriched"], results, predictions, comparison.best_name, run["out"]
        )
    published = batch.published_serving(spark, run["out"])["stops"]
    assert published.filter("latitude > 90").count() == 0 and published.count() > 0
    with pytest.raises(ValueError, match="not among"):
        batch.load_serving(
            spark, run["stops"], run["enriched"], results, predictions, "Other", run["out"]
        )


def test_a_set_is_published_by_its_pointer(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "tables")

    def write(value):
        folder = snapshots.new_set(base)
        spark.range(value).write.parquet(f"{folder}/t")
        return folder

    def rows():
        return spark.read.parquet(snapshots.published(spark, base) + "/t").count()

    with pytest.raises(FileNotFoundError, match="nothing has been published"):
        snapshots.published(spark, base)
    snapshots.publish(spark, base, write(1))
    lost = write(2)  # a publisher that fails between the write and the pointer
    assert rows() == 1
    pointers = tmp_path / "tables" / "_pointers"
    (pointers / "0000000002").write_text(lost.rsplit("/", 1)[1])  # one that fails within the pointer
    assert rows() == 1
    snapshots.publish(spark, base, write(3))
    assert rows() == 3
    late = snapshots._pointers  # a publisher that doesn't see the latest pointer takes the next number
    monkeypatch.setattr(snapshots, "_pointers", lambda *a: late(*a)[1:])
    snapshots.publish(spark, base, write(4))
    monkeypatch.undo()
    assert rows() == 4
    snapshots.prune(spark, base, keep=2)
    assert rows() == 4 and len(snapshots._pointers(spark, base)) == 2
    assert sorted(p.name for p in (tmp_path / "tables" / "sets").iterdir()) != []


def test_settings_grow_with_the_input():
    from timelegs.plans.session import settings

    small, large = settings(10_000, 8), settings(100 * 1024**4, 4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(large["spark.sql.shuffle.partitions"]) == 100 * 1024**4 * 3 // (128 * 1024**2)


@pytest.fixture
def checkpoint_folder(spark):
    """The shared folder that the session names, as a cluster does."""
    return spark.conf.get("spark.checkpoint.dir")


def test_stage_tables_go_to_the_shared_folder(spark, checkpoint_folder):
    from timelegs.sources.stage import stage

    builds = []

    def build():
        builds.append(1)
        return spark.range(5)

    first = stage(f"test {checkpoint_folder}", build)
    again = stage(f"test {checkpoint_folder}", build)
    assert first.count() == again.count() == 5 and len(builds) == 1
    assert checkpoint_folder in first.inputFiles()[0]


def test_training_rows_are_checkpointed_when_a_folder_is_named(spark, run, checkpoint_folder):
    data = modelling.prepare(run["enriched"])
    try:
        assert "ExistingRDD" in data.train._jdf.queryExecution().logical().toString() or (
            "LogicalRDD" in data.train._jdf.queryExecution().logical().toString()
        )
        names = modelling.feature_names(data.train)
        assert len(names) == data.train.first()["features"].size
    finally:
        data.release()
