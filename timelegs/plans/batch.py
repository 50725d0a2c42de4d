"""The stages as they run on a cluster: each writes a table that the next one reads.

A written table cuts the lineage between stages, lets the next stage prune columns and
row groups, and survives the loss of any executor.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession

from timelegs.operators import (
    analytics,
    cleaning,
    enrichment,
    modelling,
    serving,
    shredding,
    stops,
)
from timelegs.operators.quality import RULES, key_exists, require_constraints, rule_counts
from timelegs.operators.records import beside
from timelegs.sources import journeys_xml, sinks, snapshots, tables, xml_elements
from timelegs.sources.stage import remove_folder


@dataclass(frozen=True)
class Layout:
    """Where the stages keep their tables below one base path."""

    base: str

    def at(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"


def parse(spark: SparkSession, xml_path: str, out: Layout) -> DataFrame:
    """Documents to the elements that the stages ask for, by one pass over each document.

    The table is laid out by element, so a stage reads no other elements than its own.
    """
    journeys_xml.require_documents(spark, xml_path)
    elements = xml_elements.read_elements(spark, xml_path)
    sinks.write_parquet(elements, out.at("elements"), partition_by=["tag"])
    return tables.read_parquet(spark, out.at("elements"))


def _parsed(spark: SparkSession, source: str | DataFrame, out: Layout) -> DataFrame:
    return parse(spark, source, out) if isinstance(source, str) else source


def extract(spark: SparkSession, source: str | DataFrame, out: Layout) -> DataFrame:
    """Documents to raw segments. ``source`` is their path, or what ``parse`` made of them.

    The legs and links are written first; the join then reads them as often as it needs. The
    counters of the extraction are observed on the write; they and the profiles of run times
    are written as reports.
    """
    elements = _parsed(spark, source, out)
    sinks.write_parquet(shredding.journey_legs(elements), out.at("parsed_legs"), allow_empty=True)
    sinks.write_parquet(shredding.pattern_links(elements), out.at("parsed_links"), allow_empty=True)
    legs = spark.read.parquet(out.at("parsed_legs"))
    links = spark.read.parquet(out.at("parsed_links"))
    joined = shredding.join_links(legs, shredding.link_lookup(links))
    observed = Observation()
    counted = joined.observe(observed, *shredding.leg_counts())
    sinks.write_parquet(shredding.to_raw_segments(counted), out.at("raw_segments"))
    raw = tables.read_parquet(spark, out.at("raw_segments"))
    documents = xml_elements.document_counters(elements)
    reports = {
        "extraction_summary": beside(documents, spark.createDataFrame([Row(**observed.get)])),
        "pattern_link_profile": shredding.link_runtime_profile(links),
        "vehicle_journey_profile": shredding.journey_runtime_profile(legs),
    }
    for name, record in reports.items():
        sinks.write_metrics(record, out.at(f"reports/{name}"))
    sinks.write_csv(shredding.positive_runtime_examples(legs), out.at("reports/runtime_examples"))
    return raw


def extract_stop_catalogue(spark: SparkSession, source: str | DataFrame, out: Layout) -> DataFrame:
    """Documents to one record per stop. Ties go to the earlier document, and within one to the
    stop that stands first. ``source`` is their path, or what ``parse`` made of them."""
    elements = _parsed(spark, source, out)
    records = shredding.stop_records(elements)
    catalogue = stops.best_stop_records(records, ["position.path", "position.row"])
    sinks.write_parquet(catalogue, out.at("stop_catalogue"))
    written = tables.read_parquet(spark, out.at("stop_catalogue"))
    counters = beside(xml_elements.document_counters(elements), stops.catalogue_counters(records, written))
    sinks.write_metrics(counters, out.at("reports/stop_catalogue_summary"))
    return written


def match_stops(spark: SparkSession, register_path: str, out: Layout) -> DataFrame:
    """Catalogue and register to the stop dimension."""
    catalogue = tables.read_parquet(spark, out.at("stop_catalogue"))
    register = stops.normalise_register(tables.read_register(spark, register_path))
    sinks.write_parquet(stops.match_register(catalogue, register, ["row_order"]), out.at("stops"))
    return tables.read_parquet(spark, out.at("stops"))


def clean(spark: SparkSession, raw: DataFrame, out: Layout) -> DataFrame:
    """Raw to cleaned segments, in one job and one write.

    The rows are shuffled once, for de-duplication. The fence is a scalar subquery over the
    same exchange, which Spark reuses, so it costs a second read of the shuffle files and
    neither a second scan nor a staged table.
    """
    sinks.write_parquet(cleaning.cleaned_and_flagged(raw), out.at("segments_cleaned"))
    return tables.read_parquet(spark, out.at("segments_cleaned"))


def enrich(spark: SparkSession, segments: DataFrame, stop_rows: DataFrame, out: Layout) -> DataFrame:
    enriched = enrichment.enrich_segments(segments, stops.one_row_per_stop(stop_rows))
    sinks.write_parquet(enriched, out.at("segments_enriched"))
    return tables.read_parquet(spark, out.at("segments_enriched"))


def train(spark: SparkSession, enriched: DataFrame, out: Layout) -> modelling.Comparison:
    """Compare the models; write the comparison, the scored test rows of the best model,
    its features by importance, and the summaries."""
    data = modelling.prepare(enriched)
    try:
        split = modelling.require_split(modelling.split_summary(data.train, data.test))
        comparison = modelling.compare_models(data)
        sinks.write_parquet(comparison.results, out.at("model_results"))
        threshold = modelling.training_threshold(comparison.best_model, data)
        scored = modelling.score(comparison.best_model, data, threshold)
        sinks.write_parquet(scored, out.at("test_predictions"), expected_rows=data.test.count())
        importance = modelling.feature_importance(
            comparison.best_model, modelling.feature_names(data.train), spark
        )
        sinks.write_csv(importance, out.at("reports/feature_importance"))
        summary = modelling.best_model_summary(comparison, data)
        sinks.write_metrics(summary, out.at("reports/best_model_summary"))
        sinks.write_metrics(split, out.at("reports/model_split_summary"))
        predictions = tables.read_parquet(spark, out.at("test_predictions"))
        anomalies = beside(modelling.anomaly_summary(predictions), threshold)
        sinks.write_metrics(anomalies, out.at("reports/model_anomaly_summary"))
    finally:
        data.release()
    sinks.write_csv(modelling.top_anomalies(predictions), out.at("reports/top_model_anomalies"))
    return comparison


def write_reports(spark: SparkSession, out: Layout) -> None:
    """The descriptive reports and summaries, as CSV, from the written tables."""
    raw = tables.read_parquet(spark, out.at("raw_segments"))
    segments = tables.read_parquet(spark, out.at("segments_cleaned"))
    enriched = tables.read_parquet(spark, out.at("segments_enriched"))
    fence = cleaning.iqr_fence(segments)
    summaries = {
        "data_cleaning_summary": cleaning.cleaning_summary(raw, segments, fence),
        "eda_summary": analytics.overall_statistics(segments),
        "feature_engineering_summary": enrichment.feature_summary(enriched),
    }
    reports = {
        "runtime_distribution": analytics.runtime_distribution(segments),
        "time_of_day_summary": analytics.time_of_day_summary(segments),
        "peak_hour_summary": analytics.peak_summary(segments),
        "route_runtime_summary": analytics.route_summary(segments),
        "high_duration_route_summary": analytics.high_duration_routes(segments),
        "top_high_duration_segments": analytics.longest_segments(segments),
        "enriched_segment_sample": enrichment.enriched_sample(enriched),
    }
    for name, record in summaries.items():
        sinks.write_metrics(record, out.at(f"reports/{name}"))
    for name, report in reports.items():
        sinks.write_csv(report, out.at(f"reports/{name}"))


def load_serving(
    spark: SparkSession,
    stop_rows: DataFrame,
    enriched: DataFrame,
    results: DataFrame,
    predictions: DataFrame,
    model_name: str,
    out: Layout,
) -> dict[str, DataFrame]:
    """The four serving tables, written with the column that lookups name first leading
    the sort order.

    They are written to a folder of their own, where the rules are checked: those of single rows
    on the write, keys and references on what was written. If any row breaks one, the load stops
    with the counts, and what was published before stays. ``published_serving`` reads them.
    """
    if not key_exists(results, "model_name", model_name).first()["found"]:
        raise ValueError(f"the model is not among the model results: {model_name}")
    segment_rows = serving.serving_segments(enriched)
    prediction_rows = serving.serving_predictions(predictions, model_name)
    loads = {
        "stops": serving.serving_stops(stop_rows),
        "model_results": serving.serving_model_results(results),
        "segments": serving.assign_ids(segment_rows, "segment_id", ["line_ref", "departure_hour"]),
        "predictions": serving.assign_ids(
            prediction_rows, "prediction_id", ["line_ref", "is_model_anomaly"]
        ),
    }
    base = out.at("serving")
    folder = snapshots.new_set(base)
    try:
        measured = {
            name: sinks.write_observed(df, f"{folder}/{name}", rule_counts(name))
            for name, df in loads.items()
        }
        written = {name: tables.read_parquet(spark, f"{folder}/{name}") for name in loads}
        require_constraints(written, measured)
    except BaseException:
        remove_folder(spark, folder)
        raise
    snapshots.publish(spark, base, folder)
    return published_serving(spark, out)


def published_serving(spark: SparkSession, out: Layout) -> dict[str, DataFrame]:
    """The serving tables of the last load that passed."""
    folder = snapshots.published(spark, out.at("serving"))
    return {name: tables.read_parquet(spark, f"{folder}/{name}") for name in RULES}


def write_serving_reports(spark: SparkSession, out: Layout) -> None:
    """Row counts of the published tables, the injection check, and statements for a few rows."""
    loaded = published_serving(spark, out)
    sinks.write_csv(serving.table_counts(loaded), out.at("reports/database_summary"))
    sinks.write_csv(serving.injection_check(spark, loaded["segments"]), out.at("reports/injection_check"))
    sinks.write_statements(serving.sample_export(loaded), out.at("reports/sample_data"))
