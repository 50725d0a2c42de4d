"""Times the batch stages, the reports over their tables, and the training of each model.

Prints one JSON line. ``BENCH_SF_DIR`` names the input, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from timelegs.operators import (  # noqa: E402
    analytics,
    cleaning,
    enrichment,
    modelling,
    profiling,
    serving,
)
from timelegs.plans import batch  # noqa: E402
from timelegs.registry import QUERIES  # noqa: E402
from timelegs.sources import sinks  # noqa: E402
from timelegs.sources.sample_network import SampleNetwork  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Straight from the driver's tables, without a written stage in between.
DIRECT = ["clean_funnel", "link_lookup_join", "best_stop_record", "stop_match", "xml_round_trip"]


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("timelegs-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def consume(df: DataFrame) -> None:
    """Run the whole query without keeping its rows."""
    df.write.format("noop").mode("overwrite").save()


class Stopwatch:
    def __init__(self):
        self.seconds: dict[str, float] = {}

    def run(self, name: str, work):
        started = time.perf_counter()
        result = work()
        self.seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {self.seconds[name]}s", file=sys.stderr)
        return result


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    net = SampleNetwork(spark, SF_DIR)
    out = batch.Layout(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    watch = Stopwatch()

    consume(net.table("lineitem"))  # start the JVM's reader before the clock

    sinks.write_parquet(net.raw, out.at("raw_segments"))
    raw = spark.read.parquet(out.at("raw_segments"))
    segments = watch.run("stage_clean", lambda: batch.clean(spark, raw, out))
    enriched = watch.run("stage_enrich", lambda: batch.enrich(spark, segments, net.stops, out))

    reports = {
        "profile_missing": lambda: profiling.missing_counts(raw),
        "profile_coverage": lambda: profiling.coverage(raw),
        "quality_funnel": lambda: cleaning.quality_funnel(raw),
        "overall_statistics": lambda: analytics.overall_statistics(segments),
        "runtime_distribution": lambda: analytics.runtime_distribution(segments),
        "time_of_day_summary": lambda: analytics.time_of_day_summary(segments),
        "peak_summary": lambda: analytics.peak_summary(segments),
        "route_summary": lambda: analytics.route_summary(segments),
        "high_duration_routes": lambda: analytics.high_duration_routes(segments),
        "longest_segments": lambda: analytics.longest_segments(segments),
        "feature_summary": lambda: enrichment.feature_summary(enriched),
    }
    for name, build in reports.items():
        watch.run(name, lambda b=build: consume(b()))
    for name in DIRECT:
        watch.run(name, lambda n=name: consume(QUERIES[n](spark, SF_DIR)))

    data = watch.run("ml_prepare", lambda: modelling.prepare(enriched))
    comparison = modelling.compare_models(data)
    rows = comparison.results.collect()
    for r in rows:
        key = re.sub(r"[^a-z]+", "_", r["model_name"].lower())
        watch.seconds[f"train_{key}"] = r["training_seconds"]
        watch.seconds[f"evaluate_{key}"] = r["evaluation_seconds"]
    sinks.write_parquet(comparison.results, out.at("model_results"))
    scored = modelling.score(comparison.best_model, data)
    watch.run("ml_score", lambda: sinks.write_parquet(scored, out.at("test_predictions")))
    data.release()

    predictions = spark.read.parquet(out.at("test_predictions"))
    results = spark.read.parquet(out.at("model_results"))
    tables = watch.run(
        "serving_build",
        lambda: batch.load_serving(
            spark,
            net.stops.filter("has_coordinates = 1"),
            enriched.filter("distance_km IS NOT NULL AND departure_hour IS NOT NULL"),
            results,
            predictions,
            comparison.best_name,
            out,
        ),
    )
    questions = {
        "route_kpi": {"line_ref": "Brand#7"},
        "route_longest": {"line_ref": "Brand#7", "row_limit": 25},
        "anomaly_detail": {
            "minimum_error": 1.0,
            "line_ref": None,
            "direction": None,
            "row_limit": 50,
        },
        "overview_kpis": {},
    }
    for name, params in questions.items():
        watch.run(
            f"ask_{name}",
            lambda n=name, p=params: consume(serving.run_query(spark, n, tables, p)),
        )

    quality = {r["model_name"]: {"rmse": r["rmse"], "r2": r["r2"]} for r in rows}
    found = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "timetable_segment_batch_total",
                "value": round(sum(watch.seconds.values()), 3),
                "unit": "sec",
                "queries": watch.seconds,
                "sf": float(found.group(1)) if found else None,
                "training_records": rows[0]["training_records"],
                "testing_records": rows[0]["testing_records"],
                "models": quality,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
