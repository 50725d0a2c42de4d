"""Metrics, residuals and ranking on predictions that SQL can repeat, and the trained models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timelegs.operators import modelling
from timelegs.operators.joins import lookup_join
from timelegs.registry.book import query
from timelegs.schemas import PREDICTION_IDENTIFIERS
from timelegs.sources.stage import stage


@query(
    "modelling_rows",
    """
    SELECT segment_key, vehicle_timing_link_id, CAST(runtime_minutes AS DOUBLE) AS label FROM enriched
    WHERE runtime_minutes > 0 AND distance_km > 0
    """,
    ["enriched"],
)
def modelling_rows(net):
    return net.modelling_rows.select("segment_key", "vehicle_timing_link_id", "label")


METRICS = """
    count(*) AS testing_records,
    round(sqrt(avg(pow(label - {p}, 2))), 6) AS rmse, round(avg(abs(label - {p})), 6) AS mae,
    round(1 - sum(pow(label - {p}, 2)) / (var_pop(label) * count(*)), 6) AS r2
"""


def rounded_metrics(predictions: DataFrame) -> DataFrame:
    found = modelling.regression_metrics(predictions)
    return found.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "r2")})


@query(
    "regression_metrics", f"SELECT {METRICS.format(p='prediction')} FROM predicted", ["predicted"]
)
def regression_metrics(net):
    return rounded_metrics(net.mean_predictions)


BASELINES = {
    "Line": "line_ref",
    "Hour": "departure_hour",
    "Period": "time_of_day",
    "Band": "distance_band",
}

BASELINE_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS model_name, {METRICS.format(p="p")}
        FROM (SELECT runtime_minutes AS label,
                     round(avg(runtime_minutes) OVER (PARTITION BY {group}), 6) AS p
              FROM enriched WHERE runtime_minutes > 0 AND distance_km > 0) x"""
    for name, group in BASELINES.items()
)


def baseline_results(net) -> DataFrame:
    """Metrics of four group means, one row each: the input of a ranking."""

    few = net.narrowed(*BASELINES.values(), "runtime_minutes", "distance_km")

    def result(name: str, group: str) -> DataFrame:
        # An unknown value is a group of its own.
        shown = F.coalesce(F.col(group).cast("string"), F.lit(""))
        rows = few.modelling_rows.select(shown.alias("group"), "label")
        means = rows.groupBy(F.col("group").alias("mean_group")).agg(
            F.round(F.avg("label"), 6).alias("prediction")
        )
        found = rounded_metrics(lookup_join(rows, means, {"group": "mean_group"}, "inner"))
        return found.select(F.lit(name).alias("model_name"), "*")

    return reduce(DataFrame.unionByName, [result(n, g) for n, g in BASELINES.items()])


@query(
    "model_rank",
    f"SELECT *, CAST(row_number() OVER (ORDER BY rmse, model_name) AS INT) AS rank_by_rmse FROM ({BASELINE_SQL})",
    ["enriched"],
)
def model_rank(net):
    return modelling.rank_models(baseline_results(net))


@query(
    "best_model",
    f"SELECT * FROM ({BASELINE_SQL}) ORDER BY rmse, model_name LIMIT 1",
    ["enriched"],
)
def best_model(net):
    return modelling.best_model(baseline_results(net))


@query(
    "residual_flags",
    """
    SELECT vehicle_timing_link_id, segment_key, label, prediction,
           round(residual_minutes, 6) AS residual_minutes,
           round(absolute_error_minutes, 6) AS absolute_error_minutes,
           is_model_anomaly, anomaly_direction
    FROM flagged
    """,
    ["flagged"],
)
def residual_flags(net):
    few = net.narrowed("vehicle_timing_link_id", "segment_key", "line_ref", "runtime_minutes", "distance_km")
    return few.flagged_predictions.select(
        "vehicle_timing_link_id",
        "segment_key",
        "label",
        "prediction",
        F.round("residual_minutes", 6).alias("residual_minutes"),
        F.round("absolute_error_minutes", 6).alias("absolute_error_minutes"),
        "is_model_anomaly",
        "anomaly_direction",
    )


@query(
    "anomaly_summary",
    """
    SELECT count(*) AS test_prediction_records, CAST(sum(is_model_anomaly) AS BIGINT) AS model_anomaly_records,
           count(*) FILTER (WHERE anomaly_direction = 'Longer than expected')
               AS longer_than_expected_anomalies,
           count(*) FILTER (WHERE anomaly_direction = 'Shorter than expected')
               AS shorter_than_expected_anomalies,
           round(100.0 * sum(is_model_anomaly) / count(*), 4) AS model_anomaly_percentage
    FROM flagged
    """,
    ["flagged"],
)
def anomaly_summary(net):
    return modelling.anomaly_summary(net.narrowed("line_ref", "runtime_minutes", "distance_km").flagged_predictions)


@query(
    "top_anomalies",
    """
    SELECT source_file, vehicle_journey_code, line_ref, segment_key, departure_time, runtime_minutes,
           prediction, anomaly_direction
    FROM flagged WHERE is_model_anomaly = 1
    ORDER BY absolute_error_minutes DESC, source_file, vehicle_journey_code, line_ref, segment_key,
             departure_time
    LIMIT 100
    """,
    ["flagged"],
)
def top_anomalies(net):
    return modelling.top_anomalies(net.narrowed(*PREDICTION_IDENTIFIERS).flagged_predictions).select(
        "source_file",
        "vehicle_journey_code",
        "line_ref",
        "segment_key",
        "departure_time",
        "runtime_minutes",
        "prediction",
        "anomaly_direction",
    )


@query(
    "split_overlap",
    """
    SELECT count(*) AS total_records, count(DISTINCT segment_key) AS total_segments,
           CAST(0 AS BIGINT) AS overlapping_segments
    FROM enriched WHERE runtime_minutes > 0 AND distance_km > 0
    """,
    ["enriched"],
)
def split_overlap(net):
    """Both sides together hold every row and key, and no key is on both."""
    summary = modelling.split_summary(*modelling.split_rows(net.narrowed("segment_key", "runtime_minutes", "distance_km").modelling_rows))
    return summary.select(
        (F.col("training_records") + F.col("testing_records")).alias("total_records"),
        (F.col("training_unique_segments") + F.col("testing_unique_segments")).alias("total_segments"),
        "overlapping_segments",
    )


@query("split_summary")
def split_summary(net):
    return modelling.split_summary(*modelling.split_rows(net.narrowed("segment_key", "runtime_minutes", "distance_km").modelling_rows))


@query("model_comparison")
def model_comparison(net):
    """The four regressors trained and ranked; the rows hold wall times, so SQL cannot repeat them."""
    data = modelling.prepare(net.whole_enriched)
    try:
        return modelling.compare_models(data).results
    finally:
        data.release()


def decision_tree_scores(net) -> DataFrame:
    """Test rows scored by a decision tree, as a written table, so that the encoded rows can
    be let go of."""
    held = []

    def build() -> DataFrame:
        data = modelling.prepare(net.whole_enriched)
        held.append(data)
        tree = next(c for c in modelling.candidates() if c.name == "Decision Tree")
        return modelling.score(tree.estimator.fit(data.train), data)

    try:
        return stage(f"tree scores {net.sf_dir}", build)
    finally:
        for data in held:
            data.release()


@query("anomaly_scores")
def anomaly_scores(net):
    return decision_tree_scores(net)


def sampled(net) -> DataFrame:
    """Predictions with the columns that a sample is drawn by."""
    columns = [*modelling.SAMPLED_BY, "line_ref", "runtime_minutes", "distance_km"]
    return modelling.add_residuals(net.narrowed(*columns).mean_predictions)


@query(
    "residual_sample",
    """
    SELECT round(residual_minutes, 6) AS residual_minutes FROM predictions
    WHERE substr(md5(concat_ws('|', coalesce(source_file, ''), coalesce(vehicle_journey_code, ''),
                               coalesce(segment_key, ''), coalesce(departure_time, ''))), 1, 4) < '3333'
    """,
    ["predictions"],
)
def residual_sample(net):
    sample = modelling.residual_sample(sampled(net))
    return sample.select(F.round("residual_minutes", 6).alias("residual_minutes"))


@query(
    "residual_rows",
    """
    SELECT round(residual_minutes, 6) AS residual_minutes FROM predictions
    QUALIFY rank() OVER (ORDER BY substr(md5(concat_ws('|', coalesce(source_file, ''), coalesce(vehicle_journey_code, ''),
                                  coalesce(segment_key, ''), coalesce(departure_time, ''))), 1, 15)) <= 1000
    """,
    ["predictions"],
)
def residual_rows(net):
    """A sample of a thousand rows, whatever the size of the table."""
    sample = modelling.residual_rows(sampled(net), 1000)
    return sample.select(F.round("residual_minutes", 6).alias("residual_minutes"))


@query("feature_importance")
def feature_importance(net):
    data = modelling.prepare(net.whole_enriched)
    try:
        tree = next(c for c in modelling.candidates() if c.name == "Decision Tree")
        model = tree.estimator.fit(data.train)
        return modelling.feature_importance(model, modelling.feature_names(data.train), net.spark)
    finally:
        data.release()
