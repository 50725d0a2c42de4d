from __future__ import annotations

from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from timelegs.operators import modelling


@pytest.fixture(scope="module")
def signal(network):
    """Enriched rows whose run time follows the distance, so that a model can learn it."""
    noise = F.pmod(F.xxhash64("vehicle_timing_link_id"), F.lit(100)) / 200.0
    return network.enriched.withColumn(
        "runtime_minutes", F.round(1.0 + 2.0 * F.coalesce("distance_km", F.lit(0.0)) + noise, 4)
    )


@pytest.fixture(scope="module")
def data(signal):
    prepared = modelling.prepare(signal)
    yield prepared
    prepared.release()


def quick():
    io = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}
    return [
        modelling.Candidate("Linear Regression", "lr", LinearRegression(regParam=0.05, **io)),
        modelling.Candidate("Decision Tree", "dt", DecisionTreeRegressor(maxDepth=5, seed=42, **io)),
    ]


def test_fixed_settings(spark):
    found = {c.name: c for c in modelling.candidates()}
    forest = found["Random Forest"].estimator
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSubsamplingRate()) == (40, 10, 0.8)
    assert forest.getFeatureSubsetStrategy() == "sqrt"
    boosted = found["Gradient-Boosted Trees"].estimator
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (20, 6, 0.1)
    tree = found["Decision Tree"].estimator
    assert (tree.getMaxDepth(), tree.getMinInstancesPerNode(), tree.getSeed()) == (10, 20, 42)
    linear = found["Linear Regression"].estimator
    assert (linear.getRegParam(), linear.getElasticNetParam(), linear.getMaxIter()) == (0.05, 0.0, 50)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=6), min_size=1, max_size=40))
def test_split_is_disjoint_and_stable(spark, keys):
    rows = spark.createDataFrame([(k,) for k in keys], "segment_key string")
    train, test = modelling.split_rows(rows)
    assert modelling.split_overlap(train, test).first()[0] == 0
    assert train.count() + test.count() == len(keys)
    moved, _ = modelling.split_rows(rows.repartition(3).orderBy(F.desc("segment_key")))
    assert sorted(map(str, moved.collect())) == sorted(map(str, train.collect()))


def test_leakage_is_an_error(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "segment_key string")
    with pytest.raises(modelling.LeakageError, match="1 segments"):
        modelling.require_no_leakage(rows, rows.filter("segment_key = 'a'"))
    summary = modelling.split_summary(rows, rows.filter("segment_key = 'a'")).first()
    assert summary["overlapping_segments"] == 1
    assert summary["training_percentage"] == 66.6667


def test_prepared_rows(data, signal):
    expected = modelling.modelling_rows(signal).count()
    assert data.train.count() + data.test.count() == expected
    names = modelling.feature_names(data.train)
    assert names[:2] == ["distance_km", "departure_hour"]
    assert len(names) == data.train.first()["features"].size
    assert any("__unknown" in n for n in names)


def test_metrics_agree_with_the_library(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.5)], "label double, prediction double")
    ours = modelling.regression_metrics(df).first()
    for metric in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(metricName=metric).evaluate(df)
        assert ours[metric] == pytest.approx(theirs)


def test_compare_ranks_by_rmse_and_beats_the_mean(data):
    comparison = modelling.compare_models(data, quick())
    rows = comparison.results.collect()
    assert [r["rank_by_rmse"] for r in rows] == [1, 2]
    assert rows[0]["rmse"] <= rows[1]["rmse"]
    assert comparison.best_name == rows[0]["model_name"]
    assert modelling.best_model(comparison.results).first()["model_name"] == comparison.best_name
    spread = data.test.agg(F.stddev_pop("label")).first()[0]
    assert rows[0]["rmse"] < spread
    assert all(r["training_seconds"] > 0 and r["r2"] <= 1 for r in rows)


def test_training_is_repeatable(signal):
    def tree():
        prepared = modelling.prepare(signal)
        try:
            return modelling.compare_models(prepared, quick()[1:]).results.first()["rmse"]
        finally:
            prepared.release()

    assert tree() == tree()



def test_scores_and_reports(spark, data):
    comparison = modelling.compare_models(data, quick()[1:])
    scored = modelling.score(comparison.best_model, data).cache()
    assert scored.count() == data.test.count()
    limit = modelling.residual_threshold(
        modelling.add_residuals(comparison.best_model.transform(data.train))
    ).first()[0]
    wrong = scored.filter((F.col("absolute_error_minutes") > limit) != (F.col("is_model_anomaly") == 1))
    assert wrong.count() == 0
    summary = modelling.anomaly_summary(scored).first()
    assert summary["model_anomaly_records"] == (
        summary["longer_than_expected_anomalies"] + summary["shorter_than_expected_anomalies"]
    )
    top = modelling.top_anomalies(scored, 5).collect()
    errors = [r["absolute_error_minutes"] for r in top]
    assert errors == sorted(errors, reverse=True) and len(top) <= 5
    sample = modelling.residual_sample(scored)
    assert sample.collect() == modelling.residual_sample(scored).collect()
    assert 0 < sample.count() < scored.count()
    scored.unpersist()


def test_importance_of_trees_and_lines(spark, data):
    names = modelling.feature_names(data.train)
    for candidate, column in zip(quick(), ("absolute_coefficient", "importance")):
        model = candidate.estimator.fit(data.train)
        rows = modelling.feature_importance(model, names, spark).collect()
        assert len(rows) == len(names)
        scores = [r[column] for r in rows]
        assert scores == sorted(scores, reverse=True)
    assert rows[0]["feature_name"] == "distance_km"


def test_directions(spark):
    df = spark.createDataFrame([(5.0, 1.0), (1.0, 5.0), (1.0, 1.1)], "label double, prediction double")
    limit = spark.createDataFrame([(0.5,)], "residual_threshold double")
    rows = modelling.flag_anomalies(modelling.add_residuals(df), limit).collect()
    assert [r["anomaly_direction"] for r in rows] == [
        modelling.LONGER,
        modelling.SHORTER,
        modelling.WITHIN,
    ]


def test_too_many_categories_are_an_error(spark):
    df = spark.range(100_000).select(F.concat(F.lit("L"), "id").alias("line_ref"))
    with pytest.raises(modelling.CategoryError, match="line_ref has 100000 categories"):
        modelling.require_few_categories(df, ["line_ref"])
    modelling.require_few_categories(df, ["line_ref"], 100_000)


def test_a_sample_has_the_stated_size(spark):
    df = spark.range(5000).select(
        F.col("id").cast("double").alias("residual_minutes"),
        *[F.col("id").cast("string").alias(c) for c in modelling.SAMPLED_BY],
    )
    once = {r[0] for r in modelling.residual_rows(df, 100).collect()}
    again = {r[0] for r in modelling.residual_rows(df.repartition(7), 100).collect()}
    assert once == again and len(once) == 100
    assert modelling.residual_rows(df, 6000).count() == 5000


def test_training_leaves_the_checkpoint_folder_of_the_session(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "mine"))
    kept = modelling.keep_for_reuse(spark.range(3).toDF("x"), str(tmp_path / "other"))
    assert kept.count() == 3
    assert "mine" in spark.sparkContext.getCheckpointDir()
    kept.unpersist()


def test_kept_rows_are_made_once_and_not_held(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        made.add(1)
        return x

    kept = modelling.keep_for_reuse(spark.range(10).select(seen("id").alias("x")), str(tmp_path))
    assert sorted(r["x"] for r in kept.collect()) == list(range(10)) and made.value == 10
    assert not kept.is_cached


def test_a_leaking_split_stops_the_run(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "segment_key string")
    with pytest.raises(modelling.LeakageError, match="1 segments"):
        modelling.require_split(modelling.split_summary(rows, rows.filter("segment_key = 'a'")))
    kept = modelling.require_split(modelling.split_summary(rows, rows.filter("segment_key = 'c'")))
    assert kept.first()["training_records"] == 2


def test_rows_are_kept_once_and_vectors_not_at_all(signal, tmp_path):
    prepared = modelling.prepare(signal, str(tmp_path))
    [kept] = Path(prepared.folder).glob("*/rdd-*")
    assert not prepared.train.is_cached and not prepared.test.is_cached
    assert prepared.train.count() + prepared.test.count() == modelling.modelling_rows(signal).count()
    assert prepared.train.first()["features"].size == len(modelling.feature_names(prepared.train))
    prepared.release()
    assert not kept.exists()
