"""Run-time models: a leakage-safe split, feature encoding, four regressors, and the
residuals that mark unusual segments.

All training data stays distributed. The driver sees only fitted models and one row of
metrics per model.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from timelegs.functions import measures
from timelegs.operators.quality import require_columns
from timelegs.sources.stage import remove_folder, shared_folder
from timelegs.schemas import (
    CATEGORICAL_FEATURES,
    MODEL_RESULTS,
    NUMERIC_FEATURES,
    PREDICTION_COLUMNS,
    PREDICTION_IDENTIFIERS,
)

# Split, seed, point of the threshold, report sizes.
SPLIT_BUCKETS = 100
TRAIN_BUCKETS = 80
SEED = 42
THRESHOLD_POINT = 0.95
TOP_ANOMALIES = 100
RESIDUAL_SAMPLE_FRACTION = 0.20
RESIDUAL_SAMPLE_ROWS = 20_000

# So many values of one category get slots in the vectors.
MOST_CATEGORIES = 20_000
SAMPLED_BY = ("source_file", "vehicle_journey_code", "segment_key", "departure_time")

# Stands for an unknown number, such as the hour of an unreadable departure time. It lies
# outside every feature's range; the linear learner accepts no NaN.
GAP_VALUE = -1.0

WITHIN = "Within expected range"
LONGER = "Longer than expected"
SHORTER = "Shorter than expected"


class CategoryError(ValueError):
    """A feature has too many categories to be encoded."""


class LeakageError(RuntimeError):
    """A segment appears in the training and in the test rows."""


# --- rows and split -----------------------------------------------------------------


def modelling_rows(enriched: DataFrame) -> DataFrame:
    """Rows with a positive run time and distance, and the target as ``label``."""
    return enriched.filter((F.col("runtime_minutes") > 0) & (F.col("distance_km") > 0)).withColumn(
        "label", F.col("runtime_minutes").cast("double")
    )


def with_split_bucket(rows: DataFrame, key: str = "segment_key") -> DataFrame:
    """Adds split_bucket 0-99, the same for every row of a key, wherever the row is."""
    return rows.withColumn("split_bucket", F.pmod(F.xxhash64(key), F.lit(SPLIT_BUCKETS)))


def split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    bucketed = with_split_bucket(rows)
    bucket = F.col("split_bucket")
    train = bucketed.filter(bucket < TRAIN_BUCKETS).drop("split_bucket")
    test = bucketed.filter(bucket >= TRAIN_BUCKETS).drop("split_bucket")
    return train, test


def split_overlap(train: DataFrame, test: DataFrame, key: str = "segment_key") -> DataFrame:
    """One row: the number of keys that occur on both sides."""
    common = train.select(key).intersect(test.select(key))
    return common.agg(F.count(F.lit(1)).alias("overlapping_segments"))


def split_summary(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row of sizes, shares and distinct keys per side.

    Keys are counted with their rows and sides in one shuffle; an overlap is a key that
    both sides hold.
    """

    def side(df: DataFrame, is_train: int) -> DataFrame:
        return df.select("segment_key", F.lit(is_train).alias("is_train"))

    per_key = (
        side(train, 1)
        .unionByName(side(test, 0))
        .groupBy("segment_key")
        .agg(
            F.count_if(F.col("is_train") == 1).alias("train_rows"),
            F.count_if(F.col("is_train") == 0).alias("test_rows"),
        )
    )
    in_train, in_test = F.col("train_rows") > 0, F.col("test_rows") > 0
    zero = F.lit(0)
    total = F.col("training_records") + F.col("testing_records")
    return per_key.agg(
        F.coalesce(F.sum("train_rows"), zero).alias("training_records"),
        F.coalesce(F.sum("test_rows"), zero).alias("testing_records"),
        F.count_if(in_train).alias("training_unique_segments"),
        F.count_if(in_test).alias("testing_unique_segments"),
        F.count_if(in_train & in_test).alias("overlapping_segments"),
    ).withColumns(
        {
            "training_percentage": measures.percentage(F.col("training_records"), total),
            "testing_percentage": measures.percentage(F.col("testing_records"), total),
        }
    )


def require_no_leakage(train: DataFrame, test: DataFrame) -> None:
    found = split_overlap(train, test).first()["overlapping_segments"]
    if found:
        raise LeakageError(f"{found} segments are in the training and in the test rows")


def require_few_categories(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES, limit: int = MOST_CATEGORIES
) -> None:
    """An error with the counts when a column has more distinct values than ``limit``.

    The indexer brings each distinct value to the driver, and each gets a slot of every vector,
    so their number is checked first: by an aggregate per column of which one number returns.
    """
    for column in columns:
        found = df.select(column).distinct().agg(F.count(column)).first()[0]
        if found > limit:
            raise CategoryError(f"{column} has {found} categories, more than {limit}")


def require_split(summary: DataFrame) -> DataFrame:
    """A computed ``split_summary``, or an error if a segment is on both sides; one job."""
    row = summary.first()
    if row["overlapping_segments"]:
        raise LeakageError(f"{row['overlapping_segments']} segments are in the training and in the test rows")
    return summary.sparkSession.createDataFrame([row], summary.schema)


# --- features -----------------------------------------------------------------------


def feature_stages(
    categorical: Sequence[str] = CATEGORICAL_FEATURES, numeric: Sequence[str] = NUMERIC_FEATURES
) -> Pipeline:
    """Index, one-hot encode and assemble. One indexer counts all columns in one pass."""
    indexed = [f"{c}_index" for c in categorical]
    encoded = [f"{c}_encoded" for c in categorical]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(
                inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True
            ),
            VectorAssembler(
                inputCols=[*numeric, *encoded], outputCol="features", handleInvalid="keep"
            ),
        ]
    )


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector slots, from the column metadata."""
    groups = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    slots = {
        int(a["idx"]): a.get("name", f"feature_{a['idx']}") for group in groups.values() for a in group
    }
    return [slots[i] for i in sorted(slots)]


@dataclass
class PreparedData:
    """Encoded rows of both sides, of rows kept in a folder for the iterations of training until ``release``."""

    train: DataFrame
    test: DataFrame
    encoder: PipelineModel
    folder: str

    def release(self) -> None:
        """Delete what was written of the rows; both frames end with it."""
        remove_folder(self.train.sparkSession, self.folder)


def fixed_layout(df: DataFrame) -> DataFrame:
    """Rows in partitions and an order that depend on their values only.

    Seeded sampling inside the tree learners depends on both. Hashing all identifiers
    spreads a hot line or segment evenly.
    """
    return df.repartition(F.xxhash64(*PREDICTION_IDENTIFIERS)).sortWithinPartitions(
        *PREDICTION_IDENTIFIERS
    )


def keep_for_reuse(df: DataFrame, folder: str, hold: bool = True) -> DataFrame:
    """Rows that many jobs read, written to a shared folder.

    A lost executor then costs a re-read of its partitions, not the whole lineage again. A
    checkpoint makes its rows twice, to count and to write them, so they are held until they are
    written, and no longer: the memory is for the learners, which hold a form of their own. Rows
    held straight after a shuffle would lie in all its partitions, however small; ``hold`` is not
    for those.
    """
    context = df.sparkSession.sparkContext
    before = context.getCheckpointDir() or shared_folder(df.sparkSession)
    context.setCheckpointDir(folder)
    if hold:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint()
    finally:
        context.setCheckpointDir(before)  # what the session checkpoints later goes where it went before
        if hold:
            df.unpersist()


def prepare(enriched: DataFrame, folder: str | None = None) -> PreparedData:
    """Split, fit the encoder on the training side, encode both sides.

    The split is a function of the segment, so no segment can be on both sides; ``split_summary``
    counts them all the same, and ``require_split`` stops a run where it finds any.

    The rows are kept once, as they are before the encoding, in ``folder``, by default a new one in
    the session's shared folder. Vectors are made from them whenever they are read; the columns that
    the encoder learns from are held meanwhile.
    """
    spark = enriched.sparkSession
    folder = f"{folder or shared_folder(spark)}/training-{uuid.uuid4().hex}"
    needed = {*CATEGORICAL_FEATURES, *NUMERIC_FEATURES, *PREDICTION_IDENTIFIERS}
    require_columns(enriched, sorted(needed), "enriched segments")
    columns = list(dict.fromkeys([*PREDICTION_IDENTIFIERS, *sorted(needed), "label"]))
    known = modelling_rows(enriched).select(*columns).fillna(GAP_VALUE, NUMERIC_FEATURES)
    rows = keep_for_reuse(fixed_layout(known), folder, hold=False)
    categories = rows.select("segment_key", *CATEGORICAL_FEATURES).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        learnt_from, _ = split_rows(categories)
        require_few_categories(learnt_from)
        encoder = feature_stages().fit(learnt_from)
    finally:
        categories.unpersist()
    train, test = split_rows(rows)
    kept = [*PREDICTION_IDENTIFIERS, "label", "features"]
    return PreparedData(encoder.transform(train).select(*kept), encoder.transform(test).select(*kept), encoder, folder)


# --- models -------------------------------------------------------------------------


@dataclass
class Candidate:
    name: str
    configuration: str
    estimator: Estimator


def candidates(seed: int = SEED) -> list[Candidate]:
    """The four regressors with their fixed settings."""
    io = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}
    return [
        Candidate(
            "Linear Regression",
            "regParam=0.05; elasticNetParam=0.0; maxIter=50",
            LinearRegression(regParam=0.05, elasticNetParam=0.0, maxIter=50, **io),
        ),
        Candidate(
            "Decision Tree",
            "maxDepth=10; minInstancesPerNode=20",
            DecisionTreeRegressor(maxDepth=10, minInstancesPerNode=20, seed=seed, **io),
        ),
        Candidate(
            "Random Forest",
            "numTrees=40; maxDepth=10; featureSubsetStrategy=sqrt; subsamplingRate=0.8",
            RandomForestRegressor(
                numTrees=40,
                maxDepth=10,
                featureSubsetStrategy="sqrt",
                subsamplingRate=0.8,
                seed=seed,
                **io,
            ),
        ),
        Candidate(
            "Gradient-Boosted Trees",
            "maxIter=20; maxDepth=6; stepSize=0.1; subsamplingRate=0.8",
            GBTRegressor(
                maxIter=20, maxDepth=6, stepSize=0.1, subsamplingRate=0.8, seed=seed, **io
            ),
        ),
    ]


def regression_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row with rmse, mae and r2 from a single pass."""
    error = F.col(label) - F.col(prediction)
    rows = F.count(F.lit(1))
    total_squares = F.var_pop(label) * rows
    return predictions.agg(
        rows.alias("testing_records"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(error * error), total_squares)).alias("r2"),
    )


@dataclass
class Comparison:
    results: DataFrame
    best_name: str
    best_configuration: str
    best_model: Model
    models: dict[str, Model]


def compare_models(data: PreparedData, contenders: Sequence[Candidate] | None = None) -> Comparison:
    """Train each regressor, score the test rows, rank by rmse."""
    spark = data.train.sparkSession
    training_records = data.train.count()
    rows, models = [], {}
    for c in contenders or candidates():
        started = time.perf_counter()
        model = c.estimator.fit(data.train)
        trained = time.perf_counter()
        scored = model.transform(data.test).select("label", "prediction").persist()
        scored.count()
        ready = time.perf_counter()  # the clock of the evaluation runs over scored rows
        m = regression_metrics(scored).first()
        evaluated = time.perf_counter()
        scored.unpersist()
        models[c.name] = model
        rows.append(
            (
                c.name,
                c.configuration,
                training_records,
                m["testing_records"],
                m["rmse"],
                m["mae"],
                m["r2"],
                round(trained - started, 4),
                round(evaluated - ready, 4),
            )
        )
    if not rows:
        raise RuntimeError("no model was trained")
    best = min(rows, key=lambda r: r[4])
    fields = [f for f in MODEL_RESULTS.fields if f.name != "rank_by_rmse"]
    unranked = spark.createDataFrame(rows, type(MODEL_RESULTS)(fields))
    for c in ("rmse", "mae", "r2"):
        unranked = unranked.withColumn(c, F.round(c, 6))
    ranked = rank_models(unranked).select(*MODEL_RESULTS.fieldNames())
    return Comparison(ranked, best[0], best[1], models[best[0]], models)


def rank_models(results: DataFrame) -> DataFrame:
    """Adds rank_by_rmse. The window is global, over one row per model."""
    order = Window.orderBy(F.col("rmse").asc(), F.col("model_name").asc())
    return results.withColumn("rank_by_rmse", F.row_number().over(order)).orderBy("rank_by_rmse")


def best_model(results: DataFrame) -> DataFrame:
    """One row: the model with the lowest rmse."""
    columns = [c for c in results.columns if c != "rmse"]
    return results.agg(
        F.min_by(F.struct("rmse", *columns), F.struct("rmse", "model_name")).alias("_best")
    ).select("_best.*")


# --- residuals ----------------------------------------------------------------------


def add_residuals(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    residual = F.col(label) - F.col(prediction)
    return predictions.withColumns(
        {"residual_minutes": residual, "absolute_error_minutes": F.abs(residual)}
    )


def residual_threshold(
    train_residuals: DataFrame, point: float = THRESHOLD_POINT
) -> DataFrame:
    """One row: the absolute error that all but the largest training errors stay within, exactly."""
    return measures.exact_quantiles(train_residuals, "absolute_error_minutes", {"residual_threshold": point})


def training_threshold(model: Model, data: PreparedData) -> DataFrame:
    """One row: ``residual_threshold`` of the training rows, which are scored once for it.

    The errors, one number a row, are written beside the prepared rows and go with them.
    """
    path = f"{data.folder}/errors-{uuid.uuid4().hex}"
    add_residuals(model.transform(data.train)).select("absolute_error_minutes").write.parquet(path)
    limit = residual_threshold(data.train.sparkSession.read.parquet(path))
    return limit.sparkSession.createDataFrame([limit.first()], limit.schema)


def flag_anomalies(residuals: DataFrame, threshold: DataFrame) -> DataFrame:
    limit = threshold.select("residual_threshold").scalar()
    flagged = residuals.withColumn(
        "is_model_anomaly", F.when(F.col("absolute_error_minutes") > limit, 1).otherwise(0)
    )
    direction = (
        F.when(F.col("is_model_anomaly") == 0, WITHIN)
        .when(F.col("residual_minutes") > 0, LONGER)
        .otherwise(SHORTER)
    )
    return flagged.withColumn("anomaly_direction", direction)


def score(model: Model, data: PreparedData, threshold: DataFrame | None = None) -> DataFrame:
    """Test rows with prediction, residual, flag and direction; the limit is learnt on the
    training rows only."""
    if threshold is None:
        threshold = training_threshold(model, data)
    return flag_anomalies(add_residuals(model.transform(data.test)), threshold).select(
        *PREDICTION_COLUMNS
    )


def anomaly_summary(flagged: DataFrame) -> DataFrame:
    direction = F.col("anomaly_direction")
    return flagged.agg(
        F.count(F.lit(1)).alias("test_prediction_records"),
        F.count_if(F.col("is_model_anomaly") == 1).alias("model_anomaly_records"),
        F.count_if(direction == LONGER).alias("longer_than_expected_anomalies"),
        F.count_if(direction == SHORTER).alias("shorter_than_expected_anomalies"),
    ).withColumn(
        "model_anomaly_percentage",
        measures.percentage(F.col("model_anomaly_records"), F.col("test_prediction_records")),
    )


def best_model_summary(comparison: Comparison, data: PreparedData) -> DataFrame:
    """One row about the best model: name, settings, metrics and the size of its input."""
    size = data.train.schema["features"].metadata["ml_attr"]["num_attrs"]
    return comparison.results.filter(F.col("model_name") == comparison.best_name).select(
        F.col("model_name").alias("best_model_name"),
        F.col("configuration").alias("best_model_configuration"),
        F.col("rmse").alias("best_model_rmse"),
        F.col("mae").alias("best_model_mae"),
        F.col("r2").alias("best_model_r2"),
        F.lit(size).alias("feature_vector_size"),
        "training_records",
        "testing_records",
    )


def top_anomalies(flagged: DataFrame, rows: int = TOP_ANOMALIES) -> DataFrame:
    ties = [F.col(c).asc_nulls_last() for c in PREDICTION_IDENTIFIERS]
    return (
        flagged.filter(F.col("is_model_anomaly") == 1)
        .orderBy(F.col("absolute_error_minutes").desc(), *ties)
        .limit(rows)
    )


def residual_sample(flagged: DataFrame, fraction: float = RESIDUAL_SAMPLE_FRACTION) -> DataFrame:
    """A sample of the residuals, for a chart: rows whose identifiers hash below the fraction.

    The same rows every time, and the same share of every part of the table.
    """
    known = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SAMPLED_BY]
    place = F.substring(F.md5(F.concat_ws("|", *known).cast("binary")), 1, 4)
    return flagged.filter(place < F.lit(f"{round(fraction * 65536):04x}")).select("residual_minutes")


def residual_rows(flagged: DataFrame, rows: int = RESIDUAL_SAMPLE_ROWS) -> DataFrame:
    """A sample of the residuals of a stated size, for a chart: the rows of least hash.

    The hash of the last row is found by counting, so no task holds or sorts the sample, and the
    same rows come out every time. All rows, if there are fewer; rows with the identifiers of
    the last one come with it.
    """
    known = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SAMPLED_BY]
    digits = F.substring(F.md5(F.concat_ws("|", *known).cast("binary")), 1, 15)
    hashed = flagged.select("residual_minutes", F.conv(digits, 16, 10).cast("bigint").alias("_hash"))
    last = measures.kth_smallest(hashed, "_hash", rows).scalar()
    return hashed.filter(F.col("_hash") <= last).select("residual_minutes")


def feature_importance(model: Model, names: Sequence[str], spark) -> DataFrame:
    """Features ranked by importance, or by absolute coefficient for a linear model.

    One row per vector slot: the size of the model, not of the data.
    """
    if hasattr(model, "featureImportances"):
        column, values = "importance", model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        column, values = "absolute_coefficient", [abs(v) for v in model.coefficients.toArray()]
    else:
        column, values = "score", []
    named = [
        (names[i] if i < len(names) else f"feature_{i}", float(v)) for i, v in enumerate(values)
    ]
    ordered = sorted(named, key=lambda item: -item[1])
    rows = [(i, n, v) for i, (n, v) in enumerate(ordered, start=1)]
    return spark.createDataFrame(rows, f"rank int, feature_name string, {column} double")
