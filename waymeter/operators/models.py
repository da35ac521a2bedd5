"""Regressors: fitting, comparison and evaluation with MLlib."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.regression import (
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.operators import histogram_trees
from waymeter.operators.metrics import compared_metrics, evaluation_report
from waymeter.operators.newton import NewtonSettings, fit_newton
from waymeter.params import CATEGORICAL, TARGET, TRAFFIC_ORDINAL, ModelSettings, TripRules

Fit = Callable[[DataFrame], Model]


#: Features up to which the normal equations are solved at once; they have a row and a column each.
NORMAL_FEATURES = 4096


def fit_ridge(train: DataFrame, alpha: float = ModelSettings.ridge_alpha, features: str = "features",
              target: str = TARGET, solver: str = "auto") -> LinearRegressionModel:
    """Least squares with ``alpha`` times the squared coefficients added; the intercept is free.

    MLlib divides the squared error by 2n and scales the penalty by the target's deviation, so
    ``alpha`` becomes ``alpha * deviation / n``. ``"normal"`` needs one pass and sums of all products of
    two features; ``"l-bfgs"`` needs a pass for each step and sums of one number a feature. Both minimise
    the same penalised error; ``"auto"`` takes the first while a vector has at most NORMAL_FEATURES elements.
    """
    vector = F.unwrap_udt(features)
    n_features = F.max(F.coalesce(vector["size"], F.size(vector["values"])))
    size = train.agg(F.count(target).alias("n"), F.stddev_pop(target).alias("sd"), F.stddev_samp(target).alias("sd1"), n_features.alias("m")).first()
    if solver == "auto":
        solver = "normal" if (size["m"] or 0) <= NORMAL_FEATURES else "l-bfgs"
    deviation = size["sd"] if solver == "normal" else size["sd1"]  # the two solvers scale by different ones
    return LinearRegression(
        featuresCol=features,
        labelCol=target,
        solver=solver,
        elasticNetParam=0.0,
        standardization=False,
        regParam=alpha * (deviation or 0.0) / max(size["n"], 1),
        maxIter=1000,
        tol=1e-12,
    ).fit(train)


def fit_forest(train: DataFrame, settings: ModelSettings = ModelSettings(), features: str = "features",
               target: str = TARGET) -> Model:
    """Random forest that looks at every feature at every split. Splits are binned. MLlib's settings, draws and model, grown over stored values."""
    forest = RandomForestRegressor(
        featuresCol=features,
        labelCol=target,
        numTrees=settings.forest_trees,
        maxDepth=settings.forest_depth,
        featureSubsetStrategy="all",
        seed=settings.seed,
    )
    return histogram_trees.fit_forest(forest, train)


def fit_boosting(train: DataFrame, settings: ModelSettings = ModelSettings(), sample: float = 1.0,
                 features: str = "features", target: str = TARGET) -> Model:
    """Gradient-boosted trees with squared loss; ``sample`` below 1 fits each tree on a row sample, which MLlib draws."""
    boosting = GBTRegressor(
        featuresCol=features,
        labelCol=target,
        maxIter=settings.boost_rounds,
        maxDepth=settings.boost_depth,
        stepSize=settings.boost_rate,
        subsamplingRate=sample,
        featureSubsetStrategy="all",
        seed=settings.seed,
    )
    return boosting.fit(train) if sample < 1 else histogram_trees.fit_boosting(boosting, train)


def candidates(settings: ModelSettings = ModelSettings()) -> dict[str, Fit]:
    """The candidates in the order that decides ties."""
    return {
        "RidgeRegression": lambda train: fit_ridge(train, settings.ridge_alpha),
        "RandomForest": lambda train: fit_forest(train, settings),
        "GradientBoosting": lambda train: fit_boosting(train, settings),
        "NewtonBoosting": lambda train: fit_newton(train, NewtonSettings(settings.newton_rounds, settings.boost_depth, settings.newton_rate)),
    }


def fit_all(train: DataFrame, fits: Mapping[str, Fit], together: Sequence[str] = ()) -> dict[str, Model]:
    """Fit every candidate on the same training table, which is kept in memory meanwhile.

    One after the other, but those named in ``together`` at once, after the others: fits that leave cores idle, with many short jobs or one long task.
    """
    train = train.persist()
    try:
        found = {name: fit(train) for name, fit in fits.items() if name not in together}
        at_once = {name: inheritable_thread_target(train.sparkSession)(lambda fit=fit: fit(train)) for name, fit in fits.items() if name in together}
        with ThreadPoolExecutor(max(len(at_once), 1)) as pool:
            begun = {name: pool.submit(fit) for name, fit in at_once.items()}
        found |= {name: job.result() for name, job in begun.items()}
        return {name: found[name] for name in fits}
    finally:
        train.unpersist()


def model_metrics(models: Mapping[str, Model], train: DataFrame, test: DataFrame,
                  target: str = TARGET) -> DataFrame:
    """(ord, model, split, r2, mae, rmse, mape, n): one row per model and split.

    All models score the same pass over the union of both splits.
    """
    scored = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    for i, model in enumerate(models.values()):
        scored = model.copy().setPredictionCol(f"_p{i}").transform(scored)
    columns = {name: f"_p{i}" for i, name in enumerate(models)}
    return compared_metrics(scored, target, columns, by=["split"])


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Candidates by test error, best first; of equals the earlier candidate first."""
    return (
        metrics.where(F.col("split") == "test")
        .orderBy("rmse", "ord")
        .select(
            "model",
            F.col("r2").alias("test_r2"),
            F.col("rmse").alias("test_rmse"),
            F.col("mae").alias("test_mae"),
        )
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """One row: the candidate with the lowest test error, the earlier one on a tie."""
    test = metrics.where(F.col("split") == "test")
    return test.agg(
        F.min_by(F.struct("model", "ord", "rmse"), F.struct("rmse", "ord")).alias("best")
    ).select("best.*")


def model_record(metrics: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """One-row metadata of the winner with the comparison of all candidates."""
    is_test = F.col("split") == "test"
    per_model = metrics.groupBy("ord", "model").agg(
        *[
            F.max(F.when(is_test if split == "test" else ~is_test, F.col(m))).alias(f"{split}_{m}")
            for split in ("train", "test")
            for m in ("r2", "mae", "rmse", "mape")
        ]
    )
    wanted = ("model", "train_r2", "test_r2", "train_mae", "test_mae", "test_rmse", "test_mape")
    compared = F.struct("model", "test_r2", "test_rmse", "test_mae")
    rolled = per_model.agg(
        F.min_by(F.struct(*wanted), F.struct("test_rmse", "ord")).alias("best"),
        # One entry per candidate.
        F.array_sort(F.collect_list(F.struct("ord", compared.alias("c")))).alias("all"),
    )
    traffic = F.create_map(*[F.lit(x) for pair in TRAFFIC_ORDINAL.items() for x in pair])
    return rolled.select(
        "best.*",
        F.lit(rules.seed).alias("random_state"),
        F.lit(rules.test_share).alias("test_size"),
        traffic.alias("traffic_mapping"),
        F.array(*[F.lit(c) for c in CATEGORICAL]).alias("categorical_columns"),
        F.lit(rules.rare_below).alias("location_threshold"),
        F.col("all.c").alias("all_model_comparisons"),
    )


def model_info(record: DataFrame, n_features: int) -> DataFrame:
    """The short form of the metadata for display."""
    return record.select(
        "model",
        "test_r2",
        "test_rmse",
        "test_mae",
        F.lit(n_features).alias("n_features"),
        "all_model_comparisons",
    )


def evaluate_stored(model: Model, test: DataFrame, target: str = TARGET) -> DataFrame:
    """Score a stored model on test features and report the rounded metrics."""
    return evaluation_report(model.transform(test), target, model.getPredictionCol())


def feature_importances(model: Model, names: Sequence[str], top: int = 20) -> DataFrame:
    """The ``top`` features by importance. The table has one row per model feature."""
    from pyspark.sql import SparkSession

    weights = model.importances() if hasattr(model, "importances") else model.featureImportances.toArray()
    rows = [(i, n, float(w)) for i, (n, w) in enumerate(zip(names, weights))]
    schema = T.StructType(
        [
            T.StructField("position", T.IntegerType()),
            T.StructField("feature", T.StringType()),
            T.StructField("importance", T.DoubleType()),
        ]
    )
    table = SparkSession.active().createDataFrame(rows, schema)
    return table.orderBy(F.desc("importance"), "position").limit(top)


def ridge_coefficients(model: LinearRegressionModel, names: Sequence[str]) -> DataFrame:
    """(term, coefficient) with the intercept last."""
    from pyspark.sql import SparkSession

    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())]
    rows.append(("intercept", float(model.intercept)))
    return SparkSession.active().createDataFrame(rows, "term string, coefficient double")
