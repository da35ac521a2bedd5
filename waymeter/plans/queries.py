"""The registered queries: (spark, folder of the given tables) → DataFrame.

Each reads whole tables. Sums and averages of doubles are rounded, because their last digits depend on
the order in which partitions are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymeter.operators import clean, drift, encoding, features, metrics, models, newton, policy, registry, score, validate
from waymeter.params import CATEGORICAL, NUMERIC, TARGET, Floors, ModelSettings, TripRules
from waymeter.schemas import DRIFT_REPORT, MODEL_METADATA
from waymeter.session import materialize, scratch_path
from waymeter.sources import fixtures, readers, writers
from waymeter.sources.locations import location_dimension
from waymeter.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
DRIFT_COLUMNS = (*NUMERIC, TARGET)
PREDICTED = "predicted"

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared inputs ---------------------------------------------------------------------------


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean(fixtures.trips(spark, sf_dir))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trips with calendar features and the split flag."""
    trips = cleaned(spark, sf_dir)
    return features.trip_features(features.split_flag(trips, trips.columns))


def with_baseline(df: DataFrame) -> DataFrame:
    minutes = metrics.baseline_minutes(F.col("trip_distance_km"), F.col("traffic_level"))
    return df.withColumn(PREDICTED, minutes)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_baseline(features.trip_features(cleaned(spark, sf_dir)))


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def clock_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def as_text(df: DataFrame, name: str, separator: str = ",") -> DataFrame:
    return df.withColumn(name, F.array_join(name, separator))


def numeric_rows(df: DataFrame, *extra: str) -> DataFrame:
    """The ten numeric features and the target, traffic as its ordinal."""
    ordinal = features.traffic_ordinal(F.col("traffic_level"))
    return df.select(*[c if c != "traffic_level" else ordinal.alias(c) for c in NUMERIC], TARGET, *extra)


def changed_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train rows as they are and what-if test rows, one scan, side in ``is_current``."""
    rows = numeric_rows(featured(spark, sf_dir), F.col("is_test").alias(drift.SIDE))
    return drift.what_if(rows, 1.5, only=F.col(drift.SIDE))


# --- cleaning --------------------------------------------------------------------------------


@query
def clean_trips(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query
def clean_accounting(spark, sf_dir):
    return clean.account(fixtures.trips(spark, sf_dir))


@query
def clean_written(spark, sf_dir):
    """The accounting of the job that writes the clean trips."""
    return clean.write_clean(fixtures.trips(spark, sf_dir), scratch_path(spark, "clean"))


@query
def dedupe_rows(spark, sf_dir):
    return clean.standardize(fixtures.trips(spark, sf_dir)).dropDuplicates()


@query
def duplicate_report(spark, sf_dir):
    return clean.duplicate_report(clean.standardize(fixtures.trips(spark, sf_dir)))


# --- validation ------------------------------------------------------------------------------


@query
def dataset_issues(spark, sf_dir):
    return validate.dataset_issues(fixtures.trips(spark, sf_dir))


@query
def dataset_issues_strict(spark, sf_dir):
    level = (
        F.when(F.col("passenger_count") == 1, "Low")
        .when(F.col("passenger_count") == 2, "Medium")
        .when(F.col("passenger_count") == 3, "High")
        .when(F.col("passenger_count").isNotNull(), "Standstill")
    )
    trips = fixtures.requests(spark, sf_dir).withColumns(
        {"traffic_level": level, TARGET: F.col("surge_multiplier") * 50}
    )
    return validate.dataset_issues(trips, strict_locations=True, check_drop=True)


@query
def missing_columns(spark, sf_dir):
    """A request table is no trip table; with the number of rows concerned."""
    requests = fixtures.requests(spark, sf_dir)
    return validate.dataset_issues(requests).withColumn("rows", requests.agg(F.count(F.lit(1))).scalar())


@query
def validation_messages(spark, sf_dir):
    issues = validate.dataset_issues(fixtures.trips(spark, sf_dir))
    return validate.issue_messages(issues).select("message")


@query
def unknown_places(spark, sf_dir):
    requests = fixtures.requests(spark, sf_dir)
    return validate.unknown_values(requests, "pickup_location", location_dimension(spark))


@query
def request_valid(spark, sf_dir):
    return validate.split_requests(fixtures.requests(spark, sf_dir))[0]


@query
def request_quarantine(spark, sf_dir):
    return as_text(validate.split_requests(fixtures.requests(spark, sf_dir))[1], "reasons")


@query
def batch_coercion(spark, sf_dir):
    return validate.coerce_batch(fixtures.requests(spark, sf_dir))


@query
def same_place_trips(spark, sf_dir):
    flagged = validate.flag_same_place(fixtures.trips(spark, sf_dir))
    return flagged.where("same_place").groupBy("pickup_location").agg(F.count(F.lit(1)).alias("n"))


# --- features --------------------------------------------------------------------------------


@query
def temporal_features(spark, sf_dir):
    return features.add_temporal(cleaned(spark, sf_dir), blank_rule="present")


@query
def haversine_distance(spark, sf_dir):
    trips = features.add_distance(fixtures.trips(spark, sf_dir), "km")
    return trips.select("trip_id", "pickup_location", "drop_location", "km")


@query
def haversine_unknown_place(spark, sf_dir):
    return features.add_distance(fixtures.requests(spark, sf_dir), "km").select("request_id", "km")


@query
def traffic_ordinal(spark, sf_dir):
    trips = fixtures.trips(spark, sf_dir)
    ordinal = features.traffic_ordinal(F.col("traffic_level")).alias("ordinal")
    return trips.groupBy("traffic_level", ordinal).agg(F.count(F.lit(1)).alias("n"))


@query
def traffic_by_clock(spark, sf_dir):
    valid, _ = validate.split_requests(fixtures.requests(spark, sf_dir))
    rows = features.request_features(valid)
    return rows.groupBy("pickup_hour", "is_weekend", "traffic_level").agg(F.count(F.lit(1)).alias("n"))


@query
def request_defaults(spark, sf_dir):
    filled = features.fill_request_defaults(fixtures.requests(spark, sf_dir))
    return filled.select("request_id", "passenger_count", "surge_multiplier")


@query
def location_frequency(spark, sf_dir):
    return features.value_frequency(cleaned(spark, sf_dir))


@query
def rare_locations(spark, sf_dir):
    return features.rare_values(cleaned(spark, sf_dir))


@query
def rare_grouped(spark, sf_dir):
    trips = materialize(cleaned(spark, sf_dir), "clean")
    return features.group_rare(trips, features.rare_values(trips))


@query
def train_test_split(spark, sf_dir):
    trips = cleaned(spark, sf_dir)
    return features.split_flag(trips, trips.columns)


@query
def exact_split(spark, sf_dir):
    trips = materialize(cleaned(spark, sf_dir), "clean")
    halves = features.exact_split(trips).groupBy("is_test")
    return halves.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(TARGET), 4).alias("total"))


def fitted(rows: DataFrame) -> features.FeatureModel:
    return features.FeatureModel.fit(rows, ~F.col("is_test"))


def sparse_rows(spark: SparkSession, sf_dir: str) -> tuple[encoding.SparseEncoder, DataFrame]:
    """The sparse encoder of all trips, and their vectors with target and split flag."""
    rows = stored_features(spark, sf_dir)
    encoder = encoding.SparseEncoder.fit(rows, ~F.col("is_test"))
    return encoder, encoder.transform(rows, keep=[TARGET, "is_test"]).select("features", TARGET, "is_test")


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table as a stage border: written once for the passes that follow."""
    return materialize(featured(spark, sf_dir), "features")


@query
def one_hot(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    model = fitted(rows)
    return model.transform(rows, keep=["is_test"]).select(
        *[features.quoted(c) for c in model.one_hot_columns], "is_test"
    )


@query
def training_features(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    return fitted(rows).transform(rows, keep=[TARGET, "is_test"])


@query
def many_places(spark, sf_dir):
    """A place for every pickup location and minute: how many trips each element of the sparse vector has."""
    rows = featured(spark, sf_dir).withColumn("pickup_location", F.concat_ws(" ", "pickup_location", "pickup_time"))
    rows = materialize(rows, "places")
    encoder = encoding.SparseEncoder.fit(rows, ~F.col("is_test"), TripRules(rare_below=2))
    stored = F.explode(F.arrays_zip(newton.entries("features")["at"], newton.entries("features")["value"]))
    hot = encoder.transform(rows).select(stored.alias("e")).select(F.col("e.at").alias("position"), F.col("e.value").alias("value"))
    counts = hot.where((F.col("position") >= len(NUMERIC)) & (F.col("value") == 1)).groupBy("position").agg(F.count("*").alias("n"))
    return encoder.names().where(F.col("feature").startswith("pickup_location_")).join(counts, "position", "left").select("position", "feature", F.coalesce("n", F.lit(0)).alias("n"))


@query
def request_feature_vector(spark, sf_dir):
    model = fitted(featured(spark, sf_dir))
    valid, _ = validate.split_requests(fixtures.requests(spark, sf_dir))
    return model.transform(features.request_features(valid), keep=["request_id"], group_rare=False)


@query
def union_append(spark, sf_dir):
    trips = fixtures.trips_from(fixtures.given(spark, sf_dir, "lineitem"), duplicates=False)
    batch = F.substring_index("trip_id", "-", 1).cast("bigint") % 50 == 0
    return writers.append_trips(trips.where(~batch), trips.where(batch).drop("time_of_day"))


# --- metrics ---------------------------------------------------------------------------------


@query
def baseline_metrics(spark, sf_dir):
    table = metrics.regression_metrics(scored(spark, sf_dir), TARGET, PREDICTED)
    return rounded(table, "r2", "mae", "rmse", "mape")


@query
def metrics_by_traffic(spark, sf_dir):
    table = metrics.regression_metrics(scored(spark, sf_dir), TARGET, PREDICTED, ["traffic_level"])
    return rounded(table, "r2", "mae", "rmse", "mape")


@query
def evaluation_report(spark, sf_dir):
    return metrics.evaluation_report(scored(spark, sf_dir), TARGET, PREDICTED)


@query
def candidate_leaderboard(spark, sf_dir):
    """Untrained candidates by error: speed by traffic, one speed for all, one duration for all."""
    return rounded(models.leaderboard(untrained_metrics(spark, sf_dir)), "test_r2", "test_rmse", "test_mae")


@query
def best_candidate(spark, sf_dir):
    """The candidate with the lowest error; the last one ties with the first and loses."""
    return rounded(models.best_model(untrained_metrics(spark, sf_dir)), "rmse")


def untrained_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).withColumns(
        {
            "one_speed": F.col("trip_distance_km") / F.lit(28.0) * 60.0,
            "one_duration": F.lit(20.0),
            "split": F.lit("test"),
        }
    )
    columns = {"TrafficSpeed": PREDICTED, "OneSpeed": "one_speed", "OneDuration": "one_duration", "Copy": PREDICTED}
    return metrics.compared_metrics(rows, TARGET, columns, by=["split"])


@query
def residual_table(spark, sf_dir):
    table = metrics.residuals(scored(spark, sf_dir), TARGET, PREDICTED)
    return rounded(table.select(TARGET, PREDICTED, "residual"), PREDICTED, "residual")


@query
def residual_histogram(spark, sf_dir):
    rows = metrics.residuals(scored(spark, sf_dir), TARGET, PREDICTED).select("residual")
    return rounded(metrics.histogram(materialize(rows, "residuals"), "residual", 40), "lower", "upper")


@query
def eta_histogram(spark, sf_dir):
    rows = materialize(scored(spark, sf_dir).select(PREDICTED), "predictions")
    return rounded(metrics.histogram(rows, PREDICTED, 25), "lower", "upper")


@query
def bucket_histogram(spark, sf_dir):
    return rounded(metrics.bucket_histogram(scored(spark, sf_dir), PREDICTED), "total_minutes", digits=4)


@query
def batch_summary(spark, sf_dir):
    table = metrics.batch_summary(cleaned(spark, sf_dir), TARGET)
    return rounded(table, "mean_minutes", "std_minutes", "mean_surge", "high_traffic_percent")


@query
def score_summary(spark, sf_dir):
    table = metrics.score_summary(scored(spark, sf_dir), PREDICTED)
    return rounded(table, *table.columns)


@query
def score_responses(spark, sf_dir):
    valid, _ = validate.split_requests(fixtures.requests(spark, sf_dir))
    answers = score.responses(score.score_requests(valid, score.baseline_predictor), "request_id")
    return answers.drop("timestamp")


@query
def request_counters(spark, sf_dir):
    return metrics.request_counters(fixtures.prediction_log(spark, sf_dir))


@query
def requests_per_minute(spark, sf_dir):
    return minute_text(metrics.requests_per_minute(fixtures.prediction_log(spark, sf_dir)))


def minute_text(table: DataFrame) -> DataFrame:
    return rounded(table.withColumn("window_start", clock_text("window_start")), "per_second")


@query
def sliding_histogram(spark, sf_dir):
    table = metrics.sliding_histogram(fixtures.prediction_log(spark, sf_dir))
    return table.withColumn("window_start", clock_text("window_start"))


def log_sides(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Predictions and the actual durations that arrive later, as two tables."""
    predictions = log.where(F.col("predicted_eta_minutes").isNotNull()).select(
        "event_id", "ts", "predicted_eta_minutes"
    )
    actuals = log.where(F.col("actual_ts").isNotNull()).select("event_id", "actual_ts", "actual_eta_minutes")
    return predictions, actuals


def monitored(matched: DataFrame) -> DataFrame:
    table = metrics.regression_metrics(matched, "actual_eta_minutes", "predicted_eta_minutes")
    return rounded(table, "r2", "mae", "rmse", "mape")


@query
def monitored_rmse(spark, sf_dir):
    return monitored(metrics.monitored_errors(*log_sides(fixtures.prediction_log(spark, sf_dir))))


def monitored_windows(matched: DataFrame) -> DataFrame:
    table = metrics.windowed_errors(matched).withColumn("window_start", clock_text("window_start"))
    return rounded(table, "r2", "mae", "rmse", "mape")


@query
def monitored_by_window(spark, sf_dir):
    return monitored_windows(metrics.monitored_errors(*log_sides(fixtures.prediction_log(spark, sf_dir))))


@query
def sample_trips(spark, sf_dir):
    return metrics.first_trips(fixtures.trips(spark, sf_dir), 50)


@query
def counter_rates(spark, sf_dir):
    """Six-hour rates of the request and minute counters, which start anew at three each night, and the mean minutes as their ratio."""
    log = fixtures.prediction_log(spark, sf_dir).where("predicted_eta_minutes IS NOT NULL")
    night = F.to_date(F.col("ts") - F.expr("INTERVAL 3 HOURS"))
    shown = Window.partitionBy("endpoint", night).orderBy("ts", "event_id")
    samples = log.select("endpoint", "ts", F.row_number().over(shown).cast("double").alias("requests"), F.sum("predicted_eta_minutes").over(shown).alias("minutes"))
    requests, minutes = (
        metrics.counter_rates(samples, ["endpoint"], "6 hours", c).select("endpoint", "window_start", F.col("increase").alias(f"{c}_increase"))
        for c in ("requests", "minutes")
    )
    table = requests.join(minutes, ["endpoint", "window_start"]).withColumn("window_start", clock_text("window_start"))
    ratio = F.col("minutes_increase") / F.nullif(F.col("requests_increase"), F.lit(0.0))
    return rounded(rounded(table, "requests_increase", "minutes_increase", digits=4).withColumn("mean_minutes", ratio), "mean_minutes")


# --- drift and policy ------------------------------------------------------------------------


@query
def ks_features(spark, sf_dir):
    return drift.feature_drift(changed_test_split(spark, sf_dir), DRIFT_COLUMNS, method="series")


@query
def ks_features_sliced(spark, sf_dir):
    """The same table by way of range-partitioned values."""
    tagged = changed_test_split(spark, sf_dir)
    return drift.feature_drift(tagged, DRIFT_COLUMNS, method="series", values_per_task=2_000)


@query
def ks_features_auto(spark, sf_dir):
    """The default p-value."""
    return drift.feature_drift(changed_test_split(spark, sf_dir), DRIFT_COLUMNS)


@query
def drift_summary(spark, sf_dir):
    return as_text(drift.drift_summary(ks_features(spark, sf_dir)), "drifted_features")


@query
def drift_all_columns(spark, sf_dir):
    """Every numeric column of the encoded table, dummies and target included."""
    rows = stored_features(spark, sf_dir)
    model = fitted(rows)
    tagged = model.transform(rows, keep=[TARGET, "is_test"]).withColumnRenamed("is_test", drift.SIDE)
    columns = [*model.columns, TARGET]
    return as_text(drift.drift_summary(drift.feature_drift(tagged, columns, method="series")), "drifted_features")


@query
def drift_report(spark, sf_dir):
    rows = materialize(numeric_rows(featured(spark, sf_dir), "is_test"), "split-rows")
    train, test = rows.where("NOT is_test").drop("is_test"), rows.where("is_test").drop("is_test")
    report = drift.drift_report(train, test, "train", "test", method="series")
    # Without the time, and with one row per feature, so that SQL can state it.
    flat = report.select(
        "reference_dataset",
        "current_dataset",
        "reference_rows",
        "current_rows",
        "drift_summary.*",
        F.explode("feature_metrics").alias("feature", "record"),
    )
    return as_text(flat.select("*", "record.*").drop("record"), "drifted_features")


@query
def chi_square_drift(spark, sf_dir):
    tagged = featured(spark, sf_dir).withColumn(drift.SIDE, F.col("is_test"))
    table = drift.chi_square(tagged, (*CATEGORICAL, "traffic_level"))
    return rounded(rounded(table, "statistic"), "p_value", digits=5)


@query
def drift_by_kind(spark, sf_dir):
    """Train rows against test rows whose trips take half as long again, each column by the test of its kind."""
    columns = ("pickup_hour", "trip_distance_km", "passenger_count", "is_weekend", TARGET, *CATEGORICAL, "traffic_level")
    rows = featured(spark, sf_dir).withColumn(TARGET, F.when(F.col("is_test"), F.col(TARGET) * 1.5).otherwise(F.col(TARGET)))
    table = drift.drift_by_kind(rows.withColumn(drift.SIDE, F.col("is_test")), columns)
    return rounded(table, "value", "jensen_shannon", "wasserstein", "z")


@query
def what_if(spark, sf_dir):
    test = featured(spark, sf_dir).where("is_test")
    return rounded(drift.what_if(numeric_rows(test), 1.5), TARGET)


@query
def what_if_summary(spark, sf_dir):
    test = numeric_rows(featured(spark, sf_dir).where("is_test"))
    return as_text(drift.what_if_summary(test, DRIFT_COLUMNS, method="series"), "drifted_features")


def decision_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows, and what-if test rows as the current side, with the untrained prediction."""
    rows = with_baseline(featured(spark, sf_dir)).withColumn(drift.SIDE, F.col("is_test"))
    rows = rows.withColumn("traffic_level", features.traffic_ordinal(F.col("traffic_level")))
    return materialize(
        drift.what_if(rows, 1.5, only=F.col("is_test")).select(*DRIFT_COLUMNS, PREDICTED, drift.SIDE),
        "decision-rows",
    )


def side_errors(rows: DataFrame) -> DataFrame:
    """(baseline, current) errors in one pass."""
    error = (F.col(TARGET) - F.col(PREDICTED)) * (F.col(TARGET) - F.col(PREDICTED))
    side = F.col(drift.SIDE)
    sums = rows.agg(
        F.sqrt(F.avg(F.when(~side, error))).alias("baseline"), F.sqrt(F.avg(F.when(side, error))).alias("current")
    )
    return materialize(sums, "side-errors")


@query
def retrain_decision(spark, sf_dir):
    """Baseline error on the training rows, measured error on the what-if test rows."""
    rows = decision_rows(spark, sf_dir)
    summary = drift.drift_summary(drift.feature_drift(rows, DRIFT_COLUMNS))
    errors = side_errors(rows)
    decision = policy.retrain_decision(errors.select("baseline"), errors.select("current"), summary)
    return rounded(as_text(decision, "reasons", " "), "baseline_rmse", digits=4)


@query
def decision_from_files(spark, sf_dir):
    """The same decision from a stored model record and a stored drift report, itself stored and read."""
    rows = decision_rows(spark, sf_dir)
    errors = side_errors(rows)
    record = errors.select(F.lit("Untrained").alias("model"), F.col("baseline").alias("test_rmse"))
    record = readers.read_report(spark, writers.write_report(record, scratch_path(spark, "record")), MODEL_METADATA)
    sides = [rows.where(part).select(*DRIFT_COLUMNS) for part in (~F.col(drift.SIDE), F.col(drift.SIDE))]
    report = drift.drift_report(*sides, "train", "what-if", DRIFT_COLUMNS)
    report = readers.read_report(spark, writers.write_report(report, scratch_path(spark, "report")), DRIFT_REPORT)
    baseline = policy.baseline_metrics(record)
    decision = policy.retrain_decision(baseline.select("baseline_rmse"), errors.select("current"), report.select("drift_summary.*"))
    path = writers.write_report(decision, scratch_path(spark, "decision"))
    stored = readers.read_report(spark, path, decision.schema)
    return rounded(as_text(stored, "reasons", " "), "baseline_rmse", digits=4)


# --- models ----------------------------------------------------------------------------------


@query
def ridge_fit(spark, sf_dir):
    names = ["trip_distance_km", "traffic_level"]
    train = numeric_rows(featured(spark, sf_dir).where("NOT is_test")).select(*names, TARGET)
    model = models.fit_ridge(features.assemble(materialize(train, "ridge"), names))
    return rounded(models.ridge_coefficients(model, names), "coefficient")


def two_feature_ridge(spark: SparkSession, sf_dir: str):
    """A ridge on distance and traffic, whose solution SQL can state, with its train and test rows."""
    plain = features.FeatureModel(kept={}, categories={}, numeric=("trip_distance_km", "traffic_level"))
    rows = plain.transform(featured(spark, sf_dir), keep=[TARGET, "is_test"])
    table = plain.assemble(materialize(rows, "ridge-rows")).select("features", TARGET, "is_test")
    train, test = (table.where(part).drop("is_test") for part in ("NOT is_test", "is_test"))
    return plain, models.fit_ridge(train), train, test


@query
def ridge_metrics(spark, sf_dir):
    _, model, train, test = two_feature_ridge(spark, sf_dir)
    table = models.model_metrics({"RidgeRegression": model}, train, test)
    return rounded(table, "r2", "mae", "rmse", "mape")


@query
def ridge_responses(spark, sf_dir):
    """Validated requests scored with a fitted model."""
    plain, model, _, _ = two_feature_ridge(spark, sf_dir)
    valid, _ = validate.split_requests(fixtures.requests(spark, sf_dir))
    answers = score.responses(score.score_requests(valid, score.model_predictor(plain, model)), "request_id")
    return answers.drop("timestamp")


# Fits of a session by application and content of the encoded rows: encoder, stored models and rows.
_fits: dict[tuple, tuple[encoding.SparseEncoder, dict, DataFrame]] = {}


def fitted_candidates(spark: SparkSession, sf_dir: str):
    """(encoder, models, encoded rows): all candidates, fitted on every feature.

    The fits take most of the time of the queries below, so a session keeps them, as stored tables and models. They are found by a
    checksum of the encoded rows, so other rows under the same path are fitted anew.
    """
    encoder, encoded = sparse_rows(spark, sf_dir)
    encoded = materialize(encoded, "encoded")
    vector = F.unwrap_udt("features")
    digest = F.xxhash64(vector["indices"], vector["values"], TARGET, "is_test")
    key = spark.sparkContext.applicationId, *encoded.agg(F.count("*"), F.bit_xor(digest), F.sum(F.shiftright(digest, 20))).first()
    if key not in _fits:
        # Each level of a second-order tree is a job, so here it has few rounds and a high rate.
        settings = ModelSettings(newton_rounds=6, newton_rate=0.5)
        train = encoded.where("NOT is_test").select("features", TARGET)
        found = models.fit_all(train, models.candidates(settings), together=("GradientBoosting", "RandomForest", "NewtonBoosting"))
        stored = {}
        for name, model in found.items():
            # Grown trees are loaded from where they were stored; once more would hold them twice.
            if not hasattr(model, "stored_at"):
                path = scratch_path(spark, name)
                model.write().save(path)
                model = type(model).load(path)
            stored[name] = model
        _fits[key] = encoder, stored, encoded
    return _fits[key]


def candidate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_of(*fitted_candidates(spark, sf_dir)[1:])


def metrics_of(found: dict, encoded: DataFrame) -> DataFrame:
    train, test = (encoded.where(part).drop("is_test") for part in ("NOT is_test", "is_test"))
    return materialize(models.model_metrics(found, train, test), "candidate-metrics")


@query
def model_metrics_checks(spark, sf_dir):
    """All candidates on both splits: their rows, and whether the errors are in order.

    On the rows it was fitted on, a model has to beat the mean as a predictor.
    """
    table = candidate_metrics(spark, sf_dir)
    in_order = (F.col("rmse") >= F.col("mae")) & (F.col("mae") > 0) & ((F.col("split") == "test") | (F.col("r2") > 0))
    return table.select("ord", "model", "split", "n", in_order.alias("in_order"))


@query
def model_leaderboard(spark, sf_dir):
    return models.leaderboard(candidate_metrics(spark, sf_dir))


@query
def leaderboard_checks(spark, sf_dir):
    """Ranks, order of the errors, and whether the record names the lowest."""
    table = candidate_metrics(spark, sf_dir)
    board = models.leaderboard(table)
    best = models.model_record(table).select("model", "test_rmse").alias("r")
    rolled = board.agg(
        F.count("*").alias("candidates"), F.min_by("model", "test_rmse").alias("first"), F.min("test_rmse").alias("lowest")
    )
    return rolled.crossJoin(F.broadcast(best)).select(  # one row each
        "candidates", (F.col("first") == F.col("r.model")).alias("record_is_first"), (F.col("lowest") == F.col("r.test_rmse")).alias("record_is_lowest")
    )


@query
def best_model_record(spark, sf_dir):
    return models.model_record(candidate_metrics(spark, sf_dir))


@query
def forest_importances(spark, sf_dir):
    encoder, found, _ = fitted_candidates(spark, sf_dir)
    return models.feature_importances(found["RandomForest"], encoder.columns)


@query
def importance_checks(spark, sf_dir):
    """The table of the leading features: its length, its order, and what all features add up to."""
    encoder, found, _ = fitted_candidates(spark, sf_dir)
    names = encoder.columns
    every = models.feature_importances(found["RandomForest"], names, top=len(names))
    top = models.feature_importances(found["RandomForest"], names).select("importance")
    return top.agg(F.count("*").alias("listed"), F.min("importance").alias("_low")).crossJoin(
        every.agg(F.round(F.sum("importance"), 6).alias("total"), F.sort_array(F.collect_list("importance"), False).alias("_all"))
    ).select("listed", "total", (F.element_at("_all", 20) == F.col("_low")).alias("are_the_largest"))


@query
def gbt_metrics(spark, sf_dir):
    return candidate_metrics(spark, sf_dir).where("model = 'GradientBoosting'")


@query
def newton_splits(spark, sf_dir):
    """Every split that the root of the first boosted tree could take, with its gain and leaf values."""
    names = ["pickup_hour", "month", "passenger_count", "traffic_level"]
    train = numeric_rows(featured(spark, sf_dir).where("NOT is_test")).select(*names, TARGET)
    found = newton.root_splits(features.assemble(train, names), newton.NewtonSettings(rate=0.1))
    name = F.get(F.array(*[F.lit(n) for n in names]), F.col("feature"))
    return rounded(rounded(found.withColumn("feature", name), "gain", digits=3), "left_value", "right_value")


@query
def ridge_residuals(spark, sf_dir):
    """Normal equations of the ridge on every feature: what is left of each, relative to the rows.

    The gradient of the squared error and of the penalty is 0 for every coefficient at the optimum.
    """
    encoder, encoded = sparse_rows(spark, sf_dir)
    train = materialize(encoded.where("NOT is_test").select("features", TARGET), "ridge-rows")
    model = models.fit_ridge(train)
    rows = model.transform(train)
    gap = F.col(TARGET) - F.col(model.getPredictionCol())
    stored = F.explode(F.arrays_zip(newton.entries("features")["at"], newton.entries("features")["value"])).alias("e")
    sums = rows.select(stored, gap.alias("gap")).groupBy(F.col("e.at").alias("at")).agg(F.sum(F.col("e.value") * F.col("gap")).alias("v"))
    sums = sums.crossJoin(rows.agg(F.count("*").alias("n")))  # one row
    terms = spark.createDataFrame([(k, n, float(c)) for k, (n, c) in enumerate(zip(encoder.columns, model.coefficients.toArray()))], "at int, feature string, c double")
    left = F.abs(F.col("v") - ModelSettings.ridge_alpha * F.col("c")) / F.col("n")
    return terms.join(sums, "at").agg(F.count_if(left > 1e-3).alias("unbalanced"), F.max("n").alias("n"))


def full_ridge(spark: SparkSession, sf_dir: str):
    """Feature model and ridge on all features, with the encoded test rows."""
    encoder, table = sparse_rows(spark, sf_dir)
    table = materialize(table, "ridge-rows")
    train, test = table.where("NOT is_test"), table.where("is_test")
    return encoder, models.fit_ridge(train.select("features", TARGET)), test


@query
def stored_model_evaluation(spark, sf_dir):
    """Fit, save, load, evaluate."""
    _, model, test = full_ridge(spark, sf_dir)
    path = scratch_path(spark, "ridge")
    model.write().overwrite().save(path)
    return models.evaluate_stored(type(model).load(path), test)


@query
def batch_scoring(spark, sf_dir):
    """Validated requests scored with the fitted ridge."""
    encoder, model, _ = full_ridge(spark, sf_dir)
    return ridge_answers(spark, sf_dir, encoder, model)


def ridge_answers(spark: SparkSession, sf_dir: str, encoder: encoding.SparseEncoder, model) -> DataFrame:
    valid, _ = validate.split_requests(fixtures.requests(spark, sf_dir))
    answers = score.responses(score.score_requests(valid, score.model_predictor(encoder, model)), "request_id")
    return answers.drop("timestamp")


@query
def stored_model_checks(spark, sf_dir):
    """Metrics of a model before it is stored and after it is loaded."""
    _, model, test = full_ridge(spark, sf_dir)
    path = scratch_path(spark, "ridge")
    model.write().overwrite().save(path)
    before = models.evaluate_stored(model, test).alias("b")
    after = models.evaluate_stored(type(model).load(path), test).alias("a")
    same = F.to_json(F.struct("b.*")) == F.to_json(F.struct("a.*"))
    return before.crossJoin(after).select(same.alias("same"))  # one row each


@query
def batch_scoring_checks(spark, sf_dir):
    """Every valid request gets an answer at or above the floor that equals the model's own sum."""
    encoder, model, _ = full_ridge(spark, sf_dir)
    valid, _ = validate.split_requests(fixtures.requests(spark, sf_dir))
    # Written once: they are counted and compared.
    answers = materialize(ridge_answers(spark, sf_dir, encoder, model).select("request_id", "eta_minutes"), "answers")
    rows = encoder.dense().transform(features.request_features(valid), keep=["request_id"], group_rare=False)
    total = F.lit(float(model.intercept))
    for name, c in zip(encoder.columns, model.coefficients.toArray()):
        total = total + features.quoted(name) * float(c)
    own = rows.select(F.col("request_id").alias("id"), F.greatest(total, F.lit(Floors.serve)).alias("own"))
    # A few request ids repeat, so an answer has to equal one of its id's sums.
    like = (F.col("id") == F.col("request_id")) & (F.abs(F.col("own") - F.col("eta_minutes")) <= 0.00501)
    unlike = answers.join(own, like, "left_anti").agg(F.count("*").alias("unlike"))
    return answers.agg(F.count("*").alias("answers")).crossJoin(unlike)  # one row each


@query
def model_info(spark, sf_dir):
    encoder, found, encoded = fitted_candidates(spark, sf_dir)
    return models.model_info(models.model_record(metrics_of(found, encoded)), len(encoder.columns))


def scaled_ridge(rows: DataFrame, factor: float):
    """A ridge on distance and traffic for durations that are ``factor`` times as long."""
    plain = features.FeatureModel(kept={}, categories={}, numeric=("trip_distance_km", "traffic_level"))
    longer = plain.transform(rows.where("NOT is_test").withColumn(TARGET, F.col(TARGET) * factor), keep=[TARGET])
    return plain, models.fit_ridge(plain.assemble(longer))


@query
def closed_loop(spark, sf_dir):
    """Trips take half as long again: the measured error triggers a fit, and the better model becomes champion. Then nothing is left to do."""
    rows = stored_features(spark, sf_dir)
    now = rows.where("is_test").withColumn(TARGET, F.col(TARGET) * 1.5)
    store = registry.ModelStore(spark, scratch_path(spark, "store"))
    store.promote(store.publish(*scaled_ridge(rows, 1.0)))
    done = []
    baseline = spark.createDataFrame([(registry.rmse(*store.load(1), rows.where("is_test")),)], "rmse double")
    for _ in range(2):
        measured = spark.createDataFrame([(registry.rmse(*store.load(store.champion()), now),)], "rmse double")
        decision = policy.retrain_decision(baseline, measured)
        done.append(materialize(registry.act_on(decision, store, lambda: scaled_ridge(rows, 1.5), now), "outcome"))
        baseline = measured
    table = done[0].withColumn("step", F.lit(1)).unionByName(done[1].withColumn("step", F.lit(2)))
    return rounded(table.drop("reason"), "champion_rmse", "candidate_rmse", digits=4)


@query
def stream_followed(spark, sf_dir):
    """Requests that arrive in four parts, a micro-batch each; a second model is promoted after two of them."""
    rows = stored_features(spark, sf_dir)
    store = registry.ModelStore(spark, scratch_path(spark, "store"))
    asked = fixtures.requests(spark, sf_dir)
    incoming, folder = scratch_path(spark, "incoming"), scratch_path(spark, "followed")
    part = F.conv(F.substring(F.md5("request_id"), 1, 4), 16, 10).cast("int") % 4
    asked = materialize(asked.withColumn("part", part), "requests")
    for k in range(4):
        if k % 2 == 0:
            store.promote(store.publish(*scaled_ridge(rows, 1.0 + k / 4)))
        # Every task writes a file, and a run takes all files that came since the last one as one micro-batch.
        asked.where(F.col("part") == k).drop("part").write.mode("append").parquet(incoming)
        stream = jobs.file_stream(spark, incoming, asked.drop("part").schema)
        jobs.finish(jobs.score_stream_following(stream, folder, store, "request_id"))
    return spark.read.parquet(f"{folder}/data").select("request_id", "model_version", "predicted_eta_minutes")


# --- sources and sinks -----------------------------------------------------------------------


@query
def append_round_trip(spark, sf_dir):
    """A table, and a batch appended to it without a rewrite."""
    trips = fixtures.trips(spark, sf_dir)
    is_batch = F.col("trip_id").startswith("dup-")
    path = writers.write_table(trips.where(~is_batch), scratch_path(spark, "raw"))
    writers.append_table(trips.where(is_batch), path)
    return readers.read_table(spark, path)


@query
def csv_round_trip(spark, sf_dir):
    path = writers.write_table(fixtures.trips(spark, sf_dir), scratch_path(spark, "trips-csv"), "csv")
    return readers.read_trips_csv(spark, path)


@query
def staged_batches(spark, sf_dir):
    """One staged batch of whole rows per traffic level, read back as one table."""
    folder = scratch_path(spark, "incoming")
    return readers.read_table(spark, writers.stage_batches(fixtures.trips(spark, sf_dir), folder, "traffic_level"))


@query
def prediction_log_append(spark, sf_dir):
    valid, _ = validate.split_requests(fixtures.requests(spark, sf_dir))
    rows = score.log_rows(score.score_requests(valid, score.baseline_predictor), "request_id")
    path = writers.append_predictions(rows, scratch_path(spark, "prediction-log"))
    return readers.read_table(spark, path).drop("timestamp", "log_date")


@query
def ragged_log(spark, sf_dir):
    """The log as comma-separated text: error rows in the older eight-field layout."""
    log = fixtures.prediction_log(spark, sf_dir)
    cents = F.floor(F.col("predicted_eta_minutes") * 100) / F.lit(100).cast("double")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    current = F.concat_ws(
        ",", F.concat(stamp, F.lit("+00:00")), F.lit("Harlem"), F.lit("Midtown"), F.lit("2026-08-27"),
        F.lit("17:30"), F.lit("6.9"), F.lit("High"), cents.cast("string"), F.lit(""),
    )
    older = F.concat_ws(",", stamp, *[F.lit(x) for x in ("1", "5.2", "17", "2", "0", "1588.62", "")])
    lines = log.select(F.when(F.col("status") == "error", older).otherwise(current).alias("value"))
    path = scratch_path(spark, "log-text")
    lines.write.text(path)
    rows = readers.read_log_text(spark, path)
    return rows.groupBy("is_legacy").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.when(~F.col("is_legacy"), F.col("predicted_eta_minutes"))), 4).alias("total_minutes"),
    )


@query
def report_round_trip(spark, sf_dir):
    """Drift summary → JSON document → summary."""
    found = drift.drift_summary(ks_features(spark, sf_dir))
    document = found.select(F.lit("train").alias("reference_dataset"), F.struct(*found.columns).alias("drift_summary"))
    path = writers.write_report(document, scratch_path(spark, "drift-json"))
    report = readers.read_report(spark, path, DRIFT_REPORT, {"current_dataset": "test"})
    return as_text(report.select("drift_summary.*"), "drifted_features")


@query
def feature_model_round_trip(spark, sf_dir):
    model = fitted(featured(spark, sf_dir))
    path = scratch_path(spark, "feature-model")
    model.save(spark, path)
    loaded = features.FeatureModel.load(spark, path)
    valid, _ = validate.split_requests(fixtures.requests(spark, sf_dir))
    return loaded.transform(features.request_features(valid), keep=["request_id"], group_rare=False)


# --- streams ---------------------------------------------------------------------------------


def streamed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table as a file stream (a single file or a folder of files)."""
    # A stream source takes a folder or a glob, not the path of one file.
    glob = f"{sf_dir}/{table}.parque[t]"
    return jobs.file_stream(spark, glob, fixtures.given(spark, sf_dir, table).schema)


def run(spark: SparkSession, label: str, start: Callable[[str], object]) -> str:
    folder = scratch_path(spark, label)
    jobs.finish(start(folder))
    return folder


def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.event_time(fixtures.prediction_log_from(streamed(spark, sf_dir, "events")))


@query
def stream_clean(spark, sf_dir):
    raw = fixtures.trips_from(streamed(spark, sf_dir, "lineitem"))
    return jobs.cleaned_so_far(spark, run(spark, "stream-clean", lambda f: jobs.clean_stream(raw, f)))


@query
def stream_staged_clean(spark, sf_dir):
    """Staged batches of whole rows, cleaned as a stream."""
    trips = fixtures.trips(spark, sf_dir)
    folder = writers.stage_batches(trips, scratch_path(spark, "incoming"), "traffic_level")
    staged = jobs.file_stream(spark, f"{folder}/batch=*", trips.schema)
    return jobs.cleaned_so_far(spark, run(spark, "stream-staged", lambda f: jobs.clean_stream(staged, f)))


@query
def stream_rejected(spark, sf_dir):
    raw = fixtures.trips_from(streamed(spark, sf_dir, "lineitem"))
    folder = run(spark, "stream-clean", lambda f: jobs.clean_stream(raw, f))
    return spark.read.parquet(f"{folder}/rejected").drop("batch_id")


@query
def stream_scored(spark, sf_dir):
    requests = fixtures.requests_from(streamed(spark, sf_dir, "lineitem"))
    folder = run(
        spark, "stream-scored",
        lambda f: jobs.score_stream(requests, f, score.baseline_predictor, "request_id"),
    )
    return spark.read.parquet(f"{folder}/data").drop("timestamp")


@query
def stream_scored_model(spark, sf_dir):
    """A fitted model on the stream: its answers, and how many differ from those of a batch."""
    encoder, model, _ = full_ridge(spark, sf_dir)
    predict = score.model_predictor(encoder, model)
    requests = fixtures.requests_from(streamed(spark, sf_dir, "lineitem"))
    folder = run(spark, "stream-model", lambda f: jobs.score_stream(requests, f, predict, "request_id"))
    answers = ["request_id", F.round("predicted_eta_minutes", 6).alias("minutes")]
    valid, _ = validate.split_requests(fixtures.requests(spark, sf_dir))
    batch = score.log_rows(score.score_requests(valid, predict), "request_id").select(*answers)
    got = spark.read.parquet(f"{folder}/data").select(*answers)
    unlike = got.exceptAll(batch).agg(F.count("*").alias("unlike"))
    return got.agg(F.count("*").alias("answers")).crossJoin(unlike)  # one row each


@query
def stream_quarantine(spark, sf_dir):
    requests = fixtures.requests_from(streamed(spark, sf_dir, "lineitem"))
    folder = run(spark, "stream-quarantine", lambda f: jobs.quarantine_stream(requests, f))
    return as_text(spark.read.parquet(f"{folder}/data"), "reasons")


@query
def stream_counts(spark, sf_dir):
    log = log_stream(spark, sf_dir)
    folder = run(spark, "stream-counts", lambda f: jobs.count_stream(log, f, finished_only=False))
    return minute_text(jobs.latest(spark, folder))


@query
def stream_histogram(spark, sf_dir):
    log = log_stream(spark, sf_dir)
    folder = run(spark, "stream-histogram", lambda f: jobs.histogram_stream(log, f, finished_only=False))
    return jobs.latest(spark, folder).withColumn("window_start", clock_text("window_start"))


@query
def stream_counts_closed(spark, sf_dir):
    """Windows that the watermark has passed."""
    log = log_stream(spark, sf_dir)
    folder = run(spark, "stream-counts-closed", lambda f: jobs.count_stream(log, f))
    return minute_text(spark.read.parquet(f"{folder}/data"))


@query
def stream_histogram_closed(spark, sf_dir):
    log = log_stream(spark, sf_dir)
    folder = run(spark, "stream-histogram-closed", lambda f: jobs.histogram_stream(log, f))
    return spark.read.parquet(f"{folder}/data").withColumn("window_start", clock_text("window_start"))


@query
def stream_dedupe(spark, sf_dir):
    """Every request arrives twice; each is kept once."""
    log = log_stream(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    folder = run(spark, "stream-dedupe", lambda f: jobs.dedupe_stream(log, f))
    return spark.read.parquet(f"{folder}/data").drop("ts", "actual_ts")


def matched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    def source(column: str) -> DataFrame:
        return jobs.event_time(fixtures.prediction_log_from(streamed(spark, sf_dir, "events")), column)

    predictions, _ = log_sides(source("ts"))
    _, actuals = log_sides(source("actual_ts"))
    folder = run(spark, "stream-match", lambda f: jobs.match_stream(predictions, actuals, f))
    return spark.read.parquet(f"{folder}/data")


@query
def stream_monitored_rmse(spark, sf_dir):
    return monitored(matched_stream(spark, sf_dir))


@query
def stream_monitored_by_window(spark, sf_dir):
    """Matched by the stream, then summed up per hour from what it appended."""
    return monitored_windows(matched_stream(spark, sf_dir))


def covered(matched: DataFrame) -> DataFrame:
    """Coverage of the hours that are over: four hours for the actuals and the watermark's delay have passed since."""
    last = matched.agg(F.max("ts").cast("timestamp").alias("last")).scalar()
    over = F.col("window_start") + F.expr("INTERVAL 5 HOURS") < last - F.expr("INTERVAL 11 MINUTES")
    table = metrics.coverage(matched).where(over).withColumn("window_start", clock_text("window_start"))
    return rounded(table, "coverage", "rmse")


@query
def coverage_by_window(spark, sf_dir):
    """How many predictions of an hour got an actual duration, and their error."""
    return covered(metrics.monitored_errors(*log_sides(fixtures.prediction_log(spark, sf_dir)), unmatched=True))


@query
def stream_coverage(spark, sf_dir):
    """The same from a stream that appends unmatched predictions once their time is over."""
    predictions, _ = log_sides(log_stream(spark, sf_dir))
    _, actuals = log_sides(jobs.event_time(fixtures.prediction_log_from(streamed(spark, sf_dir, "events")), "actual_ts"))
    folder = run(spark, "stream-coverage", lambda f: jobs.match_stream(predictions, actuals, f, unmatched=True))
    return covered(spark.read.parquet(f"{folder}/data"))


@query
def consumed_batches(spark, sf_dir):
    """Trips staged as time-named batches, cleaned by a stream that archives them; the second batch comes between two runs."""
    trips = fixtures.trips(spark, sf_dir)
    root = scratch_path(spark, "staged")
    part = F.pmod(F.xxhash64("trip_id"), F.lit(2))
    for k in range(2):
        writers.stage_batch_at(trips.where(part == k), f"{root}/incoming", datetime(2026, 1, 1, k))
        stream = jobs.incoming_stream(spark, f"{root}/incoming", trips.schema, f"{root}/archive")
        jobs.finish(jobs.clean_stream(stream, f"{root}/out"))
    return jobs.cleaned_so_far(spark, f"{root}/out")


def drift_streamed(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the drift stream. Baseline: the training rows. Stream: the raw trips, copies included; what-if test rows are tested."""
    rows = with_baseline(featured(spark, sf_dir).where("NOT is_test"))
    rows = rows.withColumn("traffic_level", features.traffic_ordinal(F.col("traffic_level")))
    baseline = materialize(rows.select(*DRIFT_COLUMNS, PREDICTED), "baseline")
    usable = clean.drop_unusable(clean.standardize(fixtures.trips_from(streamed(spark, sf_dir, "lineitem"))))
    # Copies are equal in all columns and so in the flag: filtered before they are told, training rows need no state.
    test_rows = features.split_flag(usable, usable.columns).where("is_test").drop("is_test")

    def tested(trips: DataFrame) -> DataFrame:
        test = with_baseline(features.trip_features(trips))
        test = test.withColumn("traffic_level", features.traffic_ordinal(F.col("traffic_level")))
        return drift.what_if(test, 1.5).select(*DRIFT_COLUMNS, PREDICTED)

    def errors(df: DataFrame) -> DataFrame:
        error = F.col(TARGET) - F.col(PREDICTED)
        return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))

    return run(
        spark, "stream-drift",
        lambda f: jobs.drift_stream(test_rows, f, baseline, DRIFT_COLUMNS, errors(baseline), errors, method="series", once=True, derive=tested),
    )


@query
def stream_accounting(spark, sf_dir):
    """What the cleaning stream dropped, added up over its micro-batches."""
    raw = fixtures.trips_from(streamed(spark, sf_dir, "lineitem"))
    folder = run(spark, "stream-accounting", lambda f: jobs.clean_stream(raw, f))
    rows = spark.read.parquet(f"{folder}/accounting").drop("batch_id")
    return rows.agg(*[F.sum(c).alias(c) for c in rows.columns])


@query
def stream_drift(spark, sf_dir):
    """The drift summary of the stream; its decision is ``stream_decision``."""
    folder = drift_streamed(spark, sf_dir)
    return as_text(spark.read.parquet(f"{folder}/summary").drop("batch_id"), "drifted_features")


@query
def stream_decision(spark, sf_dir):
    """The decision of the drift stream."""
    decision = spark.read.parquet(f"{drift_streamed(spark, sf_dir)}/decision").drop("batch_id")
    return rounded(as_text(decision, "reasons", " "), "baseline_rmse", digits=4)
