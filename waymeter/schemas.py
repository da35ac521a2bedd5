"""Explicit schemas of the tables that cross a storage border."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TRIP = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("pickup_location", T.StringType()),
        T.StructField("drop_location", T.StringType()),
        T.StructField("pickup_date", T.StringType()),
        T.StructField("pickup_time", T.StringType()),
        T.StructField("time_of_day", T.StringType()),
        T.StructField("season", T.StringType()),
        T.StructField("weekday", T.StringType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("pickup_hour", T.IntegerType()),
        T.StructField("pickup_minute", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance_km", T.DoubleType()),
        T.StructField("surge_multiplier", T.DoubleType()),
        T.StructField("traffic_level", T.StringType()),
        T.StructField("average_speed", T.DoubleType()),
        T.StructField("actual_eta_minutes", T.DoubleType()),
    ]
)

REQUEST = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("pickup_location", T.StringType()),
        T.StructField("drop_location", T.StringType()),
        T.StructField("pickup_date", T.StringType()),
        T.StructField("pickup_time", T.StringType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("surge_multiplier", T.DoubleType()),
    ]
)

# The text log has nine fields; rows of an older layout have eight.
PREDICTION_LOG = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("pickup_location", T.StringType()),
        T.StructField("drop_location", T.StringType()),
        T.StructField("pickup_date", T.StringType()),
        T.StructField("pickup_time", T.StringType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("traffic_level", T.StringType()),
        T.StructField("predicted_eta_minutes", T.DoubleType()),
        T.StructField("actual_eta_minutes", T.DoubleType()),
    ]
)

DRIFT_SUMMARY = T.StructType(
    [
        T.StructField("dataset_drift_detected", T.BooleanType()),
        T.StructField("drift_share", T.DoubleType()),
        T.StructField("drifted_features_count", T.LongType()),
        T.StructField("drifted_features", T.ArrayType(T.StringType())),
        T.StructField("total_features_tested", T.LongType()),
    ]
)

FEATURE_RECORD = T.StructType(
    [
        T.StructField("drift_detected", T.BooleanType()),
        T.StructField("p_value", T.DoubleType()),
        T.StructField("ks_statistic", T.DoubleType()),
        T.StructField("ref_mean", T.DoubleType()),
        T.StructField("curr_mean", T.DoubleType()),
    ]
)

DRIFT_REPORT = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("reference_dataset", T.StringType()),
        T.StructField("current_dataset", T.StringType()),
        T.StructField("reference_rows", T.LongType()),
        T.StructField("current_rows", T.LongType()),
        T.StructField("drift_summary", DRIFT_SUMMARY),
        T.StructField("feature_metrics", T.MapType(T.StringType(), FEATURE_RECORD)),
    ]
)

MODEL_METADATA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("test_rmse", T.DoubleType()),
        T.StructField("test_mae", T.DoubleType()),
        T.StructField("test_r2", T.DoubleType()),
    ]
)
