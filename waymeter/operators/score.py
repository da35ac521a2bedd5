"""Scoring of requests, in batch or on a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.operators.encoding import SparseEncoder
from waymeter.operators.features import FeatureModel, request_features
from waymeter.operators.metrics import baseline_minutes, floored
from waymeter.params import Floors

PREDICTION = "eta"
Predictor = Callable[[DataFrame], DataFrame]
ECHO = ("pickup_location", "drop_location", "pickup_date", "pickup_time")


def baseline_predictor(df: DataFrame) -> DataFrame:
    """Untrained predictor: distance over the speed of the traffic level."""
    minutes = baseline_minutes(F.col("trip_distance_km"), F.col("traffic_level"))
    return df.withColumn(PREDICTION, minutes)


def model_predictor(features: FeatureModel | SparseEncoder, model: Model) -> Predictor:
    """Predictor from a fitted feature model, dense or sparse, and a regressor."""

    def predict(df: DataFrame) -> DataFrame:
        carried = [c for c in df.columns if c not in features.numeric]
        # The numeric features become doubles; the text traffic level is carried under another name.
        df = df.withColumn("_traffic", F.col("traffic_level"))
        wide = features.transform(df, keep=[*carried, "_traffic"], group_rare=False)
        scored = model.copy().setPredictionCol(PREDICTION).transform(features.assemble(wide))
        return scored.select(
            *carried, F.col("_traffic").alias("traffic_level"), "trip_distance_km", PREDICTION
        )

    return predict


def score_requests(valid: DataFrame, predict: Predictor, floor: float = Floors.serve) -> DataFrame:
    """Valid requests → features → prediction, never below the floor."""
    scored = predict(request_features(valid))
    return scored.withColumn(PREDICTION, floored(F.col(PREDICTION), floor))


def responses(scored: DataFrame, *extra: str) -> DataFrame:
    """The answer to each request: rounded minutes and seconds, distance, traffic and the echo."""
    minutes = F.col(PREDICTION)
    return scored.select(
        *extra,
        F.lit(True).alias("success"),
        F.round(minutes, 2).alias("eta_minutes"),
        F.round(minutes * 60.0, 1).alias("eta_seconds"),
        F.col("trip_distance_km").alias("calculated_distance_km"),
        F.col("traffic_level").alias("estimated_traffic_level"),
        *ECHO,
        F.current_timestamp().alias("timestamp"),
    )


def log_rows(scored: DataFrame, *extra: str) -> DataFrame:
    """What goes into the prediction log; the actual duration is not known yet."""
    return scored.select(
        *extra,
        F.current_timestamp().alias("timestamp"),
        *ECHO,
        F.col("trip_distance_km").alias("distance_km"),
        "traffic_level",
        F.round(PREDICTION, 2).alias("predicted_eta_minutes"),
        F.lit(None).cast("double").alias("actual_eta_minutes"),
    )
