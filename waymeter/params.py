"""Default thresholds, vocabularies and model settings."""

from __future__ import annotations

from dataclasses import dataclass

# Results depend on them, so they are stated as they are.
TARGET = "actual_eta_minutes"
REQUIRED_COLUMNS = (
    "pickup_location",
    "drop_location",
    "pickup_date",
    "pickup_time",
    "traffic_level",
    TARGET,
)
CATEGORICAL = ("pickup_location", "drop_location", "weekday", "season")
NUMERIC = (
    "pickup_hour",
    "pickup_minute",
    "month",
    "day",
    "day_of_year",
    "trip_distance_km",
    "passenger_count",
    "surge_multiplier",
    "is_weekend",
    "traffic_level",
)
LEFTOVER_COLUMNS = ("pickup_date", "pickup_time", "trip_id", "average_speed", "time_of_day")
TRAFFIC_ORDINAL = {"Low": 0, "Medium": 1, "High": 2}
UNKNOWN_TRAFFIC_ORDINAL = 1
SPEED_KMH = {"Low": 45.0, "Medium": 28.0, "High": 15.0}
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
OTHER = "Other"
EARTH_RADIUS_KM = 6371.0
UNKNOWN_PLACE_KM = 1.0
ETA_BOUNDS = (5.0, 10.0, 15.0, 20.0, 30.0, 45.0, 60.0, 90.0, 120.0)
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class TripRules:
    """Limits used while cleaning and validating trips."""

    target: str = TARGET
    min_minutes: float = 0.5
    max_minutes: float = 200.0
    rare_below: int = 20
    test_share: float = 0.20
    seed: int = 42


@dataclass(frozen=True)
class RequestRules:
    """Limits and defaults of a scoring request."""

    min_passengers: int = 1
    max_passengers: int = 8
    min_surge: float = 1.0
    max_surge: float = 5.0
    default_passengers: int = 1
    default_surge: float = 1.0
    fallback_pickup: str = "Upper West Side"
    fallback_drop: str = "Harlem"
    fallback_date: str = "2026-08-27"
    fallback_time: str = "12:00"


@dataclass(frozen=True)
class Floors:
    """Lowest prediction kept in each setting (training keeps raw predictions)."""

    evaluate: float = 0.0
    serve: float = 0.5


@dataclass(frozen=True)
class DriftRules:
    """Limits of the drift test and of the retraining decision."""

    p_value: float = 0.05
    drift_share: float = 0.30
    rmse_increase: float = 0.15
    min_samples: int = 5


@dataclass(frozen=True)
class KindRules:
    """Which drift test a column takes, and its limit.

    Up to ``small`` reference rows a test's p-value decides, beyond a distance does: with many rows every p-value is low.
    """

    small: int = 1000
    few_values: int = 5
    p_value: float = 0.05
    distance: float = 0.1
    bins: int = 30


@dataclass(frozen=True)
class ModelSettings:
    """Regressor settings."""

    ridge_alpha: float = 1.0
    forest_trees: int = 100
    forest_depth: int = 12
    boost_rounds: int = 120
    boost_rate: float = 0.1
    boost_depth: int = 5
    newton_rounds: int = 20
    newton_rate: float = 0.3
    seed: int = 42
