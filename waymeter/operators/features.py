"""Feature derivation and the fitted feature model."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.functions import temporal
from waymeter.functions.columns import choose, quoted, strip_blanks, with_default
from waymeter.functions.geo import haversine_km
from waymeter.functions.hashing import BUCKETS, content_hash, hash_bucket
from waymeter.params import (
    CATEGORICAL,
    NUMERIC,
    OTHER,
    TRAFFIC_ORDINAL,
    UNKNOWN_PLACE_KM,
    UNKNOWN_TRAFFIC_ORDINAL,
    RequestRules,
    TripRules,
)
from waymeter.session import materialize
from waymeter.sources.locations import location_dimension

PLACES = ("pickup_location", "drop_location")
# Columns of the dense view, which has one for each category. A larger vocabulary takes the sparse encoder, which has no such bound.
DENSE_COLUMNS = 5_000


# --- calendar and distance -------------------------------------------------------------------


def add_temporal(df: DataFrame, blank_rule: str = "dataset") -> DataFrame:
    """Add month, day, day_of_year, weekday, is_weekend, season, pickup_hour and pickup_minute.

    Month, day, day of year, hour and minute are always derived. Weekday, weekend flag and season
    are derived only where the table lacks them. What "lacks" means is ``blank_rule``:

    * ``"dataset"``: the column is absent, or present without a single value. The second case costs
      a look at the data, which stops at the first value found.
    * ``"present"``: the column is absent. No job; the same answer for a table without nulls, such
      as a cleaned one.
    * ``"row"``: absent, or null in that row.
    """
    derived: dict[str, Column] = {}
    if "pickup_date" in df.columns:
        df = df.withColumn("_date", temporal.trip_date(F.col("pickup_date")))
        date = F.col("_date")
        derived["month"] = F.month(date)
        derived["day"] = F.dayofmonth(date)
        derived["day_of_year"] = F.dayofyear(date)
        optional = {
            "weekday": temporal.weekday_name(date),
            "is_weekend": temporal.weekend_flag(date),
            "season": temporal.season_of(F.month(date)),
        }
        for name, value in optional.items():
            if name not in df.columns:
                derived[name] = value
            elif blank_rule == "row":
                derived[name] = F.coalesce(F.col(name), value)
            elif blank_rule == "dataset" and df.where(F.col(name).isNotNull()).isEmpty():
                derived[name] = value
    if "pickup_time" in df.columns:
        clock = F.trim(F.col("pickup_time").cast("string"))
        derived["pickup_hour"] = temporal.clock_hour(clock)
        derived["pickup_minute"] = temporal.clock_minute(clock)
    return (df.withColumns(derived) if derived else df).drop("_date")


def add_distance(df: DataFrame, column: str = "trip_distance_km", locations: DataFrame | None = None) -> DataFrame:
    """Great-circle distance between pickup and drop, 1.0 km if either place is unknown.

    For the 25 places of the dimension the distances of all pairs are computed once and looked up, so no trip pays for
    the trigonometry. Places given by the caller, of any number, are looked up one by one, and the distance is the trip's own work.
    """
    if locations is None:
        pairs = F.broadcast(_pair_distances(df.sparkSession))
        known = (F.col("pickup_location") == F.col("_p_name")) & (F.col("drop_location") == F.col("_d_name"))
        df = df.join(pairs, known, "left").withColumn(column, F.coalesce("_km", F.lit(UNKNOWN_PLACE_KM)))
        return df.drop("_p_name", "_d_name", "_km")
    for side, name in (("_p", "pickup_location"), ("_d", "drop_location")):
        df = df.join(_side(locations, side), F.col(name) == F.col(f"{side}_name"), "left")
    df = df.withColumn(column, F.coalesce(_km(), F.lit(UNKNOWN_PLACE_KM)))
    return df.drop("_p_name", "_p_lat", "_p_lon", "_d_name", "_d_lat", "_d_lon")


def _side(places: DataFrame, side: str) -> DataFrame:
    return places.select(F.col("name").alias(f"{side}_name"), F.col("lat_rad").alias(f"{side}_lat"), F.col("lon_rad").alias(f"{side}_lon"))


def _km() -> Column:
    return F.round(haversine_km(F.col("_p_lat"), F.col("_p_lon"), F.col("_d_lat"), F.col("_d_lon")), 3)


def _pair_distances(spark: SparkSession) -> DataFrame:
    """(_p_name, _d_name, _km) of every two places of the dimension."""
    places = location_dimension(spark)
    # 25 rows each, so the product has 625.
    return _side(places, "_p").crossJoin(F.broadcast(_side(places, "_d"))).select("_p_name", "_d_name", _km().alias("_km"))


def ensure_distance(df: DataFrame) -> DataFrame:
    """Compute the distance only if the table has none."""
    return df if "trip_distance_km" in df.columns else add_distance(df)


def ensure_defaults(df: DataFrame, rules: RequestRules = RequestRules()) -> DataFrame:
    """Add passenger count and surge with their defaults if the columns are absent."""
    for name, value in (
        ("passenger_count", rules.default_passengers),
        ("surge_multiplier", rules.default_surge),
    ):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


def fill_request_defaults(df: DataFrame, rules: RequestRules = RequestRules()) -> DataFrame:
    """Null or zero passenger count and surge → default, as the scoring path does."""
    df = ensure_defaults(df, rules)
    return df.withColumns(
        {
            "passenger_count": with_default(F.col("passenger_count"), rules.default_passengers).cast("int"),
            "surge_multiplier": with_default(F.col("surge_multiplier"), rules.default_surge),
        }
    )


def traffic_ordinal(c: Column) -> Column:
    return choose(c, TRAFFIC_ORDINAL, UNKNOWN_TRAFFIC_ORDINAL)


# --- rare places -----------------------------------------------------------------------------


def value_frequency(df: DataFrame, columns: Sequence[str] = PLACES) -> DataFrame:
    """(column, value, n) over the non-null values of each column on its own.

    One pass and one shuffle for all columns; a hot value is counted map-side.
    """
    return (
        df.select(_pairs(columns))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _pairs(columns: Sequence[str]) -> Column:
    return F.inline(
        F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).alias("value")) for c in columns])
    )


def rare_values(df: DataFrame, columns: Sequence[str] = PLACES, below: int = TripRules.rare_below) -> DataFrame:
    """(column, value, n) of the values seen fewer than ``below`` times in their column."""
    return value_frequency(df, columns).where(F.col("n") < below)


def group_rare(df: DataFrame, rare: DataFrame, columns: Sequence[str] = PLACES) -> DataFrame:
    """Replace the values that ``rare`` lists for a column by "Other".

    The list grows with the data. It is written first, so the planner knows its size and picks the
    join; hot keys of a shuffle join are split by AQE.
    """
    rare = materialize(rare.select("column", "value"), "rare")
    for c in columns:
        names = rare.where(F.col("column") == c).select(F.col("value").alias("_rare"))
        joined = df.join(names, F.col(c) == F.col("_rare"), "left")
        value = F.when(F.col("_rare").isNotNull(), F.lit(OTHER)).otherwise(F.col(c))
        df = joined.withColumn(c, value).drop("_rare")
    return df


# --- train/test split ------------------------------------------------------------------------


def split_flag(df: DataFrame, key: Sequence[str] | None = None, test_share: float = TripRules.test_share,
               column: str = "is_test") -> DataFrame:
    """Mark the test rows by a hash of the row's content.

    The same row lands on the same side whatever the partitioning, row order or retries. The share
    is met in expectation; :func:`exact_split` meets it to the row.
    """
    digest = content_hash(key or df.columns)
    return df.withColumn(column, hash_bucket(digest) < round(test_share * BUCKETS))


def exact_split(df: DataFrame, key: Sequence[str] | None = None, test_share: float = TripRules.test_share,
                column: str = "is_test") -> DataFrame:
    """Mark exactly ``ceil(test_share * n)`` rows as test rows: those with the smallest hashes.

    No global sort: the cut is found by counting rows per four-digit hash prefix (at most 65,536
    counts), then within the one prefix that the cut falls into, and so on until it is separated.
    Only the hashes below that first prefix, a 65,536th of the rows, are written for the next steps.
    Rows that are equal in every key column have one hash and stay on one side.
    """
    keyed = df.withColumn("_digest", content_hash(key or df.columns))
    target = None
    prefix = ""
    digest = F.col("_digest")
    inside = keyed
    while len(prefix) < 32:
        width = len(prefix) + 4
        if len(prefix) == 4:
            inside = materialize(keyed.select("_digest").where(digest.startswith(prefix)), "split-cut")
        elif prefix:
            inside = inside.where(digest.startswith(prefix))
        counts = (
            inside.groupBy(F.substring(digest, 1, width).alias("p"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy("p")
            .collect()
        )
        if target is None:
            # Rounded first: 0.2 * 5 must not become 2 through the last binary digit.
            target = math.ceil(round(test_share * sum(r["n"] for r in counts), 9))
        taken = 0
        hit = None
        for r in counts:
            if taken + r["n"] > target:
                hit = r
                break
            taken += r["n"]
        if hit is None:
            is_test = F.lit(True) if not prefix else F.substring(digest, 1, len(prefix)) <= prefix
            break
        target -= taken
        prefix = hit["p"]
        if target == 0:
            is_test = F.substring(digest, 1, len(prefix)) < prefix
            break
        if width == 32:
            is_test = F.substring(digest, 1, len(prefix)) <= prefix
            break
    return keyed.withColumn(column, is_test).drop("_digest")


# --- the fitted model ------------------------------------------------------------------------


def category_counts(df: DataFrame, is_train: Column) -> DataFrame:
    """(column, value, n_all, n_train) of the non-null values of the categorical columns, in one aggregation."""
    return (
        df.select(is_train.cast("long").alias("_train"), _pairs(CATEGORICAL))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n_all"), F.sum("_train").alias("n_train"))
    )


def numeric_feature(df: DataFrame, name: str) -> Column:
    """A numeric feature as a double: 0 if the table lacks it, traffic as its ordinal."""
    if name not in df.columns:
        return F.lit(0.0).alias(name)
    c = F.col(name)
    if name == "traffic_level" and dict(df.dtypes)[name] == "string":
        c = traffic_ordinal(c)
    return c.cast("double").alias(name)


@dataclass
class FeatureModel:
    """What feature engineering learned from the training trips.

    ``kept`` holds the frequent places per location column; every other place seen while fitting was
    rare. ``categories`` holds the sorted training categories per categorical column; the first of
    each is the baseline and has no column.
    """

    kept: dict[str, list[str]]
    categories: dict[str, list[str]]
    numeric: tuple[str, ...] = NUMERIC
    rare: dict[str, int] = field(default_factory=dict)

    @property
    def one_hot_columns(self) -> list[str]:
        return [f"{c}_{v}" for c, values in self.categories.items() for v in values[1:]]

    @property
    def columns(self) -> list[str]:
        """The ordered feature list."""
        return [*self.numeric, *self.one_hot_columns]

    @staticmethod
    def fit(
        df: DataFrame,
        is_train: Column,
        rules: TripRules = TripRules(),
        fit_on: str = "all",
    ) -> FeatureModel:
        """Learn frequent places and categories in one pass over trips with temporal features.

        Places are counted over all rows before the split (``fit_on="all"``), or over the training
        rows only (``"train"``); categories always come from the training rows. All categorical
        columns are counted in one aggregation. Only frequent places and other categories reach the
        driver, and their number is checked; the rare ones stay a count. A vocabulary of any size is
        the sparse encoder's.
        """
        counts = materialize(category_counts(df, is_train), "categories")
        n = F.col("n_train") if fit_on == "train" else F.col("n_all")
        is_place = F.col("column").isin(*PLACES)
        is_rare = is_place & (n < rules.rare_below)
        frequent = counts.where(~is_rare)
        if frequent.limit(DENSE_COLUMNS + 1).count() > DENSE_COLUMNS:
            raise ValueError(f"more than {DENSE_COLUMNS} categories: too many for one column each, use encoding.SparseEncoder")
        rows = frequent.collect()
        rare = {
            r["column"]: r
            for r in counts.where(is_rare)
            .groupBy("column")
            .agg(F.count(F.lit(1)).alias("values"), F.sum("n_train").alias("n_train"))
            .collect()
        }
        kept = {c: sorted(r["value"] for r in rows if r["column"] == c) for c in PLACES}
        categories = {}
        for c in CATEGORICAL:
            seen = {r["value"] for r in rows if r["column"] == c and r["n_train"] > 0}
            if c in rare and rare[c]["n_train"] > 0:
                seen.add(OTHER)
            categories[c] = sorted(seen)
        return FeatureModel(kept, categories, rare={c: r["values"] for c, r in rare.items()})

    @staticmethod
    def of_index(index: DataFrame, numeric: tuple[str, ...] = NUMERIC) -> FeatureModel:
        """The dense view of a table (column, value, place) of categories."""
        if index.limit(DENSE_COLUMNS + 1).count() > DENSE_COLUMNS:
            raise ValueError(f"more than {DENSE_COLUMNS} categories: too many for one column each")
        rows = index.collect()
        kept = {c: sorted(r["value"] for r in rows if r["column"] == c and r["value"] != OTHER) for c in PLACES}
        categories = {}
        for c in CATEGORICAL:
            placed = sorted((r["place"], r["value"]) for r in rows if r["column"] == c and r["place"] is not None)
            # The baseline stands before the first place; frequent places without training rows have neither.
            base = [r["value"] for r in rows if r["column"] == c and r["place"] is None and r["baseline"]]
            categories[c] = [*base, *[v for _, v in placed]]
        return FeatureModel(kept, categories, numeric)

    def group_places(self, df: DataFrame) -> DataFrame:
        """Places that were rare while fitting → "Other".

        A fitted table holds frequent and rare places only, so "not frequent" decides, and the list
        of rare places, which grows with the data, is not needed.
        """
        grouped = {}
        for c, names in self.kept.items():
            value = F.col(c)
            grouped[c] = F.when(value.isin(*names) | value.isNull(), value).otherwise(F.lit(OTHER))
        return df.withColumns(grouped)

    def transform(self, df: DataFrame, keep: Sequence[str] = (), group_rare: bool = True) -> DataFrame:
        """``keep`` columns, then the features in order, all from one projection.

        ``df`` holds trips with temporal features and a text traffic level. ``group_rare=False`` is
        the scoring path: a place that was rare or unknown while fitting gets all-zero dummies. A
        numeric feature the table lacks is 0; other columns are dropped.
        """
        if group_rare:
            df = self.group_places(df)
        return df.select(
            *[quoted(c) for c in keep],
            *[numeric_feature(df, c) for c in self.numeric],
            *self._dummies(),
        )

    def _dummies(self) -> list[Column]:
        return [
            F.when(F.col(c) == F.lit(v), 1.0).otherwise(0.0).alias(f"{c}_{v}")
            for c, values in self.categories.items()
            for v in values[1:]
        ]

    def assemble(self, features: DataFrame, column: str = "features") -> DataFrame:
        """Add the feature vector in the fitted order."""
        return assemble(features, self.columns, column)

    def save(self, spark: SparkSession, path: str) -> None:
        document = json.dumps(
            {
                "kept": self.kept,
                "categories": self.categories,
                "numeric": list(self.numeric),
                "rare": self.rare,
            }
        )
        spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureModel:
        d = json.loads(spark.read.text(path).first()["value"])
        return FeatureModel(d["kept"], d["categories"], tuple(d["numeric"]), d["rare"])


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)


def trip_features(df: DataFrame) -> DataFrame:
    """Cleaned trips → trips with calendar features, distance and defaults, text columns kept."""
    df = add_temporal(df, blank_rule="present")
    return ensure_defaults(ensure_distance(df))


def request_features(df: DataFrame, rules: RequestRules = RequestRules()) -> DataFrame:
    """Valid requests → the same columns. Distance and traffic come from the map and the clock."""
    dated = df.withColumn("_date", temporal.iso_date(strip_blanks(F.col("pickup_date"))))
    date = F.col("_date")
    clock = strip_blanks(F.col("pickup_time"))
    out = dated.withColumns(
        {
            "pickup_hour": temporal.clock_hour(clock),
            "pickup_minute": temporal.clock_minute(clock),
            "month": F.month(date),
            "day": F.dayofmonth(date),
            "day_of_year": F.dayofyear(date),
            "weekday": temporal.weekday_name(date),
            "is_weekend": temporal.weekend_flag(date),
            "season": temporal.season_of(F.month(date)),
        }
    ).drop("_date")
    out = out.withColumn(
        "traffic_level", temporal.traffic_by_clock(F.col("pickup_hour"), F.col("is_weekend"))
    )
    return fill_request_defaults(add_distance(out), rules)
