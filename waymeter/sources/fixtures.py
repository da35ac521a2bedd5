"""Trip-shaped views of the given tables (``lineitem``, ``events``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeter.sources.readers import spread_small
from waymeter.sources.locations import LOCATION_NAMES


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread_small(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from(given(spark, sf_dir, "lineitem"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from(given(spark, sf_dir, "lineitem"))


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_log_from(given(spark, sf_dir, "events"))


def trips_from(lineitem: DataFrame, duplicates: bool = True) -> DataFrame:
    """Raw trips. Every fiftieth order appears twice under another trip id.

    The copies come from one ``explode`` and not from a second scan of the table.
    """
    pickup = F.when(F.col("l_orderkey") < 3, 22 + F.col("l_orderkey")).otherwise(
        F.col("l_suppkey") % 22
    )
    drop = F.when(F.col("l_orderkey").between(3, 5), 19 + F.col("l_orderkey")).otherwise(
        F.col("l_partkey") % 22
    )
    hour = _hour()
    month = F.month("l_shipdate")
    minutes = (F.floor(F.col("l_extendedprice") / 5) - 150) / F.lit(100).cast("double")
    copies = F.explode(
        F.when(F.col("l_orderkey") % 50 == 0, F.array(F.lit(""), F.lit("dup-"))).otherwise(
            F.array(F.lit(""))
        )
    )
    df = lineitem.withColumn("_copy", copies if duplicates else F.lit(""))
    return df.select(
        F.concat(F.col("_copy"), _trip_key()).alias("trip_id"),
        _name_at(pickup).alias("pickup_location"),
        _name_at(drop).alias("drop_location"),
        F.when(F.col("l_linenumber") == 7, F.col("l_shipdate").cast("date").cast("string"))
        .otherwise(F.date_format("l_shipdate", "dd-MM-yyyy"))
        .alias("pickup_date"),
        _clock_text().alias("pickup_time"),
        F.when(hour < 6, "4. Night")
        .when(hour < 12, "1. Morning")
        .when(hour < 18, "2. Afternoon")
        .otherwise("3. Evening")
        .alias("time_of_day"),
        F.when(month.isin(12, 1, 2), "1. Winter")
        .when(month <= 5, "2. Spring")
        .when(month <= 8, "3. Summer")
        .otherwise("4. Fall")
        .alias("season"),
        (F.col("l_linenumber") - 1).cast("int").alias("passenger_count"),
        F.round(1.0 + F.col("l_discount") * 10, 2).alias("surge_multiplier"),
        (F.col("l_quantity") / 2).alias("trip_distance_km"),
        F.when(F.col("l_returnflag") == "A", "Low")
        .when(F.col("l_returnflag") == "N", "Medium")
        .otherwise("High")
        .alias("traffic_level"),
        F.when(F.col("l_quantity") != 50, minutes).alias("actual_eta_minutes"),
    )


def requests_from(lineitem: DataFrame) -> DataFrame:
    """Scoring requests, some of them invalid in each way the validator knows."""
    supplier = F.col("l_suppkey") % 50
    part = F.col("l_partkey") % 100
    pickup = _name_at(F.col("l_suppkey") % 22)
    return lineitem.select(
        _trip_key().alias("request_id"),
        F.when(supplier == 7, "NonExistentCity")
        .when(supplier == 8, F.concat(F.lit("  "), pickup, F.lit(" ")))
        .otherwise(pickup)
        .alias("pickup_location"),
        _name_at(F.col("l_partkey") % 22).alias("drop_location"),
        F.when(F.col("l_linenumber") == 6, F.date_format("l_shipdate", "dd-MM-yyyy"))
        .otherwise(F.col("l_shipdate").cast("date").cast("string"))
        .alias("pickup_date"),
        F.when(part == 3, "25:61").when(part == 4, "8:15").otherwise(_clock_text()).alias("pickup_time"),
        F.when(F.col("l_linenumber") == 5, None)
        .when((F.col("l_linenumber") == 4) & (F.col("l_partkey") % 10 == 0), 9)
        .otherwise(F.col("l_linenumber"))
        .cast("int")
        .alias("passenger_count"),
        F.round(1.0 + F.col("l_discount") * 50, 1).alias("surge_multiplier"),
    )


def prediction_log_from(events: DataFrame) -> DataFrame:
    """Logged predictions with the actual duration where one arrived."""
    ok = F.col("event_type") != "error"
    known = ok & (F.col("event_id") % 10 != 0)
    ts = F.col("ts").cast("timestamp")
    predicted = F.greatest(F.col("value"), F.lit(0.5))
    delay = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("event_id") % 180).cast("int"), F.lit(0))
    return events.select(
        "event_id",
        ts.alias("ts"),
        F.when(F.col("user_id") % 2 == 0, "/predict").otherwise("/predict/batch").alias("endpoint"),
        F.when(ok, "success").otherwise("error").alias("status"),
        F.when(ok, predicted).alias("predicted_eta_minutes"),
        F.when(known, predicted * (90 + F.col("event_id") % 21) / F.lit(100).cast("double")).alias(
            "actual_eta_minutes"
        ),
        F.when(known, ts + delay).alias("actual_ts"),
    )


def _trip_key() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _name_at(index: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in LOCATION_NAMES]), index.cast("int"))


def _hour() -> Column:
    return (F.col("l_orderkey") + F.col("l_partkey")) % 24


def _clock_text() -> Column:
    minute = (F.col("l_partkey") + F.col("l_linenumber")) % 60
    return F.concat(_two_digits(_hour(), 24), F.lit(":"), _two_digits(minute, 60))


def _two_digits(n: Column, limit: int) -> Column:
    return F.get(F.array(*[F.lit(f"{i:02d}") for i in range(limit)]), n.cast("int"))
