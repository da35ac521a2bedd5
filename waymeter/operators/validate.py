"""Dataset checks and request validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.functions.columns import one_of, strip_blanks
from waymeter.functions.temporal import clock_hour, day_first_date, iso_date
from waymeter.operators.clean import missing_flags
from waymeter.params import REQUIRED_COLUMNS, TRAFFIC_ORDINAL, RequestRules, TripRules
from waymeter.sources.locations import LOCATION_NAMES

ISSUES = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)


class DatasetInvalid(ValueError):
    """Raised by :func:`require_valid`."""


def dataset_issues(
    df: DataFrame,
    rules: TripRules = TripRules(),
    strict_locations: bool = False,
    check_drop: bool = False,
) -> DataFrame:
    """Problems of a trip table as (check, subject, n) rows; no rows means valid.

    Missing columns are read off the schema, and end the check. Missing and out-of-range values are
    counters of one aggregate. Only values outside a vocabulary are grouped, from the few columns that
    have one, with map-side partial counts.
    """
    spark = df.sparkSession
    lost = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if lost:
        return spark.createDataFrame([("missing_column", c, 1) for c in lost], ISSUES)
    if df.isEmpty():
        return spark.createDataFrame([("empty", "*", 0)], ISSUES)

    target = F.col(rules.target)
    counters = [("missing_value", name, flag) for name, flag in zip(df.columns, missing_flags(df))]
    outside = (target < rules.min_minutes) | (target > rules.max_minutes)
    counters.append(("target_out_of_range", rules.target, outside))
    counted = df.agg(*[F.count_if(flag).alias(f"_{k}") for k, (_, _, flag) in enumerate(counters)]).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(check).alias("check"), F.lit(name).alias("subject"), F.col(f"_{k}").alias("n"))
                    for k, (check, name, _) in enumerate(counters)
                ]
            )
        )
    )
    findings = [_outside("unexpected_traffic", "traffic_level", TRAFFIC_ORDINAL)]
    if strict_locations:
        findings.append(_outside("unknown_pickup", "pickup_location", LOCATION_NAMES))
        if check_drop:
            findings.append(_outside("unknown_drop", "drop_location", LOCATION_NAMES))
    unexpected = (
        df.select(F.inline(F.array_compact(F.array(*findings))))
        .groupBy("check", "subject")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.where("n > 0").unionByName(unexpected)


def _finding(check: str, subject: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), subject.alias("subject"))


def _outside(check: str, name: str, known) -> Column:
    c = F.col(name)
    return F.when(~one_of(c, known), _finding(check, F.coalesce(c, F.lit("null"))))


def unknown_values(df: DataFrame, column: str, known: DataFrame, known_column: str = "name") -> DataFrame:
    """Distinct values of a column that a value table does not hold."""
    values = df.select(F.col(column).alias("value")).distinct()
    return values.join(known, F.col("value") == known[known_column], "left_anti")


def issue_messages(issues: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """One message per finding, in words."""
    check, subject, n = F.col("check"), F.col("subject"), F.col("n")
    bounds = f"[{rules.min_minutes}, {rules.max_minutes}]"
    text = (
        F.when(check == "missing_column", F.format_string("Missing required column: '%s'", subject))
        .when(check == "empty", F.lit("Dataset is empty."))
        .when(check == "missing_value", F.format_string("Found %d missing values in column '%s'", n, subject))
        .when(
            check == "target_out_of_range",
            F.format_string(f"Found %d rows with '%s' outside {bounds}", n, subject),
        )
        .when(check == "unexpected_traffic", F.format_string("Found unexpected traffic level: '%s'", subject))
        .otherwise(F.format_string("Found unknown location: '%s'", subject))
    )
    return issues.select("check", "subject", "n", text.alias("message"))


def require_valid(df: DataFrame, rules: TripRules = TripRules(), strict_locations: bool = False) -> None:
    """Raise :class:`DatasetInvalid` with the findings, or return.

    The error text has a line for each check and column. Where a column holds several unexpected
    values, the line gives their number, their rows and the first one; all are in
    :func:`dataset_issues`.
    """
    issues = issue_messages(dataset_issues(df, rules, strict_locations), rules)
    by_value = F.col("check").isin("unexpected_traffic", "unknown_pickup", "unknown_drop")
    rows = (
        issues.groupBy("check", F.when(~by_value, F.col("subject")).alias("column"))
        .agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"), F.min("message").alias("message"))
        .orderBy("check", "column")
        .collect()
    )
    if rows:
        more = " (the first of {values} values in {rows} rows)"
        raise DatasetInvalid("\n".join(r["message"] + (more.format(**r.asDict()) if r["values"] > 1 else "") for r in rows))


def trim_request(df: DataFrame) -> DataFrame:
    text = ("pickup_location", "drop_location", "pickup_date", "pickup_time")
    return df.withColumns({c: strip_blanks(F.col(c)) for c in text})


def request_rules(rules: RequestRules = RequestRules()) -> dict[str, Column]:
    """Field of a trimmed request → whether its value is valid. Never null."""
    passengers, surge = F.col("passenger_count"), F.col("surge_multiplier")
    in_count = passengers.between(rules.min_passengers, rules.max_passengers)
    in_surge = surge.between(rules.min_surge, rules.max_surge)
    return {
        "pickup_location": one_of(F.col("pickup_location"), LOCATION_NAMES),
        "drop_location": one_of(F.col("drop_location"), LOCATION_NAMES),
        "pickup_date": iso_date(F.col("pickup_date")).isNotNull(),
        "pickup_time": clock_hour(F.col("pickup_time")).isNotNull(),
        "passenger_count": F.coalesce(in_count, F.lit(True)),
        "surge_multiplier": F.coalesce(in_surge, F.lit(True)),
    }


def check_requests(df: DataFrame, rules: RequestRules = RequestRules()) -> DataFrame:
    """Trim the text fields and add ``reasons``: the names of the fields that are not valid."""
    broken = [F.when(~ok, F.lit(name)) for name, ok in request_rules(rules).items()]
    return trim_request(df).withColumn("reasons", F.array_compact(F.array(*broken)))


def split_requests(df: DataFrame, rules: RequestRules = RequestRules()) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected). A bad request is set aside; the others of its batch are still served.

    The valid side filters by the rules one after the other and builds no reasons.
    """
    # Cheap rules first: the filter stops at the first one that fails.
    ok = list(reversed(request_rules(rules).values()))
    valid = trim_request(df).where(reduce(lambda a, b: a & b, ok))
    return valid, check_requests(df, rules).where(F.size("reasons") > 0)


def coerce_batch(df: DataFrame, rules: RequestRules = RequestRules()) -> DataFrame:
    """Bring an uploaded batch into request form, with fallbacks instead of rejections.

    Columns the batch does not have get their fallback. A null passenger count or surge also does.
    """

    def column(name: str, fallback: object) -> Column:
        return F.col(name) if name in df.columns else F.lit(fallback)

    def place(name: str, fallback: str) -> Column:
        c = column(name, fallback)
        return F.when(one_of(c, LOCATION_NAMES), c).otherwise(F.lit(fallback))

    day = column("pickup_date", rules.fallback_date)
    day = F.coalesce(F.date_format(day_first_date(day), "yyyy-MM-dd"), day)
    clock = column("pickup_time", rules.fallback_time)
    passengers = column("passenger_count", rules.default_passengers).cast("string")
    surge = column("surge_multiplier", rules.default_surge).cast("string")
    return df.withColumns(
        {
            "pickup_location": place("pickup_location", rules.fallback_pickup),
            "drop_location": place("drop_location", rules.fallback_drop),
            "pickup_date": F.when(F.length(day) == 10, day).otherwise(F.lit(rules.fallback_date)),
            "pickup_time": F.when(F.length(clock) >= 5, F.substring(clock, 1, 5)).otherwise(
                F.lit(rules.fallback_time)
            ),
            "passenger_count": F.coalesce(
                passengers.try_cast("double").try_cast("int"), F.lit(rules.default_passengers)
            ),
            "surge_multiplier": F.coalesce(surge.try_cast("double"), F.lit(rules.default_surge)),
        }
    )


def flag_same_place(df: DataFrame) -> DataFrame:
    """Add ``same_place``: pickup and drop are the same. A warning, not an error."""
    same = F.col("pickup_location") == F.col("drop_location")
    return df.withColumn("same_place", F.coalesce(same, F.lit(False)))
