"""Readers: trip tables, reports and the prediction log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.functions.columns import quoted
from waymeter.params import NULL_TOKENS
from waymeter.schemas import PREDICTION_LOG, RAW_TRIP


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """A trip CSV with a header line.

    Columns are found by name, so any subset in any order is accepted; files of one folder whose
    headers differ are an error. Types come from the fixed trip schema rather than from a second pass
    over the file; the usual not-available tokens become null, and so does text that is no number in
    a numeric column, or no whole number in a column of whole numbers. Columns outside the trip
    schema stay strings.
    """
    names = spark.read.option("header", True).csv(path).columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    types = {f.name: f.dataType for f in RAW_TRIP}
    return raw.select([_typed(name, types.get(name, T.StringType())) for name in names])


def _typed(name: str, kind: T.DataType) -> Column:
    c = quoted(name)
    c = F.when(~F.trim(c).isin(*NULL_TOKENS), c)
    if isinstance(kind, T.IntegerType):
        number = F.trim(c).try_cast("double")
        c = F.when(number == F.floor(number), number.try_cast("int"))
    elif isinstance(kind, T.DoubleType):
        c = F.trim(c).try_cast("double")
    return c.alias(name)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A columnar trip, feature or prediction table."""
    return spark.read.format(fmt).load(path)


def spread_small(df: DataFrame) -> DataFrame:
    """Spread a table over all cores if its scan has fewer splits than there are cores.

    Splits are cut by size, down to a few megabytes, so only a table of a few megabytes per core is
    redistributed. Such a file often holds a single row group and would keep one core busy. Larger
    tables are read as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_report(
    spark: SparkSession, path: str, schema: T.StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """A JSON report; top-level keys that are missing get their default."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    for name, value in (defaults or {}).items():
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return df


def read_log_text(spark: SparkSession, path: str) -> DataFrame:
    """The comma-separated prediction log, rows of the older layout and header lines flagged.

    ``is_legacy`` marks lines that do not have the nine current fields; ``raw_line`` keeps their
    text. ``ts`` reads naive and offset timestamps alike (naive ones are UTC).
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PREDICTION_LOG)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = F.from_csv("value", f"{fields}, _bad string", options)
    return spark.read.text(path).select(parsed.alias("p"), F.col("value").alias("raw_line")).select(
        *[F.col(f"p.{f.name}") for f in PREDICTION_LOG],
        F.col("p._bad").isNotNull().alias("is_legacy"),
        "raw_line",
        F.col("p.timestamp").try_cast("timestamp").alias("ts"),
    )


def read_log_days(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """The stored prediction log from the first to the last day; other days' files are not opened."""
    day = F.col("log_date")
    return spark.read.parquet(path).where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def current_log(log: DataFrame) -> DataFrame:
    """Rows of the current layout only."""
    return log.where(~F.col("is_legacy")).drop("raw_line", "is_legacy")
