"""Error metrics, summaries and histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymeter.params import ETA_BOUNDS, SPEED_KMH, Floors
from waymeter.functions.columns import choose

# Smallest divisor of a relative error.
TINY = 2.220446049250313e-16


def baseline_minutes(distance: Column, traffic: Column, floor: float = Floors.serve) -> Column:
    """Duration from distance and the traffic level's speed: a predictor that needs no training."""
    minutes = distance / choose(traffic, SPEED_KMH, SPEED_KMH["Medium"]) * 60.0
    return F.greatest(minutes, F.lit(floor))


def floored(prediction: Column, floor: float) -> Column:
    return F.greatest(prediction, F.lit(floor))


def metric_columns(actual: Column, predicted: Column) -> dict[str, Column]:
    """r2, mae, rmse, mape and n as aggregates over one pass."""
    error = actual - predicted
    mse = F.avg(error * error)
    spread = F.var_pop(actual)
    r2 = F.when(spread > 0, 1.0 - mse / spread).when(mse == 0, F.lit(1.0)).when(mse > 0, F.lit(0.0))
    return {
        "r2": r2,
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(mse),
        "mape": F.avg(F.abs(error) / F.greatest(F.abs(actual), F.lit(TINY))),
        "n": F.count(error),
    }


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row of metrics, or one per group. The shuffle carries one partial row per task and group."""
    columns = metric_columns(F.col(actual), F.col(predicted))
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in columns.items()])


def evaluation_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rounded test metrics of floored predictions, the relative error in percent."""
    scored = df.withColumn("_p", floored(F.col(predicted), Floors.evaluate))
    m = regression_metrics(scored, actual, "_p")
    return m.select(
        F.round("r2", 4).alias("test_r2"),
        F.round("rmse", 4).alias("test_rmse"),
        F.round("mae", 4).alias("test_mae"),
        F.round(F.col("mape") * 100, 2).alias("test_mape_percent"),
        F.col("n").alias("num_test_samples"),
    )


def residuals(df: DataFrame, actual: str, predicted: str, column: str = "residual") -> DataFrame:
    return df.withColumn(column, F.col(actual) - F.col(predicted))


def batch_summary(df: DataFrame, target: str) -> DataFrame:
    """Rows, mean and sample deviation of the target, mean surge, share of high traffic in percent."""
    high = F.when(F.col("traffic_level") == "High", 1.0).otherwise(0.0)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(target).alias("mean_minutes"),
        F.stddev_samp(target).alias("std_minutes"),
        F.avg("surge_multiplier").alias("mean_surge"),
        (F.avg(high) * 100).alias("high_traffic_percent"),
    )


def score_summary(df: DataFrame, predicted: str) -> DataFrame:
    return df.agg(
        F.avg(predicted).alias("mean_predicted"),
        F.min(predicted).alias("min_predicted"),
        F.max(predicted).alias("max_predicted"),
    )


def compared_metrics(
    df: DataFrame, actual: str, predictions: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """(ord, model, metrics) for several prediction columns of one table, all in one pass."""
    aggregates, entries = [], []
    for i, (name, column) in enumerate(predictions.items()):
        parts = metric_columns(F.col(actual), F.col(column))
        aggregates += [c.alias(f"_{i}_{metric}") for metric, c in parts.items()]
        entries.append(
            F.struct(
                F.lit(i).alias("ord"),
                F.lit(name).alias("model"),
                *[F.col(f"_{i}_{metric}").alias(metric) for metric in parts],
            )
        )
    return df.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*entries)))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, lower, upper, n) over equal-width bins from minimum to maximum, empty bins included.

    All bins but the last are half-open; the last holds the maximum. If every value is the same, the
    range is widened by 0.5 on both sides. The bounds are a scalar subquery, so there is no join with
    a one-row table and no driver round trip. ``df`` is read twice: store the column first if computing
    it takes a shuffle.
    """
    value = F.col(column)
    widen = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    lo, hi = F.col("lo"), F.col("hi")
    edges = F.transform(
        F.sequence(F.lit(0), F.lit(bins)),
        lambda i: F.when(i == bins, hi).otherwise(lo + i * ((hi - lo) / bins)),
    )
    bounds = (
        df.where(value.isNotNull())
        .agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
        .select((lo - widen).alias("lo"), (hi + widen).alias("hi"))
        .select(F.struct(lo, hi, edges.alias("edges")))
        .scalar()
    )

    def edge(i: Column) -> Column:
        return F.get(bounds["edges"], i)

    part = (value - bounds["lo"]) / (bounds["hi"] - bounds["lo"])
    rough = F.least(F.floor(part * bins), F.lit(bins - 1)).cast("int")
    # The quotient can land one bin off at an edge; the edges themselves decide.
    exact = (
        F.when(value < edge(F.col("_b")), F.col("_b") - 1)
        .when((F.col("_b") < bins - 1) & (value >= edge(F.col("_b") + 1)), F.col("_b") + 1)
        .otherwise(F.col("_b"))
    )
    counts = (
        df.where(value.isNotNull())
        .select(value, rough.alias("_b"))
        .groupBy(exact.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("lower"),
        edge(F.col("bin") + 1).alias("upper"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def bucket_histogram(
    df: DataFrame, column: str, bounds: Sequence[float] = ETA_BOUNDS, by: Sequence[str | Column] = ()
) -> DataFrame:
    """Cumulative bucket counts (le, count up to and including le) with sum and total per group.

    One aggregation with a counter per bound, unfolded afterwards.
    """
    value = F.col(column)
    wide = df.where(value.isNotNull()).groupBy(*by).agg(
        *[F.count_if(value <= b).alias(f"_le_{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("_n"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("_sum"),
    )
    groups = [c for c in wide.columns if not c.startswith("_")]
    entries = [
        F.struct(F.lit(str(b)).alias("le"), F.col(f"_le_{i}").alias("cumulative"))
        for i, b in enumerate(bounds)
    ]
    entries.append(F.struct(F.lit("+Inf").alias("le"), F.col("_n").alias("cumulative")))
    return wide.select(
        *groups,
        F.inline(F.array(*entries)),
        F.col("_sum").alias("total_minutes"),
        F.col("_n").alias("n"),
    )


def request_counters(log: DataFrame) -> DataFrame:
    return log.groupBy("status", "endpoint").agg(F.count(F.lit(1)).alias("n"))


def requests_per_minute(log: DataFrame) -> DataFrame:
    """Requests per one-minute window, status and endpoint, and their rate per second."""
    counts = log.groupBy(F.window("ts", "1 minute").alias("w"), "status", "endpoint").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.select(
        F.col("w.start").alias("window_start"),
        "status",
        "endpoint",
        "n",
        (F.col("n") / 60.0).alias("per_second"),
    )


def counter_rates(samples: DataFrame, series: Sequence[str], window: str = "5 minutes", value: str = "value", ts: str = "ts") -> DataFrame:
    """(``series``, window_start, increase, per_second) of cumulative counters sampled over time.

    A counter that falls was reset: what it shows then counts from 0. The increase between the first and the last sample
    of a window is carried on to the window's ends, by half a mean interval where a sample is further than a tenth more than
    that from an end, and not below the counter's 0 at the start. Equal times: the higher value counts. A window with fewer
    than two samples has no rate.
    """
    seconds = F.col("_t")
    at = samples.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).groupBy(*series, ts).agg(F.max(value).cast("double").alias("_v"))
    at = at.select(*series, F.window(ts, window).alias("_w"), F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"), "_v").withColumn("_t", F.col("_us") / 1e6)
    order = Window.partitionBy(*series, "_w").orderBy("_us")
    before = F.lag("_v").over(order)
    step = F.when(before.isNull(), 0.0).when(F.col("_v") < before, F.col("_v")).otherwise(F.col("_v") - before)
    steps = at.withColumn("_step", step)
    found = steps.groupBy(*series, "_w").agg(
        F.sum("_step").alias("_inc"), F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.min_by("_v", seconds).alias("_v0")
    ).where("_n > 1")
    start, stop = (F.unix_micros(F.col(f"_w.{side}").cast("timestamp")) / 1e6 for side in ("start", "end"))
    covered = F.col("_last") - F.col("_first")
    mean = covered / (F.col("_n") - 1)
    to_end = lambda gap: F.when(gap < 1.1 * mean, gap).otherwise(mean / 2)
    from_zero = F.when(F.col("_inc") > 0, covered * F.col("_v0") / F.col("_inc")).otherwise(F.lit(float("inf")))
    head = F.least(to_end(F.col("_first") - start), from_zero)
    increase = F.col("_inc") * (covered + head + to_end(stop - F.col("_last"))) / covered
    return found.select(*series, F.col("_w.start").alias("window_start"), increase.alias("increase"), (increase / (stop - start)).alias("per_second"))


def sliding_histogram(log: DataFrame, column: str = "predicted_eta_minutes",
                      width: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Bucket histogram per sliding window.

    Rows are first counted per slide step, so the fan-out into overlapping windows works on one
    pre-aggregated row per step and not on every event.
    """
    wide = _bucket_counts(log, column, F.window("ts", slide).alias("w"))
    steps = wide.withColumn("_at", F.col("w.start")).drop("w")
    sums = [F.sum(c).alias(c) for c in steps.columns if c != "_at"]
    merged = steps.groupBy(F.window("_at", width, slide).alias("w")).agg(*sums)
    return _unfold_buckets(merged)


def _bucket_counts(df: DataFrame, column: str, window: Column) -> DataFrame:
    value = F.col(column)
    return df.where(value.isNotNull()).groupBy(window).agg(
        *[F.count_if(value <= b).alias(f"_le_{i}") for i, b in enumerate(ETA_BOUNDS)],
        F.count(value).alias("_n"),
    )


def streamed_sliding_histogram(log: DataFrame, column: str = "predicted_eta_minutes",
                               width: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """The same table with a single aggregation, for a stream."""
    return _unfold_buckets(_bucket_counts(log, column, F.window("ts", width, slide).alias("w")))


def _unfold_buckets(wide: DataFrame) -> DataFrame:
    entries = [
        F.struct(F.lit(str(b)).alias("le"), F.col(f"_le_{i}").alias("cumulative"))
        for i, b in enumerate(ETA_BOUNDS)
    ]
    entries.append(F.struct(F.lit("+Inf").alias("le"), F.col("_n").alias("cumulative")))
    return wide.select(F.col("w.start").alias("window_start"), F.inline(F.array(*entries)))


def first_per_key(df: DataFrame, key: str, time: str) -> DataFrame:
    """The earliest row of each key. Copies collapse map-side, so a hot key costs one row per task."""
    rest = [c for c in df.columns if c not in (key, time)]
    earliest = F.min(F.struct(time, *rest)).alias("_row")
    return df.groupBy(key).agg(earliest).select(key, "_row.*")


def monitored_errors(predictions: DataFrame, actuals: DataFrame, key: str = "event_id", unmatched: bool = False) -> DataFrame:
    """Predictions with the actual duration that arrived within four hours, each trip once.

    A retried request is logged more than once; only its first answer counts. That also makes the join
    one-to-one, and the join finds both sides partitioned by its key already.
    """
    return match_actuals(
        first_per_key(predictions, key, "ts"), first_per_key(actuals, key, "actual_ts"), key, unmatched=unmatched
    )


def match_actuals(predictions: DataFrame, actuals: DataFrame, key: str = "event_id",
                  within: str = "INTERVAL 4 HOURS", unmatched: bool = False) -> DataFrame:
    """Equi-join on the trip key with an event-time bound, for batch and stream alike.

    Both sides grow, so neither is broadcast by hint. With ``unmatched`` a prediction without an actual duration
    stays; a stream hands it on once its watermark has passed the bound.
    """
    right = actuals.withColumnRenamed(key, "_key")
    lag = F.col("actual_ts").between(F.col("ts"), F.col("ts") + F.expr(within))
    return predictions.join(right, (F.col(key) == F.col("_key")) & lag, "left" if unmatched else "inner").drop("_key")


def coverage(matched: DataFrame, width: str = "1 hour") -> DataFrame:
    """(window_start, predictions, matched, coverage, rmse) per window of the predictions' time, unmatched ones included."""
    error = F.col("actual_eta_minutes") - F.col("predicted_eta_minutes")
    window = F.window(F.col("ts").cast("timestamp"), width)["start"].alias("window_start")
    counts = matched.groupBy(window).agg(
        F.count(F.lit(1)).alias("predictions"), F.count("actual_eta_minutes").alias("matched"), F.sqrt(F.avg(error * error)).alias("rmse")
    )
    return counts.select("window_start", "predictions", "matched", (F.col("matched") / F.col("predictions")).alias("coverage"), "rmse")


def windowed_errors(matched: DataFrame, width: str = "1 hour") -> DataFrame:
    """Error metrics of matched predictions per window of their time."""
    windowed = matched.withColumn("window_start", F.window(F.col("ts").cast("timestamp"), width)["start"])
    return regression_metrics(windowed, "actual_eta_minutes", "predicted_eta_minutes", by=["window_start"])


def first_trips(df: DataFrame, n: int = 50, order: Sequence[str] = ("trip_id",)) -> DataFrame:
    """The first ``n`` rows in a stated order: a top-k, not a global sort."""
    return df.orderBy(*order).limit(n)
