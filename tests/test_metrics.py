from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymeter.operators import metrics


def frame(spark, actual, predicted):
    rows = [(float(a), float(p)) for a, p in zip(actual, predicted)]
    return spark.createDataFrame(rows, "y double, p double")


def test_regression_metrics(spark):
    r = metrics.regression_metrics(frame(spark, [10, 20, 30, 40], [11, 19, 31, 39]), "y", "p").first()
    assert r["mae"] == 1.0 and r["rmse"] == 1.0 and r["n"] == 4
    assert r["r2"] == pytest.approx(0.992) and r["mape"] == pytest.approx(0.05208333, abs=1e-8)


def test_regression_metrics_of_constant_targets(spark):
    assert metrics.regression_metrics(frame(spark, [3, 3], [3, 3]), "y", "p").first()["r2"] == 1.0
    assert metrics.regression_metrics(frame(spark, [3, 3], [3, 4]), "y", "p").first()["r2"] == 0.0
    # A zero target divides by the smallest divisor rather than by zero.
    assert metrics.regression_metrics(frame(spark, [0, 1], [1, 1]), "y", "p").first()["mape"] > 1e15


def test_evaluation_report_floors_at_zero(spark):
    r = metrics.evaluation_report(frame(spark, [1, 2], [-5, 2]), "y", "p").first()
    assert r["test_mae"] == 0.5 and r["test_mape_percent"] == 50.0 and r["num_test_samples"] == 2


def test_compared_metrics_equal_single_ones(spark):
    df = frame(spark, [10, 20, 30, 40], [11, 19, 31, 39]).withColumn("q", F.col("y") + 2)
    both = {r["model"]: r for r in metrics.compared_metrics(df, "y", {"a": "p", "b": "q"}).collect()}
    assert both["a"]["mae"] == 1.0 and both["b"]["mae"] == 2.0 and both["b"]["ord"] == 1


@pytest.mark.parametrize("bins", [1, 7, 25, 40])
def test_histogram_equals_numpy(spark, bins):
    rng = np.random.default_rng(5)
    for values in (
        rng.normal(size=2000),
        np.round(rng.uniform(0, 3, 2000), 1),
        np.array([0.1 * i for i in range(31)]),
        np.array([4.0, 4.0]),
        np.array([-1.0, 0.0, 1.0]),
    ):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        got = metrics.histogram(df, "v", bins).orderBy("bin").collect()
        counts, edges = np.histogram(values, bins=bins)
        assert [r["n"] for r in got] == counts.tolist()
        np.testing.assert_allclose([r["lower"] for r in got], edges[:-1], atol=1e-12)
        np.testing.assert_allclose([r["upper"] for r in got], edges[1:], atol=1e-12)


def test_bucket_histogram(spark):
    df = spark.createDataFrame([(5.0,), (5.1,), (120.0,), (500.0,), (None,)], "v double")
    rows = {r["le"]: r for r in metrics.bucket_histogram(df, "v").collect()}
    assert [rows[k]["cumulative"] for k in ("5.0", "10.0", "90.0", "120.0", "+Inf")] == [1, 2, 2, 3, 4]
    assert rows["5.0"]["n"] == 4 and rows["5.0"]["total_minutes"] == pytest.approx(630.1)


def test_batch_summary(spark):
    df = spark.createDataFrame([(10.0, 1.0, "High"), (20.0, 2.0, "Low")], "m double, surge_multiplier double, traffic_level string")
    r = metrics.batch_summary(df, "m").first()
    assert (r["rows"], r["mean_minutes"], r["mean_surge"], r["high_traffic_percent"]) == (2, 15.0, 1.5, 50.0)
    assert r["std_minutes"] == pytest.approx(np.std([10, 20], ddof=1))


def test_baseline_minutes(spark):
    df = spark.createDataFrame([(45.0, "Low"), (14.0, "Medium"), (15.0, "High"), (0.01, "Low")], "d double, t string")
    got = [r[0] for r in df.select(metrics.baseline_minutes(F.col("d"), F.col("t"))).collect()]
    assert got == [60.0, 30.0, 60.0, 0.5]


def test_monitored_errors_count_a_retried_request_once(spark):
    at = "2026-08-27 10:{:02d}:00".format
    predictions = spark.createDataFrame(
        [(1, at(0), 10.0), (1, at(1), 99.0), (2, at(0), 5.0), (3, at(0), 7.0)], "event_id long, ts string, predicted double"
    ).withColumn("ts", F.to_timestamp("ts"))
    actuals = spark.createDataFrame(
        [(1, at(30), 12.0), (1, at(30), 12.0), (2, "2026-08-27 14:00:01", 5.0), (9, at(5), 1.0)],
        "event_id long, actual_ts string, actual double",
    ).withColumn("actual_ts", F.to_timestamp("actual_ts"))
    rows = metrics.monitored_errors(predictions, actuals).collect()
    assert [(r["event_id"], r["predicted"], r["actual"]) for r in rows] == [(1, 10.0, 12.0)]


def test_monitored_errors_with_a_hot_key(spark):
    ts = F.to_timestamp(F.lit("2026-08-27 10:00:00"))
    copies = spark.range(5_000).select(F.lit(1).cast("long").alias("event_id"), ts.alias("ts"), F.lit(3.0).alias("predicted"))
    late = copies.select("event_id", F.col("ts").alias("actual_ts"), F.lit(4.0).alias("actual"))
    assert metrics.monitored_errors(copies, late).count() == 1


def test_first_trips(spark):
    df = spark.range(100).select(F.format_string("%03d", F.col("id")).alias("trip_id"))
    assert [r[0] for r in metrics.first_trips(df, 3).collect()] == ["000", "001", "002"]


def plain_rate(samples, low, high):
    """Reset-aware increase of sorted (second, value) samples, carried on to the window's ends."""
    if len(samples) < 2:
        return None
    steps = [(b[1] if b[1] < a[1] else b[1] - a[1]) for a, b in zip(samples, samples[1:], strict=False)]
    (first, v0), (last, _) = samples[0], samples[-1]
    inc, covered = sum(steps), last - first
    mean = covered / len(steps)
    head, tail = (g if g < 1.1 * mean else mean / 2 for g in (first - low, high - last))
    head = min(head, covered * v0 / inc) if inc else head
    return inc * (covered + head + tail) / covered


def test_counter_rates(spark):
    import random

    rng = random.Random(2)
    rows, value = [], {}
    for second in sorted(rng.sample(range(3600), 300)):
        name = rng.choice("aab")
        value[name] = 0 if rng.random() < 0.05 else value.get(name, 0) + rng.randint(0, 4)
        rows.append((name, second, value[name]))
    rows += [("c", 10, 1), ("d", 20, 5), ("d", 50, 5), (None, 5, 1), (None, 9, 3)]
    start = 1_700_000_100  # a multiple of 300
    df = spark.createDataFrame([(n, start + t, v) for n, t, v in rows + rows[:9]], "name string, t long, value long").withColumn("ts", F.timestamp_seconds("t"))
    got = {(r.name, r.w): (r.increase, r.per_second) for r in metrics.counter_rates(df, ["name"]).withColumn("w", F.unix_timestamp("window_start") - start).collect()}
    want = {}
    for name in ("a", "b", "c", "d", None):
        for low in range(0, 3600, 300):
            rate = plain_rate([(t, v) for n, t, v in sorted(rows, key=lambda r: r[1]) if n == name and low <= t < low + 300], low, low + 300)
            if rate is not None:
                want[name, low] = rate
    assert got.keys() == want.keys() and ("c", 0) not in got and want["d", 0] == 0
    for key, rate in want.items():
        assert got[key] == pytest.approx((rate, rate / 300))
