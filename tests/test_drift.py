from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from waymeter.operators import drift, policy
from waymeter.schemas import DRIFT_REPORT, MODEL_METADATA
from waymeter.sources import readers, writers


def table(spark, **columns):
    names = list(columns)
    rows = [tuple(None if v is None else float(v) for v in r) for r in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


def report(ref, cur, **kw):
    return {r["feature"]: r for r in drift.feature_drift(drift.tag_sides(ref, cur), **kw).collect()}


def ks_by_hand(a, b):
    points = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return float(np.max(np.abs(fa - fb))), float(np.sum(np.abs(fa - fb)[:-1] * np.diff(points)))


def test_identical_tables_do_not_drift(spark):
    df = table(spark, pickup_hour=range(10), trip_distance_km=range(10))
    features = drift.feature_drift(drift.tag_sides(df, df))
    r = drift.drift_summary(features).first()
    assert not r["dataset_drift_detected"] and r["drift_share"] == 0.0 and r["total_features_tested"] == 2
    assert {x["p_value"] for x in features.collect()} == {1.0}


def test_shifted_tables_drift(spark):
    rng = np.random.default_rng(1)
    ref, cur = table(spark, km=rng.normal(2, 0.5, 100)), table(spark, km=rng.normal(15, 2, 100))
    r = report(ref, cur)["km"]
    assert r["drift_detected"] and r["ks_statistic"] == 1.0 and r["p_value"] == 0.0


@pytest.mark.parametrize("values_per_task", [4_000_000, 50, 1])
def test_distances_against_numpy(spark, values_per_task):
    rng = np.random.default_rng(2)
    a = {"x": rng.normal(size=300), "coarse": rng.integers(0, 5, 300), "flag": rng.integers(0, 2, 300)}
    b = {"x": rng.normal(0.3, 1.2, 200), "coarse": rng.integers(1, 6, 200), "flag": rng.integers(0, 2, 200)}
    tagged = drift.tag_sides(table(spark, **a), table(spark, **b))
    rows = drift.ks_table(tagged, list(a), values_per_task).collect()
    assert [r["feature"] for r in sorted(rows, key=lambda r: r["position"])] == list(a)
    for r in rows:
        ks, wd = ks_by_hand(a[r["feature"]], b[r["feature"]])
        assert r["ks"] == pytest.approx(ks, abs=1e-12) and r["wasserstein"] == pytest.approx(wd, abs=1e-9)
        assert r["ref_avg"] == pytest.approx(np.mean(a[r["feature"]])) and r["ref_n"] == 300


def test_a_value_that_most_rows_share(spark):
    ref = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") * 1.0).alias("v"))
    cur = ref.withColumn("v", F.col("v") + 0.5)
    whole = drift.ks_table(drift.tag_sides(ref, cur), ["v"]).first()
    sliced = drift.ks_table(drift.tag_sides(ref, cur), ["v"], 1_000).first()
    assert whole["ks"] == sliced["ks"] == pytest.approx(1 / 3, abs=1e-3)
    assert whole["wasserstein"] == pytest.approx(0.5, abs=1e-6) and sliced["wasserstein"] == pytest.approx(0.5, abs=1e-6)


def test_distances_do_not_depend_on_partitions(spark, partitions):
    rng = np.random.default_rng(7)
    ref, cur = table(spark, x=rng.normal(size=500)), table(spark, x=rng.normal(0.1, 1, 400))
    found = set()
    for n in (1, 4, 17):
        partitions(n)
        for values_per_task in (4_000_000, 37):
            r = drift.ks_table(drift.tag_sides(ref, cur), ["x"], values_per_task).first()
            found.add((r["ks"], round(r["wasserstein"], 12), round(r["ref_avg"], 12)))
    assert len(found) == 1


def test_missing_values_and_small_samples(spark):
    ref = table(spark, a=[1, 2, 3, 4, None, float("nan")], b=[1, 2, 3, 4, 5, None])
    cur = table(spark, a=range(10), b=range(10))
    found = report(ref, cur)
    assert set(found) == {"b"} and found["b"]["ref_rows"] == 5


def test_nothing_tested(spark):
    df = table(spark, a=[1, 2])
    r = drift.drift_summary(drift.feature_drift(drift.tag_sides(df, df))).first()
    assert (r["drift_share"], r["dataset_drift_detected"], r["total_features_tested"]) == (0.0, False, 0)
    assert r["drifted_features"] == []


def test_shared_columns_keep_the_reference_order(spark):
    ref = spark.createDataFrame([(1, "x", 2.0, 3)], "b int, s string, a double, only int")
    cur = spark.createDataFrame([(1.0, 2, "y")], "a double, b long, only string")
    assert drift.shared_numeric(ref, cur) == ["b", "a"]


def brute_tail(a_size, b_size, ks):
    hits = total = 0
    for chosen in itertools.combinations(range(a_size + b_size), a_size):
        chosen, i, j, worst = set(chosen), 0, 0, 0
        for k in range(a_size + b_size):
            i, j = (i + 1, j) if k in chosen else (i, j + 1)
            worst = max(worst, abs(i * b_size - j * a_size))
        hits += worst >= round(ks * a_size * b_size)
        total += 1
    return hits / total


@pytest.mark.parametrize("n,m", [(8, 6), (5, 5), (1, 4), (3, 7)])
def test_exact_p_value_against_enumeration(n, m):
    for step in range(1, n * m + 1):
        ks = step / (n * m)
        assert drift.exact_tail(ks, n, m) == pytest.approx(brute_tail(n, m, ks), abs=1e-12)
    assert drift.exact_tail(0.0, n, m) == 1.0


def test_series_is_near_the_exact_value(spark):
    for n, ks in ((200, 0.12), (1000, 0.05)):
        df = spark.createDataFrame([(ks, n, n)], "ks double, n long, m long")
        p = df.select(drift.series_p_value(F.col("ks"), F.col("n"), F.col("m"))).first()[0]
        assert p == pytest.approx(drift.exact_tail(ks, n, n), abs=0.02)
    df = spark.createDataFrame([(0.001, 50, 50)], "ks double, n long, m long")
    assert df.select(drift.series_p_value(F.col("ks"), F.col("n"), F.col("m"))).first()[0] == 1.0


def test_one_p_value_for_all_sample_sizes_and_the_exact_one_on_request(spark):
    t = spark.createDataFrame([("s", 0.3, 20, 20), ("l", 0.05, 2_000, 900)], "feature string, ks double, ref_n long, cur_n long")
    p = lambda *a: {r["feature"]: r["p"] for r in drift.with_p_value(t, *a).collect()}
    assert p() == p("series")
    exact = p("exact")
    assert exact["s"] == pytest.approx(drift.exact_tail(0.3, 20, 20)) and exact["s"] != p()["s"]
    assert exact["l"] == pytest.approx(p()["l"], abs=0.01)
    with pytest.raises(ValueError):
        drift.with_p_value(t, "auto")


def test_merged_counts_equal_one_pass(spark):
    ref, one, two = (table(spark, v=range(k, k + 20)) for k in (0, 3, 9))
    side = drift.SIDE
    parts = [d.withColumn(side, F.lit(s)) for d, s in ((ref, False), (one, True), (two, True))]
    counts = drift.merge_counts(*[drift.value_counts(p, ["v"]) for p in parts])
    whole = drift.ks_table(drift.tag_sides(ref, one.unionByName(two)), ["v"]).first()
    assert drift.ks_from_counts(counts, ["v"]).first() == whole


def test_chi_square_equals_mllib(spark):
    rng = np.random.default_rng(3)
    rows = [(str(c), False) for c in rng.integers(0, 4, 400)] + [(str(c), True) for c in rng.integers(0, 5, 300)]
    df = spark.createDataFrame(rows, f"c string, {drift.SIDE} boolean")
    mine = drift.chi_square(df, ["c"]).first()
    indexed = StringIndexer(inputCol="c", outputCol="i").fit(df).transform(df).withColumn("y", F.col(drift.SIDE).cast("double"))
    theirs = ChiSquareTest.test(VectorAssembler(inputCols=["i"], outputCol="f").transform(indexed), "f", "y", flatten=True).first()
    assert mine["statistic"] == pytest.approx(theirs["statistic"]) and mine["degrees"] == theirs["degreesOfFreedom"]
    assert mine["p_value"] == pytest.approx(theirs["pValue"], abs=1e-10)


def test_chi_square_tail():
    assert drift.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert drift.chi_square_tail(5.991464547107979, 2) == pytest.approx(0.05)
    assert drift.chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05)
    assert drift.chi_square_tail(0.0, 3) == 1.0


def trips(spark):
    return spark.createDataFrame(
        [(17, 0, 3.0, 0, 10.0), (18, 0, 4.0, 1, 15.0), (19, 1, 5.0, 2, 20.0), (9, 1, 5.0, 2, 20.0), (9, 0, 1.0, 2, 8.0)],
        "pickup_hour int, is_weekend int, trip_distance_km double, traffic_level int, actual_eta_minutes double",
    )


def test_what_if(spark):
    rows = drift.what_if(trips(spark), 1.5).collect()
    assert [r["actual_eta_minutes"] for r in rows] == pytest.approx([17.25, 25.875, 34.5, 34.5, 9.2])
    assert [r["traffic_level"] for r in rows] == [1, 2, 2, 2, 2]


def test_what_if_parts(spark):
    df = trips(spark)
    calm = drift.what_if(df, 1.5, rush_hour=False, weather=False).collect()
    assert calm == df.collect()
    no_distance = drift.what_if(df.drop("trip_distance_km"), 2.0).collect()
    assert [r["actual_eta_minutes"] for r in no_distance] == [20.0, 30.0, 40.0, 40.0, 8.0]
    some = drift.what_if(df, 2.0, only=F.col("pickup_hour") == 9).collect()
    assert [r["actual_eta_minutes"] for r in some] == pytest.approx([10.0, 15.0, 20.0, 46.0, 9.2])


def test_what_if_summary(spark):
    r = drift.what_if_summary(trips(spark)).first()
    assert (r["original_mean_eta"], r["drifted_mean_eta"]) == (14.6, 24.27)
    assert r["dataset_drift_detected"] is False


def one(spark, name, value):
    return spark.createDataFrame([(value,)], f"{name} double")


def summary(spark, flag, share):
    return spark.createDataFrame([(flag, share)], "dataset_drift_detected boolean, drift_share double")


def decide(spark, base, current, flag=False, share=0.0):
    return policy.retrain_decision(one(spark, "a", base), one(spark, "b", current), summary(spark, flag, share)).first()


def test_policy(spark):
    ok = decide(spark, 5.6, 5.7)
    assert ok["status"] == "HEALTHY" and not ok["retraining_triggered"]
    assert ok["reasons"] == ["Error and inputs are within their limits."]
    bad = decide(spark, 5.825554072316037, 7.2)
    assert bad["status"] == "ACTION_REQUIRED_RETRAIN" and bad["rmse_increase_pct"] == 23.59 and bad["threshold_pct"] == 15.0
    assert bad["reasons"] == ["The error grew by 23.6%; up to 15.0% is allowed."]
    both = decide(spark, 5.6, 12.0, True, 0.4)
    assert len(both["reasons"]) == 2 and both["reasons"][1].startswith("Inputs drifted: 40.0%")


def test_policy_limits(spark):
    assert not decide(spark, 100.0, 115.0)["rmse_breach_detected"]
    assert decide(spark, 100.0, 115.1)["rmse_breach_detected"]
    assert decide(spark, 0.0, 3.0)["rmse_increase_pct"] == 0.0
    assert decide(spark, 5.0, 5.0, True, 0.3)["retraining_triggered"]
    alone = policy.retrain_decision(one(spark, "a", 5.0), one(spark, "b", 5.0)).first()
    assert not alone["drift_detected"] and alone["drift_share"] == 0.0


def test_baseline_defaults(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"model": "RandomForest", "test_rmse": 5.9}')
    record = readers.read_report(spark, str(tmp_path / "m.json"), MODEL_METADATA)
    r = policy.baseline_metrics(record).first()
    assert tuple(r) == ("RandomForest", 5.9, 3.8, 0.72)


def test_report_is_stored_and_read(spark, tmp_path):
    ref, cur = table(spark, a=range(50), b=range(50)), table(spark, a=range(50), b=range(100, 150))
    made = drift.drift_report(ref, cur, "train", "test")
    path = writers.write_report(made, str(tmp_path / "report"))
    r = readers.read_report(spark, path, DRIFT_REPORT).first()
    assert (r["reference_rows"], r["current_rows"], r["reference_dataset"]) == (50, 50, "train")
    assert r["drift_summary"]["drifted_features"] == ["b"] and r["drift_summary"]["drift_share"] == 0.5
    assert math.isclose(made.first()["feature_metrics"]["b"]["ks_statistic"], 1.0)


def enumerated_tail(ks, n, m):
    """All merges of both samples."""
    from itertools import combinations

    limit, far = round(ks * n * m), 0
    merges = list(combinations(range(n + m), n))
    for first in merges:
        i = j = worst = 0
        for t in range(n + m):
            i, j = (i + 1, j) if t in first else (i, j + 1)
            worst = max(worst, abs(i * m - j * n))
        far += worst >= limit
    return far / len(merges)


@pytest.mark.parametrize(("n", "m"), [(1, 1), (3, 5), (6, 4), (5, 5)])
def test_tails_equal_the_enumeration(n, m):
    for steps in range(n * m + 1):
        want = enumerated_tail(steps / (n * m), n, m)
        assert drift.exact_tail(steps / (n * m), n, m) == pytest.approx(want, abs=1e-12)
        assert drift.banded_tail(steps / (n * m), n, m) == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize(("n", "m"), [(40, 70), (300, 200), (1000, 7)])
def test_band_equals_the_whole_lattice(n, m):
    for ks in (0.01, 0.05, 0.1, 0.2, 0.4, 0.9, 1.0):
        assert drift.banded_tail(ks, n, m) == pytest.approx(drift.exact_tail(ks, n, m), abs=1e-10)


def test_law_of_one_finite_sample():
    import numpy as np

    # A published value of the distribution: P(D_10 < 0.274).
    assert 1 - drift.finite_tail(0.274, 10, 10**9) == pytest.approx(0.6284796154565, abs=1e-9)
    # Against drawn samples, and against the limit law.
    rng = np.random.default_rng(1)
    x = np.sort(rng.random((200_000, 8)), axis=1)
    d = np.maximum((np.arange(1, 9) / 8 - x).max(1), (x - np.arange(8) / 8).max(1))
    for ks in (0.15, 0.25, 0.4, 0.6):
        assert drift.finite_tail(ks, 8, 10**9) == pytest.approx((d >= ks).mean(), abs=0.004)
    lam = np.sqrt(20_000) * 0.009
    series = 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 100))
    assert drift.finite_tail(0.009, 40_000, 40_000) == pytest.approx(series, abs=0.01)
    assert [drift.finite_tail(k, 50, 50) for k in (0.0, 1.0)] == [1.0, 0.0] and drift.finite_tail(0.9, 5000, 5000) < 1e-15


def test_methods_by_name(spark):
    table = spark.createDataFrame([("a", 0.3, 60, 50), ("b", 0.1, 60, 50)], "feature string, ks double, ref_n long, cur_n long")
    p = {m: {r.feature: r.p for r in drift.with_p_value(table, m).collect()} for m in ("series", "exact", "finite")}
    assert p["exact"]["a"] == pytest.approx(drift.exact_tail(0.3, 60, 50), abs=1e-12)
    assert all(abs(p[m][f] - p["exact"][f]) < 0.05 for m in p for f in "ab")
    with pytest.raises(ValueError, match="no such p-value"):
        drift.with_p_value(table, "other")


def test_each_kind_of_column_has_its_test(spark):
    from math import erfc, log2, sqrt

    import numpy as np

    from waymeter.params import KindRules

    rng = np.random.default_rng(3)
    rows = [(bool(s), float(rng.normal(s)), int(rng.random() < 0.3 + 0.3 * s), str(rng.integers(0, 4)), None if k % 9 == 0 else float(k % 3)) for s in (0, 1) for k in range(80)]
    df = spark.createDataFrame(rows, "is_current boolean, x double, flag int, word string, level double").withColumn("none", F.lit(None).cast("double"))
    few = {r.feature: r for r in drift.drift_by_kind(df).collect()}
    many = {r.feature: r for r in drift.drift_by_kind(df, rules=KindRules(small=10)).collect()}
    assert set(few) == {"x", "flag", "word", "level"}
    assert {f: (r.kind, r.test) for f, r in few.items()} == {
        "x": ("numbers", "kolmogorov_smirnov"), "flag": ("two-valued", "z"), "word": ("categories", "chi_square"), "level": ("categories", "chi_square")
    }
    assert {f: r.test for f, r in many.items()} == {"x": "wasserstein", "flag": "jensen_shannon", "word": "jensen_shannon", "level": "jensen_shannon"}
    side = lambda k, s: [r[k] for r in rows if r[0] == bool(s) and r[k] is not None]
    # A z-test by hand.
    a, b = sum(side(2, 0)), sum(side(2, 1))
    z = (b - a) / 80 / sqrt((a + b) / 160 * (1 - (a + b) / 160) * 2 / 80)
    assert few["flag"].z == pytest.approx(z) and few["flag"].value == pytest.approx(erfc(abs(z) / sqrt(2))) and few["flag"].drift_detected
    # Distances by hand.
    for name, k in (("word", 3), ("level", 4), ("flag", 2)):
        p, q = ({v: side(k, s).count(v) / len(side(k, s)) for v in {*side(k, 0), *side(k, 1)}} for s in (0, 1))
        js = sum(x * log2(2 * x / (x + y)) for x, y in [*((p[v], q[v]) for v in p), *((q[v], p[v]) for v in p)] if x) / 2
        assert many[name].value == pytest.approx(sqrt(js)) == few[name].jensen_shannon
    x, y = np.sort(side(1, 0)), np.sort(side(1, 1))
    assert many["x"].value == pytest.approx(np.abs(x - y).mean() / x.std()) and many["x"].drift_detected
    edges = np.linspace(min(x[0], y[0]), max(x[-1], y[-1]), 31)
    p, q = (np.histogram(v, edges)[0] / 80 for v in (x, y))
    js = sum(a * log2(2 * a / (a + b)) for a, b in [*zip(p, q, strict=True), *zip(q, p, strict=True)] if a) / 2
    assert many["x"].jensen_shannon == pytest.approx(sqrt(js))
