from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymeter.operators import models, score, validate
from waymeter.operators.features import FeatureModel, assemble
from waymeter.params import ModelSettings
from waymeter.plans import queries
from waymeter.schemas import REQUEST

SMALL = ModelSettings(forest_trees=5, forest_depth=4, boost_rounds=3, boost_depth=3, newton_rounds=3)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)) * [1.0, 10.0, 0.1]
    y = 3 + x @ [2.0, -0.5, 7.0] + rng.normal(size=400)
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y)]
    df = assemble(spark.createDataFrame(rows, "a double, b double, c double, actual_eta_minutes double"), ["a", "b", "c"])
    return x, y, df.select("features", "actual_eta_minutes")


@pytest.mark.parametrize("alpha", [0.0, 1.0, 50.0])
def test_ridge_equals_the_closed_form(data, alpha):
    x, y, df = data
    model = models.fit_ridge(df, alpha)
    xc, yc = x - x.mean(0), y - y.mean()
    expected = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    np.testing.assert_allclose(model.coefficients.toArray(), expected, rtol=1e-9)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ expected)


def test_candidates_are_compared(spark, data):
    _, _, df = data
    train, test = df.limit(300), df.subtract(df.limit(300))
    fits = models.candidates(SMALL)
    fitted = models.fit_all(train, fits)
    table = models.model_metrics(fitted, train, test)
    rows = table.collect()
    assert len(rows) == 8 and {r["n"] for r in rows if r["split"] == "train"} == {300}
    board = models.leaderboard(table).collect()
    assert [r["test_rmse"] for r in board] == sorted(r["test_rmse"] for r in board)
    best = models.best_model(table).first()
    assert best["model"] == board[0]["model"] == "RidgeRegression"
    record = models.model_record(table).first()
    assert record["model"] == best["model"] and record["traffic_mapping"] == {"Low": 0, "Medium": 1, "High": 2}
    assert [c["model"] for c in record["all_model_comparisons"]] == list(fits)
    info = models.model_info(models.model_record(table), 3).first()
    assert info["n_features"] == 3 and info["test_rmse"] == record["test_rmse"]


def test_fits_at_once_give_the_same_models(data):
    _, _, df = data
    fits = models.candidates(SMALL)
    one, both = models.fit_all(df, fits), models.fit_all(df, fits, together=("GradientBoosting", "NewtonBoosting"))
    assert list(both) == list(fits)
    assert both["GradientBoosting"].toDebugString.split("\n")[1:] == one["GradientBoosting"].toDebugString.split("\n")[1:]
    for a, b in zip(one["NewtonBoosting"].trees, both["NewtonBoosting"].trees, strict=True):
        assert a.feature == b.feature and a.cut == b.cut
        np.testing.assert_allclose(a.value, b.value, atol=1e-9)  # sums of the tasks arrive in any order
    np.testing.assert_allclose(one["RidgeRegression"].coefficients.toArray(), both["RidgeRegression"].coefficients.toArray())
    with pytest.raises(ZeroDivisionError):
        models.fit_all(df, {"a": lambda t: 1 / 0, "b": lambda t: 1}, together=("a", "b"))


@pytest.mark.parametrize("name", ["importance_checks", "model_info"])
def test_rows_are_encoded_once(spark, data, monkeypatch, name):
    _, _, df = data
    calls, ridge = [], models.fit_ridge(df)

    class Encoder:
        columns = ["a", "b", "c"]

    found = {"RandomForest": models.fit_forest(df, SMALL), "RidgeRegression": ridge}
    monkeypatch.setattr(queries, "fitted_candidates", lambda *a: calls.append(1) or (Encoder(), found, df.withColumn("is_test", F.hash("features") % 5 == 0)))
    assert getattr(queries, name)(spark, SF).count() == 1 and len(calls) == 1


def test_ties_go_to_the_earlier_candidate(spark):
    rows = [(0, "a", "test", 2.0), (1, "b", "test", 1.0), (2, "c", "test", 1.0), (0, "a", "train", 0.1)]
    df = spark.createDataFrame(rows, "ord int, model string, split string, rmse double")
    assert models.best_model(df).first()["model"] == "b"


def test_importances(data):
    _, _, df = data
    top = models.feature_importances(models.fit_forest(df, SMALL), ["a", "b", "c"], top=2).collect()
    assert len(top) == 2 and top[0]["feature"] == "b" and top[0]["importance"] >= top[1]["importance"]


def test_stored_model_is_evaluated(spark, data, tmp_path):
    _, _, df = data
    model = models.fit_ridge(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    r = models.evaluate_stored(type(model).load(str(tmp_path / "m")), df).first()
    assert r["num_test_samples"] == 400 and r["test_rmse"] > 0


def test_scoring_with_a_fitted_model(spark):
    rows = queries.stored_features(spark, SF)
    encoder = FeatureModel.fit(rows, ~F.col("is_test"))
    train = encoder.assemble(encoder.transform(rows, keep=["actual_eta_minutes"]))
    model = models.fit_ridge(train.select("features", "actual_eta_minutes"))
    requests = spark.createDataFrame(
        [
            ("a", "Upper West Side", "Harlem", "2026-08-27", "17:30", 1, 1.0),
            ("b", "Chelsea", "South Slope", "2026-08-29", "16:30", None, None),
            ("c", "NonExistentCity", "Harlem", "2026-08-27", "17:30", 1, 1.0),
        ],
        REQUEST,
    )
    valid, rejected = validate.split_requests(requests)
    answers = score.responses(score.score_requests(valid, score.model_predictor(encoder, model)), "request_id")
    got = {r["request_id"]: r for r in answers.collect()}
    assert set(got) == {"a", "b"} and rejected.count() == 1
    assert got["a"]["calculated_distance_km"] == 3.658 and got["a"]["estimated_traffic_level"] == "High"
    assert got["b"]["estimated_traffic_level"] == "Medium"
    assert all(r["eta_minutes"] >= 0.5 and r["success"] for r in got.values())
    # The same numbers by hand from the coefficients.
    from waymeter.operators.features import request_features

    vectors = encoder.assemble(encoder.transform(request_features(valid), keep=["request_id"], group_rare=False))
    for r in vectors.collect():
        raw = float(np.dot(r["features"].toArray(), model.coefficients.toArray()) + model.intercept)
        assert got[r["request_id"]]["eta_minutes"] == pytest.approx(max(raw, 0.5), abs=0.0051)


def test_the_scoring_check_fits_its_model_once(spark, monkeypatch):
    fits = []
    fit = models.fit_ridge
    monkeypatch.setattr(models, "fit_ridge", lambda *a, **k: fits.append(1) or fit(*a, **k))
    valid, _ = validate.split_requests(queries.fixtures.requests(spark, SF))
    assert queries.batch_scoring_checks(spark, SF).first()[:] == (valid.count(), 0) and len(fits) == 1
