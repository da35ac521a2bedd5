from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from test_features import toy

from waymeter.operators import features, models
from waymeter.operators.encoding import SparseEncoder
from waymeter.params import NUMERIC
from waymeter.plans import queries

SF = "/root/testdata/sf0.001"


def vectors(df, key):
    return {r[key]: r["features"].toArray().tolist() for r in df.collect()}


@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_same_vectors_as_the_dense_view(spark, tmp_path, fit_on, partitions):
    partitions(3)
    df = toy(spark).withColumn("id", F.monotonically_increasing_id())
    dense = features.FeatureModel.fit(df, F.col("is_train"), fit_on=fit_on)
    sparse = SparseEncoder.fit(df, F.col("is_train"), fit_on=fit_on)
    odd = df.limit(3).withColumns({"pickup_location": F.lit(None).cast("string"), "drop_location": F.lit("Nowhere"), "id": -F.col("id") - 1})
    every = df.unionByName(odd)
    assert sparse.columns == dense.columns and sparse.size == len(dense.columns)
    for group in (True, False):
        want = vectors(dense.assemble(dense.transform(every, keep=["id"], group_rare=group)), "id")
        out = sparse.transform(every, keep=["id"], group_rare=group)
        assert out.columns == ["id", *NUMERIC, "features"] and vectors(out, "id") == want
    sparse.save(spark, str(tmp_path / "e"))
    again = SparseEncoder.load(spark, str(tmp_path / "e"))
    assert again.sizes == sparse.sizes and vectors(again.transform(every, keep=["id"]), "id") == vectors(sparse.transform(every, keep=["id"]), "id")
    view = sparse.dense()
    assert view.columns == dense.columns and view.kept == dense.kept


def test_given_trips(spark):
    rows = queries.stored_features(spark, SF)
    dense, sparse = queries.fitted(rows), SparseEncoder.fit(rows, ~F.col("is_test"))
    key = F.md5(F.to_json(F.struct(*rows.columns))).alias("key")
    keyed = features.materialize(rows.select("*", key), "keyed")
    assert vectors(sparse.transform(keyed, keep=["key"]), "key") == vectors(dense.assemble(dense.transform(keyed, keep=["key"])), "key")


def many(spark, places, copies=2):
    df = toy(spark).limit(1).drop("pickup_location", "is_train")
    ids = spark.range(places * copies).select(F.concat(F.lit("place-"), (F.col("id") % places).cast("string")).alias("pickup_location"), (F.col("id") % places).alias("k"), F.lit(True).alias("is_train"))
    return ids.join(F.broadcast(df)).withColumn("actual_eta_minutes", (F.col("k") % 50).cast("double"))


def test_a_hundred_thousand_places(spark, monkeypatch):
    df = features.materialize(many(spark, 100_000), "many")
    with pytest.raises(ValueError, match="SparseEncoder"):
        features.FeatureModel.fit(df, F.col("is_train"), features.TripRules(rare_below=2))
    encoder = SparseEncoder.fit(df, F.col("is_train"), features.TripRules(rare_below=2))
    assert encoder.sizes["pickup_location"] == 99_999
    out = encoder.transform(df, keep=["k"])
    at = F.unwrap_udt("features")["indices"]
    counted = out.select(F.element_at(at, -1).alias("at"), F.size(at).alias("n")).groupBy("at").count()
    assert counted.where(F.col("at") >= len(NUMERIC)).count() == 99_999
    assert max(r["count"] for r in counted.where(F.col("at") >= len(NUMERIC)).collect()) == 2
    plan = out._jdf.queryExecution().toString()
    assert len(plan) < 60_000


def regression(spark, m, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, m)) * rng.uniform(0.1, 5, m)
    y = x @ rng.normal(size=m) + rng.normal(size=n)
    return spark.createDataFrame([(Vectors.dense(r.tolist()), float(t)) for r, t in zip(x, y, strict=True)], ["features", "actual_eta_minutes"])


def test_iterative_ridge_equals_the_normal_solution(spark):
    df = regression(spark, 100).persist()
    one, other = models.fit_ridge(df, 2.0, solver="normal"), models.fit_ridge(df, 2.0, solver="l-bfgs")
    np.testing.assert_allclose(other.coefficients.toArray(), one.coefficients.toArray(), atol=1e-6)
    assert other.intercept == pytest.approx(one.intercept, abs=1e-6)


def test_ridge_of_twenty_thousand_features(spark):
    df = features.materialize(many(spark, 20_000), "wide")
    encoder = SparseEncoder.fit(df, F.col("is_train"), features.TripRules(rare_below=2))
    rows = encoder.transform(df, keep=["k", "actual_eta_minutes"]).select("k", "features", "actual_eta_minutes")
    model = models.fit_ridge(rows)
    assert encoder.size > models.NORMAL_FEATURES
    # Each place has two rows of one value, so its coefficient is 2 / 3 of the distance from the intercept; the baseline's is 0.
    weights = model.coefficients.toArray()
    names = {r["feature"]: r["position"] for r in encoder.names().where("feature LIKE 'pickup%'").collect()}
    for k in (1, 7, 777, 19_999):
        assert weights[names[f"pickup_location_place-{k}"]] == pytest.approx((k % 50 - model.intercept) * 2 / 3, abs=1e-3)
