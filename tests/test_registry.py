from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_features import toy

from waymeter.operators import features, models, newton, policy, registry
from waymeter.operators.encoding import SparseEncoder
from waymeter.params import TARGET
from waymeter.schemas import REQUEST
from waymeter.streaming import jobs


@pytest.fixture(scope="module")
def rows(spark):
    df = toy(spark).withColumn(TARGET, F.col("pickup_hour") * 2.0 + F.when(F.col("season") == "Summer", 5.0).otherwise(1.0))
    return features.materialize(df, "toy")


def fitted(rows, factor=1.0):
    encoder = SparseEncoder.fit(rows, F.col("is_train"))
    train = encoder.transform(rows.withColumn(TARGET, F.col(TARGET) * factor), keep=[TARGET])
    return encoder, models.fit_ridge(train.select("features", TARGET))


def decision(spark, retrain=True):
    one = lambda v: spark.createDataFrame([(v,)], "rmse double")
    return policy.retrain_decision(one(1.0), one(2.0 if retrain else 1.0))


def test_versions_and_champion(spark, rows, tmp_path):
    store = registry.ModelStore(spark, str(tmp_path / "store"))
    assert store.champion() is None and store.records().count() == 0
    encoder, model = fitted(rows)
    assert [store.publish(encoder, model, n) for n in "ab"] == [1, 2]
    assert store.champion() is None
    store.promote(2)
    store.promote(1)
    assert store.champion() == 1 and [r.version for r in store.promotions().orderBy("commit").collect()] == [2, 1]
    again = store.load(2)
    assert registry.rmse(*again, rows) == pytest.approx(registry.rmse(encoder, model, rows))
    assert registry.rmse(*again, rows.limit(0)) is None
    for call in (store.promote, store.load):
        with pytest.raises(ValueError, match="no version 7"):
            call(7)
    trees = newton.fit_newton(encoder.transform(rows, keep=[TARGET]).select("features", TARGET), newton.NewtonSettings(rounds=2, depth=2))
    dense = features.FeatureModel.fit(rows, F.col("is_train"))
    assert store.publish(dense, trees) == 3 and registry.rmse(*store.load(3), rows) == pytest.approx(registry.rmse(encoder, trees, rows))


def test_the_loop_promotes_only_what_is_better(spark, rows, tmp_path):
    store = registry.ModelStore(spark, str(tmp_path / "store"))
    act = lambda d, factor: registry.act_on(d, store, lambda: fitted(rows, factor), rows).first()
    first = act(decision(spark), 3.0)
    assert (first.action, first.champion, first.candidate, first.champion_rmse) == ("promoted", 1, 1, None)
    assert act(decision(spark, False), 1.0).action == "kept" and store.records().count() == 1
    worse = act(decision(spark), 5.0)
    assert (worse.action, worse.champion, worse.candidate) == ("rejected", 1, 2) and worse.candidate_rmse > worse.champion_rmse
    better = act(decision(spark), 1.0)
    assert (better.action, better.champion, better.candidate) == ("promoted", 3, 3)

    def broken():
        raise RuntimeError("no memory\nat all")

    failed = registry.act_on(decision(spark), store, broken, rows).first()
    assert (failed.action, failed.champion, failed.candidate, failed.reason) == ("failed", 3, None, "RuntimeError: no memory")


def test_a_crash_leaves_the_champion(spark, rows, tmp_path, monkeypatch):
    store = registry.ModelStore(spark, str(tmp_path / "store"))
    store.promote(store.publish(*fitted(rows, 3.0)))
    put = registry.ModelStore._put
    for name in ("records", "champion"):

        def crash(self, path, *rest, name=name):
            if path.startswith(name):
                raise KeyboardInterrupt
            return put(self, path, *rest)

        monkeypatch.setattr(registry.ModelStore, "_put", crash)
        with pytest.raises(KeyboardInterrupt):
            registry.act_on(decision(spark), store, lambda: fitted(rows), rows)
        assert store.champion() == 1
    # A version whose record was not written does not exist; its number is used again.
    monkeypatch.setattr(registry.ModelStore, "_put", put)
    assert [r.version for r in store.records().orderBy("version").collect()] == [1, 2]
    assert registry.act_on(decision(spark), store, lambda: fitted(rows), rows).first().champion == 3


def test_a_stream_follows_the_champion(spark, rows, tmp_path):
    store = registry.ModelStore(spark, str(tmp_path / "store"))
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")

    def arrive(*names):
        for n in names:
            spark.createDataFrame([(n, "Harlem", "Chelsea", "2016-03-14", "17:24", 1, 1.0)], REQUEST).coalesce(1).write.mode("append").parquet(source)

    def take():
        jobs.finish(jobs.score_stream_following(jobs.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1), folder, store, "request_id"))

    arrive("a", "b")
    with pytest.raises(Exception, match="promoted"):
        take()
    store.promote(store.publish(*fitted(rows)))
    take()
    store.promote(store.publish(*fitted(rows, 2.0)))
    arrive("c", "d")
    take()
    got = {r.request_id: (r.model_version, r.predicted_eta_minutes) for r in spark.read.parquet(f"{folder}/data").collect()}
    assert {k: v for k, (v, _) in got.items()} == {"a": 1, "b": 1, "c": 2, "d": 2}
    assert got["c"][1] > got["a"][1]


def test_a_batch_that_runs_again_takes_the_same_version(spark, rows, tmp_path, monkeypatch):
    store = registry.ModelStore(spark, str(tmp_path / "store"))
    store.promote(store.publish(*fitted(rows)))
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", "Harlem", "Chelsea", "2016-03-14", "17:24", 1, 1.0)], REQUEST).write.parquet(source)
    stream = lambda: jobs.file_stream(spark, source, spark.read.parquet(source).schema)
    with monkeypatch.context() as m:

        def broken(*_):
            raise RuntimeError("executor lost")

        m.setattr(jobs.score, "log_rows", broken)
        with pytest.raises(Exception, match="executor lost"):
            jobs.finish(jobs.score_stream_following(stream(), folder, store, "request_id"))
    store.promote(store.publish(*fitted(rows, 2.0)))
    jobs.finish(jobs.score_stream_following(stream(), folder, store, "request_id"))
    assert [r.model_version for r in spark.read.parquet(f"{folder}/data").collect()] == [1]
