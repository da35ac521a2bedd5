"""Streams over several files against their batch twins."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from waymeter.operators import clean, drift, features, metrics, score, validate
from waymeter.plans.queries import log_sides, numeric_rows
from waymeter.params import NUMERIC, TARGET, DriftRules
from waymeter.sources import fixtures
from waymeter.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """The events table as four files, landed one after the other in event-time order."""
    folder = str(tmp_path_factory.mktemp("events"))
    df = fixtures.given(spark, SF, "events")
    quarter = F.ntile(4).over(__import__("pyspark").sql.Window.orderBy("ts"))
    df = df.withColumn("q", quarter).persist()
    for q in range(1, 5):
        df.where(F.col("q") == q).drop("q").coalesce(1).write.mode("append").parquet(folder)
    return folder, df.drop("q").schema, df.drop("q")


@pytest.fixture(scope="module")
def lineitem(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lineitem"))
    df = fixtures.given(spark, SF, "lineitem")
    for part in range(3):
        df.where(F.col("l_linenumber") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
    return folder, df.schema


def log_stream(spark, events, column="ts"):
    folder, schema, _ = events
    raw = jobs.file_stream(spark, folder, schema, files_per_batch=1)
    return jobs.event_time(fixtures.prediction_log_from(raw), column)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_clean_stream(spark, lineitem, tmp_path):
    folder, schema = lineitem
    raw = fixtures.trips_from(jobs.file_stream(spark, folder, schema, files_per_batch=1))
    query = jobs.clean_stream(raw, str(tmp_path))
    jobs.finish(query)
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) == 3
    batch = clean.clean(fixtures.trips(spark, SF))
    assert rows(jobs.cleaned_so_far(spark, str(tmp_path))) == rows(batch)
    rejected = spark.read.parquet(f"{tmp_path}/rejected").count()
    usable = clean.drop_unusable(clean.standardize(fixtures.trips(spark, SF))).count()
    assert rejected == fixtures.trips(spark, SF).count() - usable


def test_score_stream(spark, lineitem, tmp_path):
    folder, schema = lineitem
    requests = fixtures.requests_from(jobs.file_stream(spark, folder, schema, files_per_batch=1))
    jobs.finish(jobs.score_stream(requests, str(tmp_path), score.baseline_predictor, "request_id"))
    valid, _ = validate.split_requests(fixtures.requests(spark, SF))
    batch = score.log_rows(score.score_requests(valid, score.baseline_predictor), "request_id")
    assert rows(spark.read.parquet(f"{tmp_path}/data").drop("timestamp")) == rows(batch.drop("timestamp"))


def test_count_and_histogram_streams(spark, events, tmp_path):
    log = fixtures.prediction_log(spark, SF)
    for job, twin in (
        (jobs.count_stream, metrics.requests_per_minute),
        (jobs.histogram_stream, metrics.sliding_histogram),
    ):
        out = f"{tmp_path}/{job.__name__}"
        jobs.finish(job(log_stream(spark, events), out, finished_only=False))
        assert rows(jobs.latest(spark, out)) == rows(twin(log))


@pytest.mark.parametrize("job,twin,minutes", [
    (jobs.count_stream, metrics.requests_per_minute, 1), (jobs.histogram_stream, metrics.sliding_histogram, 5),
])
def test_finished_windows_are_appended_once(spark, events, tmp_path, job, twin, minutes):
    jobs.finish(job(log_stream(spark, events), str(tmp_path), finished_only=True))
    log = fixtures.prediction_log(spark, SF)
    got, want = rows(spark.read.parquet(f"{tmp_path}/data")), rows(twin(log))
    assert len(got) == len(set(got)) and set(got) <= set(want)
    # Only windows that end within ten minutes of the last event may still be open.
    horizon = log.agg(F.max("ts") - F.expr(f"INTERVAL {10 + minutes + 1} MINUTES")).first()[0]
    closed = rows(twin(log).where(F.col("window_start") < F.lit(horizon)))
    assert closed and set(closed) <= set(got)


def test_quarantine_stream(spark, lineitem, tmp_path):
    folder, schema = lineitem
    requests = fixtures.requests_from(jobs.file_stream(spark, folder, schema, files_per_batch=1))
    jobs.finish(jobs.quarantine_stream(requests, str(tmp_path)))
    _, rejected = validate.split_requests(fixtures.requests(spark, SF))
    assert rows(spark.read.parquet(f"{tmp_path}/data")) == rows(rejected)


def test_dedupe_stream(spark, events, tmp_path):
    doubled = log_stream(spark, events).withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).drop("again")
    jobs.finish(jobs.dedupe_stream(doubled, str(tmp_path)))
    assert rows(spark.read.parquet(f"{tmp_path}/data")) == rows(fixtures.prediction_log(spark, SF))


def test_match_stream(spark, events, tmp_path):
    # Repeated rows on both sides must not multiply.
    twice = F.explode(F.array(F.lit(0), F.lit(1)))
    predictions, _ = log_sides(log_stream(spark, events))
    _, actuals = log_sides(log_stream(spark, events, "actual_ts"))
    doubled = [s.withColumn("again", twice).drop("again") for s in (predictions, actuals)]
    jobs.finish(jobs.match_stream(*doubled, str(tmp_path)))
    batch = metrics.monitored_errors(*log_sides(fixtures.prediction_log(spark, SF)))
    got = spark.read.parquet(f"{tmp_path}/data")
    assert rows(got.select(*batch.columns)) == rows(batch)


def test_drift_stream_decides_per_batch(spark, lineitem, tmp_path):
    folder, schema = lineitem
    trips = clean.clean(fixtures.trips(spark, SF))
    baseline = numeric_rows(features.trip_features(trips)).persist()
    raw = clean.standardize(fixtures.trips_from(jobs.file_stream(spark, folder, schema, files_per_batch=1), False))
    current = drift.what_if(numeric_rows(features.trip_features(clean.drop_unusable(raw))), 1.5)
    columns = [*NUMERIC, TARGET]

    def errors(df):
        return df.agg(F.sqrt(F.avg(F.pow(F.col(TARGET) - 20.0, 2))).alias("rmse"))

    query = jobs.drift_stream(
        current, str(tmp_path), baseline, columns, errors(baseline), errors, method="series"
    )
    jobs.finish(query)
    decisions = spark.read.parquet(f"{tmp_path}/decision").collect()
    assert len(decisions) == 3
    assert all(d["rmse_breach_detected"] and d["status"] == "ACTION_REQUIRED_RETRAIN" for d in decisions)
    summaries = spark.read.parquet(f"{tmp_path}/summary").collect()
    assert all("actual_eta_minutes" in s["drifted_features"] for s in summaries)
    # One batch by hand: linenumber 3 and 6 landed first.
    first = drift.what_if(
        numeric_rows(features.trip_features(clean.drop_unusable(clean.standardize(
            fixtures.trips_from(fixtures.given(spark, SF, "lineitem").where("l_linenumber % 3 = 0"), False))))), 1.5)
    expected = drift.feature_drift(drift.tag_sides(baseline, first, columns), columns, "series")
    stored = spark.read.parquet(f"{tmp_path}/features").where("batch_id = 0").drop("batch_id")
    assert rows(stored) == rows(expected)


def test_a_failing_stream_raises(spark, events, tmp_path):
    def write(batch, batch_id):
        raise RuntimeError("no space")

    with pytest.raises(Exception, match="no space"):
        jobs.finish(jobs.write_batches(log_stream(spark, events), str(tmp_path), write))


def test_clean_stream_accepts_trips_without_a_target(spark, lineitem, tmp_path):
    folder, schema = lineitem
    raw = fixtures.trips_from(jobs.file_stream(spark, folder, schema)).drop("actual_eta_minutes")
    jobs.finish(jobs.clean_stream(raw, str(tmp_path)))
    batch = clean.clean(fixtures.trips(spark, SF).drop("actual_eta_minutes"))
    assert rows(jobs.cleaned_so_far(spark, str(tmp_path))) == rows(batch)


def test_drift_stream_counts_copies_once(spark, tmp_path):
    # Row 1 twice in a batch, row 2 and a row with a null again in the next; equal values of other rows stay.
    schema = "id long, note string, x double"
    parts = [[(1, "a", 5.0), (1, "a", 5.0), (2, None, 7.0)], [(2, None, 7.0), (3, "c", 5.0), (4, "d", 9.0)]]
    for k, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    baseline = spark.createDataFrame([(float(k),) for k in range(10)], "x double")
    stream = jobs.file_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, files_per_batch=1)
    jobs.finish(jobs.drift_stream(stream, f"{tmp_path}/out", baseline, ["x"], method="series", rules=DriftRules(min_samples=1), once=True, derive=lambda df: df.select("x")))
    stored = spark.read.parquet(f"{tmp_path}/out/features")
    assert [(r.ref_rows, r.curr_rows, r.curr_mean) for r in stored.orderBy("batch_id").collect()] == [(10, 2, 6.0), (10, 2, 7.0)]


def test_copies_are_told_from_earlier_runs_by_the_state(spark, tmp_path):
    """A restart finds the hashes of earlier micro-batches; rows are not read again."""
    schema = "id long, note string, x double"
    source = f"{tmp_path}/in"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def take():
        stream = jobs.file_stream(spark, source, spark.read.parquet(source).schema)
        jobs.finish(jobs.append_to(jobs.drop_copies(stream), f"{tmp_path}/out"))
        return sorted((r.id, r.note or "", r.x) for r in spark.read.parquet(f"{tmp_path}/out/data").collect())

    arrive([(1, "a", 5.0), (1, "a", 5.0), (2, None, 7.0)])
    assert take() == [(1, "a", 5.0), (2, "", 7.0)]
    arrive([(2, None, 7.0), (1, "a", 5.0), (1, None, 5.0), (3, "c", 5.0)])
    assert take() == [(1, "", 5.0), (1, "a", 5.0), (2, "", 7.0), (3, "c", 5.0)]
    arrive([(3, "c", 5.0)])
    assert len(take()) == 4


def test_cleaning_counts_what_each_batch_drops(spark, lineitem, tmp_path):
    folder, schema = lineitem
    raw = fixtures.trips_from(jobs.file_stream(spark, folder, schema, files_per_batch=1))
    jobs.finish(jobs.clean_stream(raw, str(tmp_path)))
    found = spark.read.parquet(f"{tmp_path}/accounting").orderBy("batch_id").collect()
    assert len(found) == 3
    kept = {r.batch_id: r["count"] for r in spark.read.parquet(f"{tmp_path}/valid").groupBy("batch_id").count().collect()}
    for r in found:
        assert r.kept_rows == kept[r.batch_id] and r.initial_rows == r.kept_rows + r.dropped_rows
    assert sum(r.initial_rows for r in found) == fixtures.trips(spark, SF).count()


def test_unmatched_predictions_are_appended_when_none_can_come(spark, tmp_path):
    from datetime import datetime, timedelta

    start = datetime(2026, 1, 1)
    at = lambda h: start + timedelta(hours=h)
    predictions = [(1, at(0), 5.0), (2, at(0), 6.0), (3, at(1), 7.0), (4, at(9), 8.0)]
    actuals = [(1, at(1), 5.5), (2, at(6), 6.5), (9, at(9), 1.0)]  # the second comes too late
    spark.createDataFrame(predictions, "event_id long, ts timestamp, predicted_eta_minutes double").coalesce(1).write.parquet(f"{tmp_path}/p")
    spark.createDataFrame(actuals, "event_id long, actual_ts timestamp, actual_eta_minutes double").coalesce(1).write.parquet(f"{tmp_path}/a")
    source = lambda n, c: jobs.event_time(jobs.file_stream(spark, f"{tmp_path}/{n}", spark.read.parquet(f"{tmp_path}/{n}").schema), c)
    jobs.finish(jobs.match_stream(source("p", "ts"), source("a", "actual_ts"), f"{tmp_path}/out", unmatched=True))
    got = sorted((r.event_id, r.actual_eta_minutes) for r in spark.read.parquet(f"{tmp_path}/out/data").collect())
    assert got == [(1, 5.5), (2, None), (3, None)]  # the last one's time is not over
    table = metrics.coverage(spark.read.parquet(f"{tmp_path}/out/data")).orderBy("window_start").collect()
    assert [(r.predictions, r.matched, r.coverage) for r in table] == [(2, 1, 0.5), (1, 0, 0.0)] and table[0].rmse == 0.5 and table[1].rmse is None


def test_batches_are_taken_once_and_archived(spark, tmp_path):
    from datetime import datetime

    from waymeter.sources import writers

    folder, archive = f"{tmp_path}/incoming", f"{tmp_path}/archive"

    def stage(k):
        writers.stage_batch_at(spark.createDataFrame([(k,)], "id long"), folder, datetime(2026, 1, 1, k))

    def take():
        jobs.finish(jobs.append_to(jobs.incoming_stream(spark, folder, spark.range(1).schema, archive), f"{tmp_path}/out"))
        return sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out/data").collect())

    for k in range(3):
        stage(k)
    assert take() == [0, 1, 2]
    stage(3)
    assert take() == [0, 1, 2, 3] and take() == [0, 1, 2, 3]
    moved = [p.name for p in (tmp_path / "archive").rglob("part-*.parquet")]
    left = [p.name for p in (tmp_path / "incoming").rglob("part-*.parquet")]
    assert len(moved) >= 2 and len(moved) + len(left) == 4 and not set(moved) & set(left)
    with pytest.raises(Exception, match="exists"):
        stage(3)


def test_a_large_staged_batch_has_many_files(spark, tmp_path):
    from datetime import datetime

    from waymeter.sources import writers

    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32KB"}
    before = {k: spark.conf.get(k) for k in sizes}
    rows_ = spark.range(100_000).select("id", F.md5(F.col("id").cast("string")).alias("note"))
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        path = writers.stage_batch_at(rows_, f"{tmp_path}/incoming", datetime(2026, 1, 1))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(spark.read.parquet(path).inputFiles()) > 1
    stream = jobs.incoming_stream(spark, f"{tmp_path}/incoming", rows_.schema, f"{tmp_path}/archive")
    query = jobs.write_batches(stream, f"{tmp_path}/out", lambda batch, k: batch.write.parquet(f"{tmp_path}/out/data/batch_id={k}"))
    jobs.finish(query)
    taken = spark.read.parquet(f"{tmp_path}/out/data")
    assert taken.select("batch_id").distinct().count() == 1 and taken.select("id").distinct().count() == taken.count() == 100_000


def test_followed_requests_are_written_by_every_task(spark, tmp_path):
    from glob import glob

    from waymeter.plans import queries

    def folders():
        return set(glob(f"{queries.scratch_path(spark, 'x').rsplit('/', 1)[0].removeprefix('file:')}/incoming-*"))

    old = folders()
    found = queries.stream_followed(spark, SF)
    versions = {r["model_version"]: r["count"] for r in found.groupBy("model_version").count().collect()}
    assert set(versions) == {1, 2} and found.count() == validate.split_requests(fixtures.requests(spark, SF))[0].count()
    folder, = folders() - old
    assert len(glob(f"{folder}/part-*.parquet")) > 4


def test_the_drift_stream_remembers_only_the_rows_it_tests(spark, tmp_path, monkeypatch):
    from waymeter.plans import queries

    key = F.col("id")
    lineitem = spark.range(400).select(
        key.alias("l_orderkey"), (key * 7 % 90).alias("l_partkey"), (key * 3 % 40).alias("l_suppkey"), (key % 7 + 1).cast("int").alias("l_linenumber"),
        (key % 45 + 1).cast("double").alias("l_quantity"), (1000 + key * 13 % 4000).cast("double").alias("l_extendedprice"),
        (key % 10 / 100).alias("l_discount"), F.lit("A").alias("l_returnflag"),
        F.expr("timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(id % 300 as int))").alias("l_shipdate"),
    )
    lineitem.write.parquet(f"{tmp_path}/lineitem.parquet")
    finished, finish = [], jobs.finish
    monkeypatch.setattr(jobs, "finish", lambda query: finished.append(query) or finish(query))
    queries.drift_streamed(spark, str(tmp_path))
    held = [o["numRowsTotal"] for p in finished[0].recentProgress for o in p["stateOperators"]]
    trips = queries.featured(spark, str(tmp_path))
    assert 0 < trips.where("is_test").count() == max(held) < trips.count()
