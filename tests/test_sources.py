from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from waymeter.session import materialize, shared_folder
from waymeter.sources import readers, writers


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "actual_eta_minutes,pickup_location,passenger_count,mood\n"
        "12.5,Harlem,2.0,fine\nNaN,NA,n/a,\n,null,3,none\nfast,<NA>,many,NULL\n"
    )
    df = readers.read_trips_csv(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {
        "actual_eta_minutes": "double", "pickup_location": "string", "passenger_count": "int", "mood": "string"
    }
    assert [tuple(r) for r in df.collect()] == [
        (12.5, "Harlem", 2, "fine"), (None, None, None, None), (None, None, 3, "none"), (None, None, None, None)
    ]


def test_formats_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2.5), ("b", None, 3.5)], "trip_id string, passenger_count int, trip_distance_km double")
    for fmt in ("parquet", "orc", "json", "csv"):
        path = writers.write_table(df, str(tmp_path / fmt), fmt)
        back = readers.read_trips_csv(spark, path) if fmt == "csv" else readers.read_table(spark, path, fmt)
        assert sorted(back.select(*df.columns).collect()) == sorted(df.collect(), key=lambda r: r[0])


def test_append_by_name(spark):
    old = spark.createDataFrame([("a", 1)], "trip_id string, passenger_count int")
    new = spark.createDataFrame([(2.0, "b")], "surge_multiplier double, trip_id string")
    got = {tuple(r) for r in writers.append_trips(old, new).collect()}
    assert got == {("a", 1, None), ("b", None, 2.0)}


def test_append_and_staging_do_not_rewrite(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "trip_id string")
    raw = str(tmp_path / "raw")
    for _ in range(2):
        writers.append_table(df, raw)
        writers.stage_batch(df, str(tmp_path / "incoming"), "batch_20260827_100000")
    writers.stage_batch(df, str(tmp_path / "incoming"), "batch_20260828_100000")
    assert readers.read_table(spark, raw).count() == 2
    staged = readers.read_table(spark, str(tmp_path / "incoming"))
    assert {(r["batch"], r["count"]) for r in staged.groupBy("batch").count().collect()} == {
        ("batch_20260827_100000", 2), ("batch_20260828_100000", 1)
    }


LOG = """timestamp,passenger_count,distance_km,hour_of_day,day_of_week,is_weekend,predicted_seconds,actual_seconds
2026-08-15T09:44:30,1,5.2,17,2,0,1588.62,
2026-08-26T18:48:42,Upper West Side,Harlem,2026-08-27,17:30,3.658,High,20.18,
2026-08-26T18:49:41+00:00,Chelsea,South Slope,2026-08-27,08:15,9.334,High,29.31,31.5
2026-08-29T11:01:40+02:00,Hell's Kitchen,Kensington,2026-08-29,16:31,13.551,Medium,38.17,
"""


def test_ragged_log(spark, tmp_path):
    (tmp_path / "log.csv").write_text(LOG)
    log = readers.read_log_text(spark, str(tmp_path / "log.csv"))
    assert log.where("is_legacy").count() == 2
    rows = readers.current_log(log).orderBy("ts").collect()
    assert [r["pickup_location"] for r in rows] == ["Upper West Side", "Chelsea", "Hell's Kitchen"]
    by_place = {r["pickup_location"]: r for r in rows}
    assert str(by_place["Hell's Kitchen"]["ts"]) == "2026-08-29 09:01:40"
    assert by_place["Chelsea"]["actual_eta_minutes"] == 31.5
    assert by_place["Upper West Side"]["actual_eta_minutes"] is None
    assert by_place["Upper West Side"]["distance_km"] == 3.658


def test_prediction_log_is_partitioned_by_day(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "pickup_location string").withColumn("timestamp", F.current_timestamp())
    path = writers.append_predictions(df, str(tmp_path / "log"))
    writers.append_predictions(df, path)
    back = readers.read_table(spark, path)
    assert back.count() == 2 and "log_date" in back.columns


def test_log_days_are_pruned(spark, tmp_path):
    days = [("x", "2026-08-27 10:00:00"), ("y", "2026-08-28 10:00:00"), ("z", "2026-09-01 10:00:00")]
    df = spark.createDataFrame(days, "pickup_location string, timestamp string")
    path = writers.append_predictions(df.withColumn("timestamp", F.to_timestamp("timestamp")), str(tmp_path / "log"))
    some = readers.read_log_days(spark, path, "2026-08-28", "2026-08-31")
    assert [r["pickup_location"] for r in some.collect()] == ["y"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan


def test_small_tables_are_spread_and_large_ones_are_not(spark, tmp_path):
    one = str(tmp_path / "one")
    spark.range(10).coalesce(1).write.parquet(one)
    assert readers.spread_small(spark.read.parquet(one)).rdd.getNumPartitions() == 4
    many = str(tmp_path / "many")
    spark.range(10).repartition(6).write.parquet(many)
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 * 1024 * 1024))
    try:
        df = readers.spread_small(spark.read.parquet(many))
        assert "RoundRobin" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_report_defaults(spark, tmp_path):
    (tmp_path / "r.json").write_text('{\n "share": null,\n "name": "x"\n}')
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("share", T.DoubleType()), T.StructField("name", T.StringType()), T.StructField("flag", T.BooleanType())])
    r = readers.read_report(spark, str(tmp_path / "r.json"), schema, {"share": 0.0, "flag": False}).first()
    assert tuple(r) == (0.0, "x", False)


def test_materialize_cuts_the_lineage(spark):
    df = materialize(spark.range(10).select((F.col("id") * 2).alias("v")), "test")
    assert df.agg(F.sum("v")).first()[0] == 90
    assert shared_folder(spark) in df.inputFiles()[0]


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session(master))


def test_headers_that_differ_are_an_error_and_whole_numbers_stay_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pickup_location,passenger_count\nA,2.0\nB,2.5\n")
    rows = readers.read_trips_csv(spark, str(tmp_path)).orderBy("pickup_location").collect()
    assert [r["passenger_count"] for r in rows] == [2, None]
    (tmp_path / "b.csv").write_text("passenger_count,pickup_location\n1,C\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_trips_csv(spark, str(tmp_path)).collect()
