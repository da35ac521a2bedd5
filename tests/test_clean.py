from __future__ import annotations

from pyspark.sql import functions as F

from waymeter.operators import clean
from waymeter.sources import fixtures, readers, writers

RAW = (
    "trip_id string, pickup_location string, drop_location string, pickup_date string, pickup_time string, "
    "time_of_day string, season string, passenger_count int, trip_distance_km double, traffic_level string, "
    "actual_eta_minutes double"
)
SF = "/root/testdata/sf0.001"


def row(trip="a", time_of_day="2. Afternoon", season="2. Spring", passengers=1, km=3.5, eta=12.0):
    return (trip, "Harlem", "Midtown", "14-03-2016", "17:24", time_of_day, season, passengers, km, "High", eta)


def test_raw_trips_are_cleaned_and_written(spark, tmp_path):
    raw = spark.createDataFrame([row("a"), row("b", km=4.0), row("c", passengers=0)], RAW)
    out = clean.clean(raw)
    path = writers.write_table(out, str(tmp_path / "clean"))
    stored = readers.read_table(spark, path)
    assert "trip_id" not in stored.columns
    assert stored.count() == 2
    assert {r["season"] for r in stored.collect()} == {"Spring"}
    assert {r["time_of_day"] for r in stored.collect()} == {"Afternoon"}


def test_rows_equal_but_for_id_and_prefix_collapse(spark):
    raw = spark.createDataFrame([row("a", season="2. Spring"), row("b", season="Spring")], RAW)
    assert clean.clean(raw).count() == 1


def test_missing_values_and_ranges(spark):
    rows = [
        row("a", season=None), row("b", eta=None), row("c", eta=float("nan")), row("d", eta=0.49),
        row("e", eta=200.01), row("f", km=0.0), row("g", eta=0.5), row("h", eta=200.0),
    ]
    kept = {r["actual_eta_minutes"] for r in clean.clean(spark.createDataFrame(rows, RAW)).collect()}
    assert kept == {0.5, 200.0}


def test_optional_columns_may_be_absent(spark):
    df = spark.createDataFrame([("Harlem", 5.0), ("Harlem", 5.0), ("Harlem", 300.0)], "pickup_location string, actual_eta_minutes double")
    assert clean.clean(df).count() == 1


def test_accounting_adds_up(spark):
    rows = [row("a"), row("b"), row("c", eta=None), row("d", eta=900.0), row("e", passengers=0), row("f", km=-1.0)]
    r = clean.account(spark.createDataFrame(rows, RAW)).first()
    assert (r["initial_rows"], r["duplicate_rows"], r["kept_rows"], r["dropped_rows"]) == (6, 1, 1, 5)
    assert r["missing_rows"] == r["target_out_of_range_rows"] == 1
    assert r["bad_passenger_count_rows"] == r["bad_trip_distance_km_rows"] == 1


def test_accounting_of_an_empty_table(spark):
    r = clean.account(spark.createDataFrame([], RAW)).first()
    assert r["initial_rows"] == r["kept_rows"] == r["dropped_rows"] == 0


def test_one_hot_row_group_of_copies(spark):
    copies = spark.range(20_000).select(F.lit("x").alias("pickup_location"), F.lit(3.0).alias("actual_eta_minutes"))
    assert clean.clean(copies).count() == 1
    assert clean.account(copies).first()["duplicate_rows"] == 19_999


def test_filters_reach_the_scan(spark, tmp_path):
    path = writers.write_table(spark.createDataFrame([row()], RAW), str(tmp_path / "raw"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = clean.clean(readers.read_table(spark, path))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    for part in ("GreaterThanOrEqual(actual_eta_minutes,0.5)", "GreaterThan(passenger_count,0)", "IsNotNull(season)"):
        assert part in pushed
    assert "trip_id" not in plan[plan.index("ReadSchema"):]


def test_clean_does_not_depend_on_partitions(spark, partitions):
    found = []
    for n in (1, 4, 17):
        partitions(n)
        out = clean.clean(fixtures.trips(spark, SF)).select(F.xxhash64("*").alias("h"))
        found.append((out.count(), out.agg(F.sum(F.col("h") % 1000)).first()[0]))
    assert len(set(found)) == 1
    assert found[0][0] == 4822


def test_accounting_of_the_write_equals_the_batch_accounting(spark, tmp_path):
    for k, trips in enumerate((fixtures.trips(spark, SF), fixtures.trips(spark, SF).limit(0), fixtures.trips(spark, SF).drop("actual_eta_minutes"))):
        got = clean.write_clean(trips, f"{tmp_path}/{k}")
        assert got.first() == clean.account(trips).first() and got.columns == clean.account(trips).columns
        assert spark.read.parquet(f"{tmp_path}/{k}").exceptAll(clean.clean(trips)).isEmpty()
