from __future__ import annotations

import pytest

from waymeter.operators import validate
from waymeter.schemas import REQUEST
from waymeter.sources.locations import location_dimension

TRIPS = (
    "pickup_location string, drop_location string, pickup_date string, pickup_time string, traffic_level string, "
    "actual_eta_minutes double, passenger_count int, trip_distance_km double"
)


def trip(place="Harlem", level="High", eta=20.0, passengers=1):
    return (place, "Midtown", "2026-08-27", "17:30", level, eta, passengers, 5.0)


def found(df, **kw):
    return {(r["check"], r["subject"]): r["n"] for r in validate.dataset_issues(df, **kw).collect()}


def test_valid_table(spark):
    df = spark.createDataFrame([trip(), trip("Midtown", "Low", 10.0)], TRIPS)
    assert found(df, strict_locations=True) == {}
    validate.require_valid(df)


def test_missing_columns_end_the_check(spark):
    df = spark.createDataFrame([("Harlem",)], "pickup_location string")
    issues = found(df)
    assert len(issues) == 5 and all(check == "missing_column" for check, _ in issues)
    with pytest.raises(validate.DatasetInvalid, match="Missing required column"):
        validate.require_valid(df)


def test_target_outside(spark):
    df = spark.createDataFrame([trip(eta=999.0)], TRIPS)
    with pytest.raises(validate.DatasetInvalid, match="outside"):
        validate.require_valid(df)


def test_empty_table(spark):
    with pytest.raises(validate.DatasetInvalid, match="empty"):
        validate.require_valid(spark.createDataFrame([], TRIPS))


def test_all_findings_in_one_table(spark):
    rows = [trip(), trip("Atlantis", None, 0.1), trip("Atlantis", "Gridlock", 500.0, None), trip("Mu", "Gridlock")]
    df = spark.createDataFrame(rows, TRIPS)
    expected = {
        ("missing_value", "traffic_level"): 1,
        ("missing_value", "passenger_count"): 1,
        ("target_out_of_range", "actual_eta_minutes"): 2,
        ("unexpected_traffic", "null"): 1,
        ("unexpected_traffic", "Gridlock"): 2,
    }
    assert found(df) == expected
    strict = found(df, strict_locations=True)
    assert strict == {**expected, ("unknown_pickup", "Atlantis"): 2, ("unknown_pickup", "Mu"): 1}


def test_error_text_has_a_line_for_each_check_and_column(spark):
    df = spark.createDataFrame([trip(level=f"L{i}") for i in range(10)], TRIPS)
    with pytest.raises(validate.DatasetInvalid) as e:
        validate.require_valid(df)
    assert str(e.value) == "Found unexpected traffic level: 'L0' (the first of 10 values in 10 rows)"


def test_unknown_values(spark):
    df = spark.createDataFrame([("Harlem",), ("Atlantis",), ("Atlantis",)], "p string")
    assert [r["value"] for r in validate.unknown_values(df, "p", location_dimension(spark)).collect()] == ["Atlantis"]


def request(key="r", pickup="Harlem", drop="Midtown", date="2026-08-27", time="17:30", passengers=1, surge=1.0):
    return (key, pickup, drop, date, time, passengers, surge)


def test_requests_are_split(spark):
    rows = [
        request("ok"),
        request("blanks", pickup=" Harlem\t", time="8:15", date="2026-8-7"),
        request("nulls", passengers=None, surge=None),
        request("edges", passengers=8, surge=5.0),
        request("place", pickup="NonExistentCity"),
        request("drop", drop=None),
        request("date", date="27-08-2026"),
        request("no_such_day", date="2026-02-30"),
        request("time", time="25:61"),
        request("time_text", time="noon"),
        request("people", passengers=9),
        request("nobody", passengers=0),
        request("surge", surge=5.1),
        request("two", pickup="x", surge=0.5),
    ]
    valid, rejected = validate.split_requests(spark.createDataFrame(rows, REQUEST))
    assert {r["request_id"] for r in valid.collect()} == {"ok", "blanks", "nulls", "edges"}
    reasons = {r["request_id"]: r["reasons"] for r in rejected.collect()}
    assert reasons == {
        "place": ["pickup_location"], "drop": ["drop_location"], "date": ["pickup_date"],
        "no_such_day": ["pickup_date"], "time": ["pickup_time"], "time_text": ["pickup_time"],
        "people": ["passenger_count"], "nobody": ["passenger_count"], "surge": ["surge_multiplier"],
        "two": ["pickup_location", "surge_multiplier"],
    }
    assert valid.where("request_id = 'blanks'").first()["pickup_location"] == "Harlem"


def test_batch_coercion(spark):
    rows = [
        ("Atlantis", "Mu", "14-03-2016", "17:24:59", "2.7", None),
        (" Harlem", "Chelsea", "2016-03-14", "8:15", "x", "1.5"),
        (None, None, None, None, None, "nope"),
        ("Harlem", "Harlem", "1-3-2016", "17:24", "3", "2"),
    ]
    df = spark.createDataFrame(rows, "pickup_location string, drop_location string, pickup_date string, "
                                     "pickup_time string, passenger_count string, surge_multiplier string")
    got = [tuple(r) for r in validate.coerce_batch(df).collect()]
    assert got == [
        ("Upper West Side", "Harlem", "2016-03-14", "17:24", 2, 1.0),
        ("Upper West Side", "Chelsea", "2016-03-14", "12:00", 1, 1.5),
        ("Upper West Side", "Harlem", "2026-08-27", "12:00", 1, 1.0),
        ("Harlem", "Harlem", "2016-03-01", "17:24", 3, 2.0),
    ]


def test_batch_coercion_adds_absent_columns(spark):
    df = validate.coerce_batch(spark.createDataFrame([("Harlem",)], "pickup_location string"))
    r = df.first().asDict()
    assert r == {
        "pickup_location": "Harlem", "drop_location": "Harlem", "pickup_date": "2026-08-27",
        "pickup_time": "12:00", "passenger_count": 1, "surge_multiplier": 1.0,
    }
    assert validate.flag_same_place(df).first()["same_place"]
