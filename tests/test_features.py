from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from waymeter.functions import temporal
from waymeter.operators import features
from waymeter.operators.clean import clean
from waymeter.params import NUMERIC
from waymeter.schemas import REQUEST
from waymeter.sources import fixtures
from waymeter.sources.locations import LOCATION_NAMES, LOCATIONS, location_dimension

SF = "/root/testdata/sf0.001"
DISTANCES = [
    ("Upper West Side", "Harlem", 3.658),
    ("Chelsea", "South Slope", 9.334),
    ("Upper West Side", "South Slope", 13.848),
    ("Hell's Kitchen", "Kensington", 13.551),
    ("Hell's Kitchen", "West Village", 3.513),
    ("Hell's Kitchen", "Crown Heights", 11.396),
    ("Hell's Kitchen", "Arden Heights", 28.21),
    ("Upper West Side", "Arverne", 26.917),
]


def test_known_distances(spark):
    df = spark.createDataFrame(DISTANCES, "pickup_location string, drop_location string, expected double")
    for r in features.add_distance(df).collect():
        assert r["trip_distance_km"] == r["expected"]


def test_distance_of_unknown_and_equal_places(spark):
    df = spark.createDataFrame([("Atlantis", "Harlem"), ("Harlem", None), ("Harlem", "Harlem")],
                               "pickup_location string, drop_location string")
    assert [r["trip_distance_km"] for r in features.add_distance(df).collect()] == [1.0, 1.0, 0.0]


def test_distance_formula_against_plain_arithmetic(spark):
    pairs = [(a, b) for a in LOCATION_NAMES[:6] for b in LOCATION_NAMES[19:]]
    at = {n: (math.radians(la), math.radians(lo)) for n, la, lo in LOCATIONS}
    df = spark.createDataFrame(pairs, "pickup_location string, drop_location string")
    for r in features.add_distance(df).collect():
        (la1, lo1), (la2, lo2) = at[r["pickup_location"]], at[r["drop_location"]]
        h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
        assert r["trip_distance_km"] == pytest.approx(2 * 6371.0 * math.asin(math.sqrt(h)), abs=6e-4)


def test_distance_is_kept_if_present(spark):
    df = spark.createDataFrame([("Harlem", "Midtown", 99.0)], "pickup_location string, drop_location string, trip_distance_km double")
    assert features.ensure_distance(df).first()["trip_distance_km"] == 99.0


def test_temporal(spark):
    df = spark.createDataFrame([("14-03-2016", "17:24")], "pickup_date string, pickup_time string")
    r = features.add_temporal(df).first()
    assert (r["month"], r["day"], r["day_of_year"], r["pickup_hour"], r["pickup_minute"]) == (3, 14, 74, 17, 24)
    assert (r["weekday"], r["is_weekend"], r["season"]) == ("Monday", 0, "Spring")


def test_temporal_iso_and_unreadable(spark):
    rows = [("2016-03-19", "7:05"), ("soon", "25:00"), (None, None), ("30-02-2016", "12:60"), ("1-12-2019", "0:0")]
    got = [
        (r["month"], r["weekday"], r["is_weekend"], r["season"], r["pickup_hour"], r["pickup_minute"])
        for r in features.add_temporal(spark.createDataFrame(rows, "pickup_date string, pickup_time string")).collect()
    ]
    blank = (None, None, 0, None, None, None)
    assert got == [(3, "Saturday", 1, "Spring", 7, 5), blank, blank, blank, (12, "Sunday", 1, "Winter", 0, 0)]


def test_blank_rules(spark):
    schema = "pickup_date string, season string, weekday string"
    some = spark.createDataFrame([("14-03-2016", None, None), ("14-03-2016", "Fall", None)], schema)

    def seasons(rule):
        rows = features.add_temporal(some, rule).orderBy(F.col("season").desc_nulls_last()).collect()
        return [(r["season"], r["weekday"]) for r in rows]

    assert seasons("dataset") == [("Fall", "Monday"), (None, "Monday")]
    assert seasons("present") == [("Fall", None), (None, None)]
    assert seasons("row") == [("Spring", "Monday"), ("Fall", "Monday")]


def test_traffic_by_clock(spark):
    df = spark.createDataFrame([(17, 0), (16, 1), (20, 0), (7, 0), (10, 0), (11, 0), (15, 0), (6, 0), (11, 1), (18, 1), (19, 1)],
                               "h int, w int")
    got = [r[0] for r in df.select(temporal.traffic_by_clock(F.col("h"), F.col("w"))).collect()]
    assert got == ["High", "Medium", "Low", "High", "High", "Medium", "Medium", "Low", "Medium", "Medium", "Low"]


def test_traffic_ordinal(spark):
    df = spark.createDataFrame([("Low",), ("Medium",), ("High",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(features.traffic_ordinal(F.col("t"))).collect()] == [0, 1, 2, 1, 1]


def test_rare_places(spark):
    rows = [("Harlem", "Midtown")] * 25 + [("RareLoc1", "RareLoc2")] * 2 + [(None, "Midtown")]
    df = spark.createDataFrame(rows, "pickup_location string, drop_location string")
    rare = features.rare_values(df, below=20)
    assert {(r["column"], r["value"], r["n"]) for r in rare.collect()} == {
        ("pickup_location", "RareLoc1", 2), ("drop_location", "RareLoc2", 2)
    }
    out = features.group_rare(df, rare)
    counts = {(r[0], r[1]): r[2] for r in out.groupBy(*out.columns).count().collect()}
    assert counts == {("Harlem", "Midtown"): 25, ("Other", "Other"): 2, (None, "Midtown"): 1}


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_exact_split_meets_the_share(spark, share):
    df = spark.range(1, 1004).select("id")
    out = features.exact_split(df, test_share=share)
    assert out.where("is_test").count() == math.ceil(round(share * 1003, 9))
    ordered = df.select(F.md5(F.col("id").cast("string")).alias("h")).orderBy("h").collect()
    chosen = {r["h"] for r in ordered[: math.ceil(round(share * 1003, 9))]}
    got = {r["h"] for r in out.where("is_test").select(F.md5(F.col("id").cast("string")).alias("h")).collect()}
    assert got == chosen


def test_exact_split_of_few_rows_and_of_copies(spark):
    assert features.exact_split(spark.range(5)).where("is_test").count() == 1
    assert features.exact_split(spark.range(0)).count() == 0
    copies = spark.range(100).select((F.col("id") % 2).alias("v"))
    assert features.exact_split(copies).where("is_test").count() in (0, 50)


def test_split_does_not_depend_on_partitions(spark, partitions):
    trips = clean(fixtures.trips(spark, SF))
    found = set()
    for n in (1, 4, 17):
        partitions(n)
        test = features.split_flag(trips, trips.columns).where("is_test")
        found.add((test.count(), test.agg(F.sum(F.xxhash64(*trips.columns) % 1000)).first()[0]))
    assert len(found) == 1


def toy(spark):
    rows = [("Harlem", "Chelsea", "Monday", "Winter", True)] * 30
    rows += [("Midtown", "Chelsea", "Sunday", "Summer", True)] * 25
    rows += [("Inwood", "Chelsea", "Monday", "Winter", False)] * 25
    rows += [("St. Elsewhere", "Kensington", "Monday", "Fall", True)] * 3
    df = spark.createDataFrame(rows, "pickup_location string, drop_location string, weekday string, season string, is_train boolean")
    extra = {c: F.lit(1) for c in NUMERIC if c != "traffic_level"}
    return df.withColumns({**extra, "traffic_level": F.lit("High"), "actual_eta_minutes": F.lit(3.0)})


def test_feature_model(spark, tmp_path):
    df = toy(spark)
    model = features.FeatureModel.fit(df, F.col("is_train"))
    assert model.kept["pickup_location"] == ["Harlem", "Inwood", "Midtown"]
    # A frequent place without training rows is no category; it still is not "Other".
    assert model.categories["pickup_location"] == ["Harlem", "Midtown", "Other"]
    assert model.one_hot_columns == [
        "pickup_location_Midtown", "pickup_location_Other", "drop_location_Other", "weekday_Sunday",
        "season_Summer", "season_Winter",
    ]
    out = model.transform(df, keep=["actual_eta_minutes"])
    sums = out.agg(*[F.sum(f"`{c}`").alias(c) for c in model.one_hot_columns]).first().asDict()
    assert sums == {
        "pickup_location_Midtown": 25.0, "pickup_location_Other": 3.0, "drop_location_Other": 3.0,
        "weekday_Sunday": 25.0, "season_Summer": 25.0, "season_Winter": 55.0,
    }
    assert out.columns == ["actual_eta_minutes", *model.columns]
    assert out.select("traffic_level").distinct().first()[0] == 2.0
    model.save(spark, str(tmp_path / "m"))
    assert features.FeatureModel.load(spark, str(tmp_path / "m")) == model


def test_feature_model_fit_on_train_only(spark):
    model = features.FeatureModel.fit(toy(spark), F.col("is_train"), fit_on="train")
    assert model.kept["pickup_location"] == ["Harlem", "Midtown"]


def test_too_many_categories_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(features, "DENSE_COLUMNS", 3)
    with pytest.raises(ValueError, match="too many"):
        features.FeatureModel.fit(toy(spark), F.col("is_train"))


def test_serving_gives_zero_dummies_to_rare_and_unknown_places(spark):
    model = features.FeatureModel.fit(toy(spark), F.col("is_train"))
    rows = [("a", "St. Elsewhere", "Atlantis", "2016-03-14", "17:24", None, None), ("b", "Midtown", "Chelsea", "2016-03-13", "8:15", 0, 0.0)]
    made = features.request_features(spark.createDataFrame(rows, REQUEST))
    a, b = model.transform(made, keep=["request_id"], group_rare=False).orderBy("request_id").collect()
    assert sum(a[c] for c in model.one_hot_columns) == 0.0
    assert (a["trip_distance_km"], a["traffic_level"], a["passenger_count"], a["surge_multiplier"]) == (1.0, 2.0, 1.0, 1.0)
    assert b["pickup_location_Midtown"] == 1.0 and b["weekday_Sunday"] == 1.0
    assert (b["pickup_hour"], b["is_weekend"], b["traffic_level"], b["passenger_count"], b["surge_multiplier"]) == (8.0, 1.0, 0.0, 1.0, 1.0)


def test_alignment_fills_absent_features_with_zero(spark):
    model = features.FeatureModel.fit(toy(spark), F.col("is_train"))
    r = model.transform(toy(spark).drop("surge_multiplier").withColumn("extra", F.lit(1))).first()
    assert r["surge_multiplier"] == 0.0 and "extra" not in r.asDict()


def test_distances_are_looked_up_by_pair(spark):
    """The trigonometry runs on the pairs of the dimension and not on trips; numbers are those of two lookups."""
    names = [*LOCATION_NAMES, "Atlantis", None]
    trips = spark.createDataFrame([(a, b) for a in names for b in names], "pickup_location string, drop_location string")
    found = features.add_distance(trips, "km")
    assert found.columns == [*trips.columns, "km"]
    one_by_one = features.add_distance(trips, "km", location_dimension(spark))
    order = lambda df: sorted(df.collect(), key=str)
    assert order(found) == order(one_by_one) and found.count() == len(names) ** 2
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LeftOuter") == 1
