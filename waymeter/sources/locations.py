"""The location dimension: 25 named places. Its size is fixed, so it may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Name, latitude, longitude.
LOCATIONS = (
    ("Upper West Side", 40.78705, -73.97542),
    ("Harlem", 40.81160, -73.94650),
    ("East Harlem", 40.79793, -73.93999),
    ("Bedford-Stuyvesant", 40.68902, -73.93925),
    ("South Slope", 40.66300, -73.99000),
    ("Hell's Kitchen", 40.76281, -73.99317),
    ("West Village", 40.73368, -74.00931),
    ("Kensington", 40.64200, -73.97200),
    ("Fort Greene", 40.69011, -73.97477),
    ("Clinton Hill", 40.68972, -73.96528),
    ("Williamsburg", 40.70810, -73.95710),
    ("Murray Hill", 40.74763, -73.97677),
    ("Midtown", 40.75490, -73.98400),
    ("Park Slope", 40.67010, -73.98597),
    ("Crown Heights", 40.66747, -73.94357),
    ("Inwood", 40.86770, -73.92120),
    ("Chinatown", 40.71500, -73.99700),
    ("Tottenville", 40.51280, -74.25120),
    ("Sheepshead Bay", 40.59120, -73.94460),
    ("Midwood", 40.62500, -73.95700),
    ("Chelsea", 40.74650, -74.00140),
    ("Great Kills", 40.55000, -74.15000),
    ("Bensonhurst", 40.60140, -73.99430),
    ("Arverne", 40.59000, -73.79000),
    ("Arden Heights", 40.55500, -74.18500),
)
LOCATION_NAMES = tuple(name for name, _, _ in LOCATIONS)


def location_dimension(spark: SparkSession) -> DataFrame:
    """name, lat, lon, and the two coordinates in radians."""
    rows = ", ".join(
        "('{}', {}D, {}D)".format(name.replace("'", r"\'"), lat, lon)
        for name, lat, lon in LOCATIONS
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(name, lat, lon)").select(
        "name", "lat", "lon", F.radians("lat").alias("lat_rad"), F.radians("lon").alias("lon_rad")
    )
