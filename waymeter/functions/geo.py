"""Great-circle distance between named places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymeter.params import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in kilometres; the arguments are in radians."""
    half = F.lit(2.0)
    a = F.pow(F.sin((lat2 - lat1) / half), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / half), 2
    )
    return F.lit(EARTH_RADIUS_KM) * F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))
