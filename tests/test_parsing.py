"""Text parsers against the standard library, over generated text."""

from __future__ import annotations

import random
from datetime import date, datetime

from pyspark.sql import functions as F

from waymeter.functions import columns, temporal


def python(text: str, form: str):
    # The patterns accept ASCII digits only and no sign.
    try:
        return datetime.strptime(text, form)
    except ValueError:
        return None


def texts(rng: random.Random) -> list[str]:
    out = ["", "-", ":", "2016-2-30", "29-02-2015", "29-02-2016", "2016-02-29", "24:00", "23:59", "0:0", "7:5", "07:05", "7:60"]
    for _ in range(1500):
        y, m, d = rng.randint(1, 9999), rng.randint(0, 14), rng.randint(0, 33)
        h, n = rng.randint(0, 26), rng.randint(0, 64)
        out += [
            f"{y:04d}-{m:02d}-{d:02d}", f"{y:04d}-{m}-{d}", f"{d:02d}-{m:02d}-{y:04d}", f"{d}-{m}-{y:04d}",
            f"{h:02d}:{n:02d}", f"{h}:{n}", "".join(rng.choice("0123456789-:") for _ in range(rng.randint(1, 10))),
        ]
    return out


def test_parsers_equal_strptime(spark):
    df = spark.createDataFrame([(t,) for t in texts(random.Random(11))], "t string").select(
        "t",
        temporal.iso_date(F.col("t")).alias("iso"),
        temporal.day_first_date(F.col("t")).alias("day_first"),
        temporal.clock_hour(F.col("t")).alias("hour"),
        temporal.clock_minute(F.col("t")).alias("minute"),
        temporal.weekday_name(temporal.iso_date(F.col("t"))).alias("weekday"),
        temporal.weekend_flag(temporal.iso_date(F.col("t"))).alias("weekend"),
    )
    for r in df.collect():
        iso, day_first, clock = python(r["t"], "%Y-%m-%d"), python(r["t"], "%d-%m-%Y"), python(r["t"], "%H:%M")
        assert r["iso"] == (iso.date() if iso else None), r["t"]
        assert r["day_first"] == (day_first.date() if day_first else None), r["t"]
        assert (r["hour"], r["minute"]) == ((clock.hour, clock.minute) if clock else (None, None)), r["t"]
        if iso and iso.date() > date(1600, 1, 1):
            assert r["weekday"] == iso.strftime("%A") and r["weekend"] == int(iso.weekday() >= 5)


def test_prefix_and_blanks(spark):
    df = spark.createDataFrame([("2. Spring",), ("12.Night",), ("Fall 2. x",), (" \tHarlem\n",), (None,)], "t string")
    got = [tuple(r) for r in df.select(columns.strip_prefix(F.col("t")), columns.strip_blanks(F.col("t"))).collect()]
    assert got == [("Spring", "2. Spring"), ("Night", "12.Night"), ("Fall 2. x", "Fall 2. x"), (" \tHarlem\n", "Harlem"), (None, None)]
