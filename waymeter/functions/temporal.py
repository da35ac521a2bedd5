"""Dates, clock times and what is derived from them.

Parsing rewrites or extracts text by pattern and uses ``try_cast``, so a malformed value costs a null
and not an exception, and no formatter runs per row. Each parser refers to its argument once: when the
argument is itself an expression, the optimizer does not evaluate it again per reference.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymeter.params import WEEKDAYS

# Accepted text forms.
DAY_FIRST = r"^(\d{1,2})-(\d{1,2})-(\d{4})$"
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
CLOCK = r"^([01]?\d|2[0-3]):([0-5]?\d)$"


def trip_date(c: Column) -> Column:
    """Day-first text, else ISO text, else null."""
    return F.regexp_replace(F.trim(c), DAY_FIRST, "$3-$2-$1").try_cast("date")


def iso_date(c: Column) -> Column:
    """Year-month-day text (one-digit month and day allowed), else null."""
    return F.regexp_extract(c, ISO_DATE, 0).try_cast("date")


def day_first_date(c: Column) -> Column:
    """Day-month-year text, else null."""
    return F.when(c.rlike(DAY_FIRST), trip_date(c))


def clock_hour(c: Column) -> Column:
    """Hour of ``H:m`` text, null unless the whole text is a valid clock time."""
    return F.regexp_extract(c, CLOCK, 1).try_cast("int")


def clock_minute(c: Column) -> Column:
    """Minute of ``H:m`` text, null unless the whole text is a valid clock time."""
    return F.regexp_extract(c, CLOCK, 2).try_cast("int")


def weekday_name(d: Column) -> Column:
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return F.when(d.isNotNull(), F.get(names, F.weekday(d)))


def weekend_flag(d: Column) -> Column:
    """1 on Saturday and Sunday; 0 otherwise and for an unknown date."""
    return F.coalesce((F.weekday(d) >= 5).cast("int"), F.lit(0))


def season_of(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .when(month.between(9, 11), "Fall")
    )


def traffic_by_clock(hour: Column, is_weekend: Column) -> Column:
    """Traffic label expected at an hour of a working day or a weekend day."""
    weekend = F.when(hour.between(11, 18), "Medium").otherwise("Low")
    workday = (
        F.when(hour.between(7, 10) | hour.between(16, 19), "High")
        .when(hour.between(11, 15), "Medium")
        .otherwise("Low")
    )
    return F.when(is_weekend.cast("int") == 1, weekend).otherwise(workday)
