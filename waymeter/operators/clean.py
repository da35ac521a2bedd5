"""Cleaning of raw trips.

Differences from an eager row-by-row cleaner, kept on purpose:

* A null ``time_of_day`` or ``season`` stays null and the row is dropped (it never turns into the
  text ``"nan"``).
* The filters are written below the deduplication. They only look at a row's own values, so the
  result is the same, and the shuffle carries surviving rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.functions.columns import absent, quoted, strip_prefix
from waymeter.params import TripRules

PREFIXED = ("time_of_day", "season")
POSITIVE = ("passenger_count", "trip_distance_km")


def standardize(df: DataFrame) -> DataFrame:
    """Strip the numbered prefixes and drop the trip id, each only where the column exists."""
    named = {c: strip_prefix(F.col(c)) for c in PREFIXED if c in df.columns}
    return df.withColumns(named).drop("trip_id") if named else df.drop("trip_id")


def any_missing(df: DataFrame) -> Column:
    """True where some column of the row is null or NaN."""
    return reduce(lambda a, b: a | b, missing_flags(df))


def missing_flags(df: DataFrame) -> list[Column]:
    """Per column: the row's value is null or NaN."""
    floats = (T.DoubleType, T.FloatType)
    return [absent(quoted(f.name), isinstance(f.dataType, floats)) for f in df.schema]


def in_range(rules: TripRules = TripRules()) -> Column:
    return F.col(rules.target).between(rules.min_minutes, rules.max_minutes)


def drop_unusable(df: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Rows with no missing value, a target in range, and positive passengers and distance.

    One condition per column, so that a columnar scan can skip row groups by each of them.
    """
    for flag in missing_flags(df):
        df = df.where(~flag)
    if rules.target in df.columns:
        df = df.where(in_range(rules))
    for name in POSITIVE:
        if name in df.columns:
            df = df.where(F.col(name) > 0)
    return df


def rejected(df: DataFrame, rules: TripRules = TripRules()) -> Column:
    """The null-safe complement of :func:`drop_unusable`."""
    bad = any_missing(df)
    if rules.target in df.columns:
        bad = bad | ~in_range(rules)
    for name in POSITIVE:
        if name in df.columns:
            bad = bad | ~(F.col(name) > 0)
    return F.coalesce(bad, F.lit(True))


def clean(df: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Raw trips → clean trips. The one shuffle is the full-row deduplication; copies of a hot row
    collapse in the map-side aggregate before it."""
    return drop_unusable(standardize(df), rules).dropDuplicates()


def _fates(std: DataFrame, rules: TripRules) -> tuple[list[str], Column]:
    """Names of the rules in order, and the first one that a row breaks, or "kept"."""
    flags = [("missing", any_missing(std))]
    if rules.target in std.columns:
        flags.append(("target_out_of_range", ~in_range(rules)))
    flags += [(f"bad_{c}", ~(F.col(c) > 0)) for c in POSITIVE if c in std.columns]
    fate = reduce(lambda acc, rule: acc.when(rule[1], rule[0]), flags[1:], F.when(flags[0][1], flags[0][0]))
    return [name for name, _ in flags], fate.otherwise("kept")


def account(df: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """One row saying how many raw rows each step of :func:`clean` dropped.

    A row counts for the first rule it breaks: duplicate, missing value, target range, passengers,
    distance. Where the clean rows are written too, :class:`Accounted` counts them on the way.
    """
    std = standardize(df)
    rows = std.groupBy(*[quoted(c) for c in std.columns]).agg(F.count(F.lit(1)).alias("_n"))
    names, fate = _fates(std, rules)
    counted = rows.select("_n", fate.alias("_fate")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("initial_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        *[F.count_if(F.col("_fate") == name).alias(f"{name}_rows") for name in names],
        F.count_if(F.col("_fate") == "kept").alias("kept_rows"),
    )
    return counted.withColumn("dropped_rows", F.col("initial_rows") - F.col("kept_rows"))


class Accounted:
    """:func:`clean` with the counts of :func:`account` taken by the job that writes ``rows``: no second pass.

    Copies are removed before the other rules, as their count asks for, so rejected rows pass the shuffle too. Write
    ``rows`` once, then ask for ``counts``; both come from that one job, and a second use of ``rows`` counts nothing.
    """

    def __init__(self, df: DataFrame, rules: TripRules = TripRules()):
        std = standardize(df)
        self._before, self._after = Observation(), Observation()
        self._names, fate = _fates(std, rules)
        distinct = std.observe(self._before, F.count(F.lit(1)).alias("rows")).dropDuplicates()
        each = [F.count_if(fate == name).alias(name) for name in (*self._names, "kept")]
        self.rows = drop_unusable(distinct.observe(self._after, F.count(F.lit(1)).alias("rows"), *each), rules)
        self._spark = df.sparkSession

    def counts(self) -> DataFrame:
        """The row of :func:`account`; waits for the job that writes ``rows``."""
        before, after = (_observed(o, ("rows", *self._names, "kept")) for o in (self._before, self._after))
        row = {"initial_rows": before["rows"], "duplicate_rows": before["rows"] - after["rows"]}
        row |= {f"{name}_rows": after[name] for name in self._names}
        row |= {"kept_rows": after["kept"], "dropped_rows": before["rows"] - after["kept"]}
        return self._spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} long" for c in row))


def _observed(found: Observation, names: Sequence[str]) -> dict[str, int]:
    """Observed counts; a plan that the optimizer found to be without rows observes nothing."""
    try:
        return found.get
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


def write_clean(df: DataFrame, path: str, rules: TripRules = TripRules()) -> DataFrame:
    """Write the clean trips to ``path`` and return the accounting, in one job."""
    accounted = Accounted(df, rules)
    accounted.rows.write.parquet(path)
    return accounted.counts()


def duplicate_report(df: DataFrame) -> DataFrame:
    """Full-row duplicates and missing values per column as (check, subject, n) rows."""
    missing = missing_flags(df)
    rows = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    totals = rows.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_dup"),
        *[
            F.coalesce(F.sum(F.when(flag, F.col("_n"))), F.lit(0)).alias(f"_missing_{i}")
            for i, flag in enumerate(missing)
        ],
    )
    entries = [("duplicate_rows", "*", "_dup")]
    entries += [("missing", name, f"_missing_{i}") for i, name in enumerate(df.columns)]
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(check).alias("check"), F.lit(subject).alias("subject"), F.col(c).alias("n")
                    )
                    for check, subject, c in entries
                ]
            )
        )
    )
