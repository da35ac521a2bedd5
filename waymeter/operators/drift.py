"""Two-sample drift between a reference and a current table.

All features are tested together. The two sides are reduced to (feature, value, count per side) in
one shuffle; everything else (sample sizes, means, the Kolmogorov-Smirnov distance) comes from that
table. It has one row per distinct value, so a value that a third of all rows share is one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.functions.columns import quoted
from waymeter.params import TARGET, DriftRules, KindRules
from waymeter.session import materialize

SIDE = "is_current"
# Distinct values of one feature that one task may sort. Above it the values are range-partitioned.
VALUES_PER_TASK = 4_000_000
SERIES_TERMS = 100


# --- sides -----------------------------------------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def shared_numeric(reference: DataFrame, current: DataFrame) -> list[str]:
    """Columns that are numeric on both sides, in the order of the reference."""
    other = set(numeric_columns(current))
    return [c for c in numeric_columns(reference) if c in other]


def tag_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Both tables under one another with the side in ``is_current``.

    Where both sides come from one table, tag that table instead: it is then scanned once.
    """
    names = list(columns or shared_numeric(reference, current))
    chosen = [quoted(c) for c in names]
    return reference.select(*chosen, F.lit(False).alias(SIDE)).unionByName(
        current.select(*chosen, F.lit(True).alias(SIDE))
    )


# --- Kolmogorov-Smirnov ----------------------------------------------------------------------


def value_counts(tagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n_ref, n_cur): how often each side has each value. Missing values are out."""
    values = F.array(*[quoted(c).cast("double") for c in columns])
    current = F.col(SIDE).cast("bigint")
    return (
        tagged.select(current.alias("_cur"), F.posexplode(values).alias("feature", "value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(F.sum(1 - F.col("_cur")).alias("n_ref"), F.sum("_cur").alias("n_cur"))
    )


def _totals(counts: DataFrame) -> DataFrame:
    """One row per feature: sample sizes, means and the number of distinct values."""
    return counts.groupBy("feature").agg(
        F.sum("n_ref").alias("ref_n"),
        F.sum("n_cur").alias("cur_n"),
        (F.sum(F.col("value") * F.col("n_ref")) / F.sum("n_ref")).alias("ref_avg"),
        (F.sum(F.col("value") * F.col("n_cur")) / F.sum("n_cur")).alias("cur_avg"),
        F.count(F.lit(1)).alias("distinct_values"),
    )


def _sliced(counts: DataFrame, slices: int) -> DataFrame:
    """Add ``slice``: contiguous value ranges of about equal row count.

    The table is range-partitioned on (feature, value) and written, which freezes the slices; no
    later stage can see other range bounds.
    """
    ranged = counts.repartitionByRange(slices, "feature", "value")
    return materialize(ranged.withColumn("slice", F.spark_partition_id()), "value-slices")


def ks_table(
    tagged: DataFrame,
    columns: Sequence[str],
    values_per_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """Per feature: sample sizes, means, KS distance and Wasserstein distance.

    The cumulative counts need the values in order. A running sum within a feature does that as long
    as a feature's distinct values fit one task. Beyond that the values are cut into slices: a slice
    starts at the total of the slices before it, which is a window over one row per slice, and only
    runs a sum over its own rows. Both forms give the same numbers.
    """
    return ks_from_counts(value_counts(tagged, columns), columns, values_per_task)


def merge_counts(*counts: DataFrame) -> DataFrame:
    """Add up value counts, for instance a stored baseline's and a new batch's."""
    both = reduce(DataFrame.unionByName, counts)
    return both.groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def ks_from_counts(
    counts: DataFrame, columns: Sequence[str], values_per_task: int = VALUES_PER_TASK
) -> DataFrame:
    """:func:`ks_table` from value counts."""
    counts = materialize(counts, "value-counts")
    totals = materialize(_totals(counts), "feature-totals")
    size = totals.agg(
        F.max("distinct_values").alias("largest"), F.sum("distinct_values").alias("rows")
    ).first()
    if (size["largest"] or 0) <= values_per_task:
        start = counts.withColumns({"slice": F.lit(0), "ref_before": F.lit(0), "cur_before": F.lit(0)})
        start = start.withColumn("next_first", F.lit(None).cast("double"))
    else:
        slices = -(-size["rows"] // values_per_task)
        start = _with_offsets(_sliced(counts, int(slices)))

    # Both joins below are on tables of one row per feature, or per feature and slice.
    run = Window.partitionBy("feature", "slice").orderBy("value")
    upto = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref_share = (F.col("ref_before") + F.sum("n_ref").over(upto)) / F.col("ref_n")
    cur_share = (F.col("cur_before") + F.sum("n_cur").over(upto)) / F.col("cur_n")
    following = F.coalesce(F.lead("value").over(run), F.col("next_first"))
    gaps = (
        start.join(F.broadcast(totals), "feature")
        .select(
            "feature",
            F.abs(ref_share - cur_share).alias("gap"),
            (following - F.col("value")).alias("step"),
        )
        .groupBy("feature")
        .agg(
            F.max("gap").alias("ks"),
            F.coalesce(F.sum(F.col("gap") * F.col("step")), F.lit(0.0)).alias("wasserstein"),
        )
    )
    names = F.array(*[F.lit(c) for c in columns])
    return (
        totals.join(gaps, "feature")
        .withColumn("position", F.col("feature"))
        .withColumn("feature", F.get(names, F.col("position")))
        .select("position", "feature", "ref_n", "cur_n", "ref_avg", "cur_avg", "ks", "wasserstein")
    )


def _with_offsets(sliced: DataFrame) -> DataFrame:
    """Add what the earlier slices of a feature hold, and where its next slice begins."""
    per_slice = sliced.groupBy("feature", "slice").agg(
        F.sum("n_ref").alias("r"), F.sum("n_cur").alias("c"), F.min("value").alias("first_value")
    )
    order = Window.partitionBy("feature").orderBy("slice")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        "feature",
        "slice",
        F.coalesce(F.sum("r").over(before), F.lit(0)).alias("ref_before"),
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("cur_before"),
        F.lead("first_value").over(order).alias("next_first"),
    )
    # rows: slices + features at most, both known before; AQE picks the join from the real size.
    return sliced.join(offsets, ["feature", "slice"])


# --- p-values --------------------------------------------------------------------------------


def series_p_value(ks: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sided p-value: the alternating series of the Kolmogorov distribution."""
    n, m = n_ref.cast("double"), n_cur.cast("double")
    lam = F.sqrt(n * m / (n + m)) * ks
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k.cast("double") * k.cast("double") * lam * lam),
    )
    p = F.least(F.greatest(F.lit(2.0) * terms, F.lit(0.0)), F.lit(1.0))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(p)


def exact_tail(ks: float, n: int, m: int) -> float:
    """P(D >= ks) under equal distributions, for samples of n and m.

    A random merge of both samples is a lattice path; the path must stay strictly within the band
    |i/n - j/m| < ks. Walking backwards from a point, the last step came from the first sample with
    probability i/(i+j). So inside(i, j) = i/(i+j) inside(i-1, j) + j/(i+j) inside(i, j-1), which is
    filled diagonal by diagonal with all values in [0, 1].
    """
    limit = round(ks * n * m)
    inside = np.zeros(n + 1)
    inside[0] = 1.0 if limit > 0 else 0.0
    index = np.arange(n + 1)
    for total in range(1, n + m + 1):
        came_first = np.zeros(n + 1)
        came_first[1:] = inside[:-1] * index[1:]
        inside = (came_first + inside * (total - index)) / total
        j = total - index
        outside = (j < 0) | (j > m) | (np.abs(index * m - j * n) >= limit)
        inside[outside] = 0.0
    return float(min(1.0, max(0.0, 1.0 - inside[n])))


def banded_tail(ks: float, n: int, m: int) -> float:
    """:func:`exact_tail` with only the points inside the band kept: (n + m) steps of about 2 ks n m / (n + m) points."""
    limit = round(ks * n * m)
    if limit <= 0:
        return 1.0
    start, inside = 0, np.ones(1)  # the paths' share at i = start, start + 1, ... of a diagonal
    for total in range(1, n + m + 1):
        # |i m - (total - i) n| < limit, within the rectangle.
        low = max(0, total - m, (total * n - limit) // (n + m) + 1)
        high = min(n, total, -((-total * n - limit) // (n + m)) - 1)
        if low > high:
            return 1.0
        i = np.arange(low, high + 1)
        padded = np.concatenate([np.zeros(1), inside, np.zeros(1)])
        at = np.clip(i - start + 1, 0, len(padded) - 1)
        before = np.clip(i - start, 0, len(padded) - 1)
        inside = (padded[before] * i + padded[at] * (total - i)) / total
        start = low
    return float(min(1.0, max(0.0, 1.0 - inside[n - start])))


def finite_tail(ks: float, n: int, m: int) -> float:
    """P(D >= ks) of one sample of round(n m / (n + m)) values, by a matrix power of the size of the band.

    With t = size * ks = k - h, an entry (i, j) on or below the upper diagonal is 1 / (i - j + 1)!, less the powers of h in the first column
    and the last row; size! / size^size times the middle entry of the power is the chance to stay below ks.
    """
    from math import ceil, exp, factorial, lgamma, log, sqrt

    size = max(1, round(n * m / (n + m)))
    if ks <= 0:
        return 1.0
    if ks >= 1:
        return 0.0
    scaled = size * ks * ks
    if scaled > 18:  # below 1e-15
        return 2 * exp(-(2.000071 + 0.331 / sqrt(size) + 1.409 / size) * scaled)
    k = ceil(size * ks)
    h = k - size * ks
    order = 2 * k - 1
    steps = np.arange(1, order + 1)
    inverse = np.exp(-np.array([lgamma(q + 1) for q in range(order + 1)]))
    gap = np.subtract.outer(np.arange(order), np.arange(order)) + 1
    base = np.where(gap >= 0, inverse[np.clip(gap, 0, order)], 0.0)
    powers = h**steps * inverse[1:]
    base[:, 0] -= powers
    base[-1, :] -= powers[::-1]
    base[-1, 0] += max(0.0, 2 * h - 1) ** order / (factorial(order) if order < 170 else float("inf"))
    # Powers are kept near 1; ``shift`` is the logarithm that they lack.
    result, shift, square, square_shift, left = np.eye(order), 0.0, base, 0.0, size
    while left:
        if left & 1:
            result, shift = result @ square, shift + square_shift
            top = result[k - 1, k - 1]
            if top > 0:
                result, shift = result / top, shift + log(top)
        left >>= 1
        if left:
            square, square_shift = square @ square, 2 * square_shift
            top = square[k - 1, k - 1]
            if top > 0:
                square, square_shift = square / top, square_shift + log(top)
    inside = result[k - 1, k - 1] * exp(shift + lgamma(size + 1) - size * log(size))
    return float(min(1.0, max(0.0, 1.0 - inside)))


#: p-values that a task computes for a row: the law of two finite samples, and that of one of the matching size.
TAILS = {"exact": banded_tail, "finite": finite_tail}


def _tail(method: str) -> Callable[[Column, Column, Column], Column]:
    law = TAILS[method]

    @F.pandas_udf(T.DoubleType())
    def p_value(ks: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([law(k, int(a), int(b)) for k, a, b in zip(ks, n, m)])

    return p_value


def with_p_value(table: DataFrame, method: str = "series", rules: DriftRules = DriftRules()) -> DataFrame:
    """Add ``p``: by the series, whatever the sample sizes, or on request ``"exact"`` or ``"finite"``.

    These two take time with the rows times the width of a band, or with the band's cube; features are spread over
    tasks for it.
    """
    if method == "series":
        return table.withColumn("p", series_p_value(F.col("ks"), F.col("ref_n"), F.col("cur_n")))
    if method not in TAILS:
        raise ValueError(f"no such p-value: {method}")
    spread = materialize(table, "drift-features")
    spread = spread.repartition(max(1, spread.count()), "feature")  # one row per feature
    return spread.withColumn("p", _tail(method)("ks", "ref_n", "cur_n"))


# --- feature records and roll-up -------------------------------------------------------------


def feature_drift(
    tagged: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "series",
    rules: DriftRules = DriftRules(),
    values_per_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """One row per tested feature. The flag compares the unrounded p-value, the table shows it rounded.

    A feature with fewer than five values on either side is not tested and does not count.
    """
    names = list(columns or [c for c in numeric_columns(tagged) if c != SIDE])
    return feature_records(ks_table(tagged, names, values_per_task), method, rules)


def feature_records(
    table: DataFrame, method: str = "series", rules: DriftRules = DriftRules()
) -> DataFrame:
    """:func:`ks_table` rows → records with flag, p-value and rounded numbers."""
    enough = table.where((F.col("ref_n") >= rules.min_samples) & (F.col("cur_n") >= rules.min_samples))
    scored = with_p_value(enough, method, rules)
    return scored.select(
        "position",
        "feature",
        (F.col("p") < rules.p_value).alias("drift_detected"),
        F.round("p", 5).alias("p_value"),
        F.round("ks", 5).alias("ks_statistic"),
        F.round("ref_avg", 3).alias("ref_mean"),
        F.round("cur_avg", 3).alias("curr_mean"),
        F.round("wasserstein", 5).alias("wasserstein"),
        F.col("ref_n").alias("ref_rows"),
        F.col("cur_n").alias("curr_rows"),
    )


def drift_summary(features: DataFrame, rules: DriftRules = DriftRules()) -> DataFrame:
    """One row: features tested and drifted, the drifted names in column order, share and flag."""
    drifted = F.col("drift_detected")
    rolled = features.agg(
        F.count(F.lit(1)).alias("tested"),
        F.count_if(drifted).alias("drifted"),
        # One entry per drifted column of the table's schema.
        F.array_sort(F.collect_list(F.when(drifted, F.struct("position", "feature")))).alias("names"),
    )
    share = F.coalesce(F.try_divide(F.col("drifted"), F.col("tested")), F.lit(0.0))
    return rolled.select(
        (share >= rules.drift_share).alias("dataset_drift_detected"),
        F.round(share, 4).alias("drift_share"),
        F.col("drifted").alias("drifted_features_count"),
        F.col("names.feature").alias("drifted_features"),
        F.col("tested").alias("total_features_tested"),
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    reference_name: str,
    current_name: str,
    columns: Sequence[str] | None = None,
    method: str = "series",
    rules: DriftRules = DriftRules(),
) -> DataFrame:
    """One-row report: time, data set names, row counts, summary and the feature records."""
    tagged = tag_sides(reference, current, columns)
    names = [c for c in tagged.columns if c != SIDE]
    features = materialize(feature_drift(tagged, names, method, rules), "drift-report")
    rows = tagged.agg(
        F.count_if(~F.col(SIDE)).alias("reference_rows"), F.count_if(F.col(SIDE)).alias("current_rows")
    )
    summary = drift_summary(features, rules)
    record = F.struct("drift_detected", "p_value", "ks_statistic", "ref_mean", "curr_mean")
    records = features.agg(F.map_from_entries(F.collect_list(F.struct("feature", record))).alias("m"))
    return rows.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("timestamp"),
        F.lit(reference_name).alias("reference_dataset"),
        F.lit(current_name).alias("current_dataset"),
        "reference_rows",
        "current_rows",
        summary.select(F.struct(*summary.columns)).scalar().alias("drift_summary"),
        records.scalar().alias("feature_metrics"),
    )


# --- categorical columns ---------------------------------------------------------------------


def category_counts(tagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category, n_ref, n_cur) for text columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), quoted(c).cast("string").alias("category")) for c in columns])
    current = F.col(SIDE).cast("bigint")
    return (
        tagged.select(current.alias("_cur"), F.inline(pairs))
        .where(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.sum(1 - F.col("_cur")).alias("n_ref"), F.sum("_cur").alias("n_cur"))
    )


def chi_square(tagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson's test of (category x side) per text column: statistic, degrees of freedom, p-value.

    With R and C rows per side, a category seen r + c times adds
    (r - E)^2 (1/E + 1/E') where E = (r + c) R / (R + C) and E' = (r + c) C / (R + C).
    """
    counts = materialize(category_counts(tagged, columns), "category-counts")
    totals = counts.groupBy("feature").agg(
        F.sum("n_ref").alias("ref_n"), F.sum("n_cur").alias("cur_n"), F.count(F.lit(1)).alias("categories")
    )
    both = (F.col("n_ref") + F.col("n_cur")).cast("double")
    all_rows = F.col("ref_n") + F.col("cur_n")
    expected_ref = both * F.col("ref_n") / all_rows
    expected_cur = both * F.col("cur_n") / all_rows
    gap = F.col("n_ref") - expected_ref
    stat = (
        counts.join(F.broadcast(totals), "feature")
        .where((F.col("ref_n") > 0) & (F.col("cur_n") > 0))
        .groupBy("feature")
        .agg(
            F.sum(gap * gap * (1 / expected_ref + 1 / expected_cur)).alias("statistic"),
            (F.first("categories") - 1).alias("degrees"),
        )
    )
    return stat.withColumn("p_value", _chi_square_tail("statistic", "degrees"))


# --- a test for each kind of column ----------------------------------------------------------


def _divergence(r: Column, c: Column, rn: Column, cn: Column) -> Column:
    """Jensen–Shannon distance (base 2, 0 to 1) of two tables of counts, as an aggregate."""
    p, q = r / rn, c / cn
    part = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)
    return F.sqrt(F.greatest(F.sum(part(p) + part(q)) / 2, F.lit(0.0)))


def drift_by_kind(tagged: DataFrame, columns: Sequence[str] | None = None, rules: KindRules = KindRules()) -> DataFrame:
    """(feature, kind, test, value, drift_detected, jensen_shannon, wasserstein, z) of each column.

    A column of two values is ``two-valued``; text, and numbers of few values, are ``categories``; others are ``numbers``. With few
    reference rows the test is a two-proportion z-test, Pearson's or the Kolmogorov–Smirnov test, and ``value`` its p-value;
    with more it is the Jensen–Shannon distance, for numbers the Wasserstein distance over the reference's deviation. All
    come from one table of value counts; numbers are put into shared bins of equal width for their Jensen–Shannon
    distance. Missing values are out; a column without values on one side is left out.
    """
    names = [c for c in (columns or tagged.columns) if c != SIDE]
    numbers = [c for c in names if c in set(numeric_columns(tagged))]
    texts = [c for c in names if c not in numbers]
    counts = tagged.sparkSession.createDataFrame([], "feature string, value double, category string, n_ref long, n_cur long")
    if numbers:
        named = F.get(F.array(*[F.lit(c) for c in numbers]), F.col("feature"))
        counts = counts.unionByName(value_counts(tagged, numbers).withColumns({"feature": named, "category": F.lit(None).cast("string")}))
    if texts:
        counts = counts.unionByName(category_counts(tagged, texts).withColumn("value", F.lit(None).cast("double")))
    counts = materialize(counts, "kind-counts")
    n = F.sum("n_ref")
    mean = F.sum(F.col("value") * F.col("n_ref")) / n
    spread = F.sqrt(F.greatest(F.sum(F.col("value") * F.col("value") * F.col("n_ref")) / n - mean * mean, F.lit(0.0)))
    last = F.struct("value", "category")
    totals = counts.groupBy("feature").agg(
        n.alias("rn"), F.sum("n_cur").alias("cn"), F.count("*").alias("distinct"), F.max(F.col("category").isNotNull()).alias("text"),
        F.min("value").alias("low"), F.max("value").alias("high"), spread.alias("spread"), F.max_by(F.struct("n_ref", "n_cur"), last).alias("top"),
    ).where("rn > 0 AND cn > 0")
    kind = F.when(F.col("distinct") == 2, "two-valued").when(F.col("text") | (F.col("distinct") <= rules.few_values), "categories").otherwise("numbers")
    totals = materialize(totals.withColumn("kind", kind), "kind-totals")
    # From here on joins are with a row per column.
    one = counts.join(F.broadcast(totals), "feature")
    width = (F.col("high") - F.col("low")) / rules.bins
    cell = F.when(F.col("kind") == "numbers", F.least(F.floor((F.col("value") - F.col("low")) / width), F.lit(rules.bins - 1)).cast("string")).otherwise(F.coalesce("category", F.col("value").cast("string")))
    cells = one.groupBy("feature", "rn", "cn", cell.alias("cell")).agg(F.sum("n_ref").alias("r"), F.sum("n_cur").alias("c"))
    js = cells.groupBy("feature").agg(_divergence(F.col("r"), F.col("c"), F.col("rn"), F.col("cn")).alias("jensen_shannon"))
    both = (F.col("n_ref") + F.col("n_cur")) / (F.col("rn") + F.col("cn"))
    expected = lambda side: both * F.col(side)
    gap = F.col("n_ref") - expected("rn")
    pearson = one.groupBy("feature").agg(F.sum(gap * gap * (1 / expected("rn") + 1 / expected("cn"))).alias("statistic"))
    ks = ks_from_counts(counts.where("category IS NULL").withColumn("feature", F.array_position(F.array(*[F.lit(c) for c in numbers]), F.col("feature")).cast("int") - 1).select("feature", "value", "n_ref", "n_cur"), numbers) if numbers else None
    found = totals.join(js, "feature").join(pearson, "feature")
    found = found.join(ks.select("feature", "ks", "wasserstein", "ref_n", "cur_n"), "feature", "left") if numbers else found.withColumns({c: F.lit(None).cast("double") for c in ("ks", "wasserstein", "ref_n", "cur_n")})
    p, q = F.col("top.n_ref") / F.col("rn"), F.col("top.n_cur") / F.col("cn")
    pooled = (F.col("top.n_ref") + F.col("top.n_cur")) / (F.col("rn") + F.col("cn"))
    found = found.withColumns({
        "z": F.when(F.col("kind") == "two-valued", (q - p) / F.sqrt(pooled * (1 - pooled) * (1 / F.col("rn") + 1 / F.col("cn")))),
        "wasserstein": F.when((F.col("kind") == "numbers") & (F.col("spread") > 0), F.col("wasserstein") / F.col("spread")),
        "small": F.col("rn") <= rules.small,
    })
    by_kind = lambda numbers, categories, two: F.when(F.col("kind") == "numbers", numbers).when(F.col("kind") == "categories", categories).otherwise(two)
    test = F.when(F.col("small"), by_kind(F.lit("kolmogorov_smirnov"), F.lit("chi_square"), F.lit("z"))).otherwise(by_kind(F.lit("wasserstein"), F.lit("jensen_shannon"), F.lit("jensen_shannon")))
    tail = _chi_square_tail(by_kind(F.lit(0.0), F.col("statistic"), F.col("z") * F.col("z")), F.when(F.col("kind") == "categories", F.col("distinct") - 1).otherwise(1))
    tested = by_kind(series_p_value(F.col("ks"), F.col("ref_n"), F.col("cur_n")), tail, tail)
    far = by_kind(F.coalesce("wasserstein", F.lit(0.0)), F.col("jensen_shannon"), F.col("jensen_shannon"))
    found = found.withColumns({"test": test, "value": F.when(F.col("small"), tested).otherwise(far)})
    drifted = F.when(F.col("small"), F.col("value") < rules.p_value).otherwise(F.col("value") >= rules.distance)
    return found.select("feature", "kind", "test", "value", drifted.alias("drift_detected"), "jensen_shannon", "wasserstein", "z")


@F.pandas_udf(T.DoubleType())
def _chi_square_tail(statistic: pd.Series, degrees: pd.Series) -> pd.Series:
    return pd.Series([chi_square_tail(s, int(d)) for s, d in zip(statistic, degrees)])


def chi_square_tail(statistic: float, degrees: int) -> float:
    """P(X >= statistic) for a chi-square variable with a whole number of degrees of freedom.

    Adding two degrees adds one term of the density's series, so the tail is a finite sum that starts
    at exp(-s/2) (even) or erfc(sqrt(s/2)) (odd).
    """
    from math import erfc, exp, lgamma, log, sqrt

    if degrees <= 0 or statistic <= 0:
        return 1.0
    half = statistic / 2
    k = degrees % 2
    tail = erfc(sqrt(half)) if k else 0.0
    shape = 0.5 if k else 0.0
    while shape < degrees / 2 - 1e-9:
        tail += exp(shape * log(half) - half - lgamma(shape + 1))
        shape += 1
    return min(1.0, tail)


# --- what-if ---------------------------------------------------------------------------------


def what_if(
    df: DataFrame,
    multiplier: float = 1.45,
    rush_hour: bool = True,
    weather: bool = True,
    only: Column | None = None,
    target: str = TARGET,
) -> DataFrame:
    """Slower traffic, applied to a numeric feature table.

    Rush hour: from 16 to 20 o'clock or on a weekend the target is multiplied. Weather: the traffic
    ordinal rises by one up to 2, and every target grows by 15 percent. Each change needs its columns;
    ``only`` limits it to some rows.
    """
    here = F.lit(True) if only is None else only
    if rush_hour and "pickup_hour" in df.columns and target in df.columns:
        rush = F.col("pickup_hour").between(16, 20)
        if "is_weekend" in df.columns:
            rush = rush | (F.col("is_weekend") == 1)
        hit = here & F.coalesce(rush, F.lit(False))
        df = df.withColumn(target, F.when(hit, F.col(target) * multiplier).otherwise(F.col(target)))
    if weather and "trip_distance_km" in df.columns:
        changed = {}
        if "traffic_level" in df.columns:
            worse = F.least(F.greatest(F.col("traffic_level") + 1, F.lit(0)), F.lit(2))
            changed["traffic_level"] = F.when(here, worse).otherwise(F.col("traffic_level"))
        if target in df.columns:
            changed[target] = F.when(here, F.col(target) * 1.15).otherwise(F.col(target))
        df = df.withColumns(changed) if changed else df
    return df


def what_if_summary(
    base: DataFrame,
    columns: Sequence[str] | None = None,
    multiplier: float = 1.50,
    method: str = "series",
    rules: DriftRules = DriftRules(),
    target: str = TARGET,
) -> DataFrame:
    """Mean target before and after the what-if, and the drift between both tables."""
    names = list(columns or numeric_columns(base))
    base = base.select(*[quoted(c) for c in names])
    # Both sides come from one scan: each row is taken as it is and once more, changed.
    sides = base.withColumn(SIDE, F.explode(F.array(F.lit(False), F.lit(True))))
    tagged = what_if(sides, multiplier, only=F.col(SIDE), target=target)
    table = materialize(ks_table(tagged, names), "what-if")
    summary = drift_summary(feature_records(table, method, rules), rules)
    is_target = F.col("feature") == target
    means = table.agg(
        F.round(F.max(F.when(is_target, F.col("ref_avg"))), 2).alias("original_mean_eta"),
        F.round(F.max(F.when(is_target, F.col("cur_avg"))), 2).alias("drifted_mean_eta"),
    )
    wanted = ("dataset_drift_detected", "drift_share", "drifted_features")
    found = means.withColumn("_drift", summary.select(F.struct(*wanted)).scalar())
    return found.select("original_mean_eta", "drifted_mean_eta", "_drift.*")
