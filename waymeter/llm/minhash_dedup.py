"""MinHash near-dedup with sequential Bayesian verification.

Equal shingle sets are one class from the start. Banded signatures give buckets; documents that share one are
candidates. Signatures of a candidate pair are compared batch by batch, and the pair is dropped as soon as its
posterior chance of reaching the similarity falls below MISS. Survivors are confirmed on full shingle sets.

Groups stay linear: in each bucket documents are first compared with one pivot, and only documents of different
components meet afterwards. A shingle that no other candidate has can't be in an intersection. The others of a
document are counted in CELLS hashed cells, and the smaller counts of each cell add up to at least the
intersection of two documents: this bound settles the loose pairs of a large group before they become rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeter.llm import bitmap
from waymeter.llm import words as W
from waymeter.llm.components import components
from waymeter.session import materialize

#: Link: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: A pair at the similarity shares no band with chance (1 - 0.8^4)^32, below 1e-7.
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
#: Cells of a document's profile of shared shingles.
CELLS = 128
#: Hashes compared at once, and the chance at which a pair is dropped.
BATCH, MISS = 16, 1e-6

_PICK = np.random.default_rng(11).integers(1, 1 << 63, (HASHES, 2), dtype=np.uint64) | np.uint64(1)


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, sorted; words are lower-cased (A-Z)."""
    value, row, _ = W.windows(W.spans(*W.buffers(texts)), size)
    return W.distinct(row, value)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, key_a, key_b: of the set, signature) of each row. Null and blank texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches):
            row, value = shingles(part.column("text"), size)
            n = np.bincount(row, minlength=part.num_rows)
            filled = np.flatnonzero(n)
            starts = (np.cumsum(n) - n)[filled]
            keys = np.zeros((2, part.num_rows), np.uint64)
            lowest = np.zeros((part.num_rows, HASHES), np.uint32)
            if len(starts):
                for k in (0, 1):
                    keys[k, filled] = np.add.reduceat(W.mix(value, 20 + k), starts)
                for k, (a, b) in enumerate(_PICK):
                    lowest[filled, k] = np.minimum.reduceat(((value * a + b) >> np.uint64(32)).astype(np.uint32), starts)
            sig = pa.ListArray.from_arrays(
                pa.array(np.arange(part.num_rows + 1) * HASHES, pa.int32()), pa.array(lowest.reshape(-1).view(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), *[pa.array(k.view(np.int64)) for k in keys], sig],
                names=["doc_id", "n_shingles", "key_a", "key_b", "signature"],
            )

    schema = "doc_id long, n_shingles long, key_a long, key_b long, signature array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(rep, items: sorted shingle hashes) of the documents in ``wanted`` (rep).

    A bitmap of the wanted ids leaves the others out before their texts are cut; the join is exact.
    """
    power = bitmap.power_for(wanted.count())
    words = bitmap.build(wanted, F.col("rep"), power)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches):
            part = part.filter(pa.array(bitmap.has(words, part.column("place").to_numpy())))
            row, value = shingles(part.column("text"), size)
            ends = np.append(0, np.cumsum(np.bincount(row, minlength=part.num_rows)))
            items = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("rep"), items], names=["rep", "items"])

    keyed = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("rep"), "text")
    found = keyed.withColumn("place", bitmap.placed(F.col("rep"), power)).mapInArrow(run, "rep long, items array<long>")
    return found.where(F.size("items") > 0).join(wanted, "rep", "left_semi")


def profiled(sets: DataFrame) -> DataFrame:
    """(rep, n, shared, profile) from (rep, items, alone: those that no other set has): counts of the shared items by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, profile = np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, CELLS), np.int32)
            for k, (items, alone) in enumerate(zip(batch.column("items"), batch.column("alone"), strict=True)):
                x = items.values.to_numpy()
                n[k] = len(x)
                if alone.is_valid:
                    x = x[~np.isin(x, alone.values.to_numpy())]
                profile[k] = np.bincount(x & (CELLS - 1), minlength=CELLS)
            cells = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * CELLS, pa.int32()), pa.array(profile.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(n), pa.array(profile.sum(1, dtype=np.int64)), cells], names=["rep", "n", "shared", "profile"])

    return sets.select("rep", "items", "alone").mapInArrow(run, "rep long, n long, shared long, profile array<int>")


def fewest_matches(seen: int) -> int:
    """Matches among ``seen`` hashes from which a pair goes on.

    With a uniform prior the similarity's posterior is Beta(m + 1, seen - m + 1); its mass at or above the
    required similarity is the chance that a binomial of seen + 1 trials is m at most.
    """
    t = PERCENT / 100
    total = 0.0
    for m in range(seen + 1):
        total += comb(seen + 1, m) * t**m * (1 - t) ** (seen + 1 - m)
        if total >= MISS:
            return m
    return seen


def plausible(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) that no batch of hashes rules out, with their matches so far."""
    sides = pairs
    for side in ("a", "b"):
        sides = sides.join(reps.select(F.col("rep").alias(side), F.col("signature").alias(f"sig_{side}")), side)
    least = [(seen, fewest_matches(seen)) for seen in range(BATCH, HASHES + 1, BATCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(f"sig_{s}").flatten().to_numpy().reshape(-1, HASHES) for s in "ab")
            at, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for seen, need in least:
                matches += (a[at, seen - BATCH : seen] == b[at, seen - BATCH : seen]).sum(1)
                on = matches >= need
                at, matches = at[on], matches[on]
            kept = batch.select(["a", "b"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(matches)], names=["a", "b", "matches"])

    return sides.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, matches long")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    sides = pairs.select("a", "b")
    for side in ("a", "b"):
        sides = sides.join(sets.select(F.col("rep").alias(side), F.col("items").alias(f"set_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("set_a"), batch.column("set_b")
            linked = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = a[k].values.to_numpy(), b[k].values.to_numpy()
                both = len(x) + len(y) - len(np.union1d(x, y))
                linked[k] = 100 * both >= PERCENT * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    return sides.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _possible(n: str, shared: str, other_n: str, other_shared: str) -> Column:
    """Whether the sizes and the shingles shared with any other document allow a link."""
    most = F.least(shared, other_shared)
    return 100 * most >= PERCENT * (F.col(n) + F.col(other_n) - most)


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def between(named: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are in different components, with those: ca and cb."""
    for side in ("a", "b"):
        own = named.select(F.col("rep").alias(side), F.col("component").alias("c"))
        pairs = pairs.join(own, side, "left").withColumn(f"c{side}", F.coalesce("c", side)).drop("c")
    return pairs.where("ca <> cb")


def joined(named: DataFrame, links: DataFrame) -> DataFrame:
    """Components (rep, component) after further links; components are joined as wholes, so many links between two are one."""
    wholes = between(named, links).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    moved = components(materialize(wholes, "links"))
    fresh = moved.select(F.col("node").alias("rep"), F.col("node").alias("component")).join(named, "rep", "left_anti")
    every = named.unionByName(fresh).join(moved.withColumnRenamed("component", "whole"), F.col("component") == F.col("node"), "left")
    return materialize(every.select("rep", F.coalesce("whole", "component").alias("component")), "components")


def link(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(per row doc_id, n_shingles and rep; component of each rep that has links)."""
    rows = materialize(signatures(docs, size), "signatures")
    filled = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = materialize(
        filled.groupBy("key_a", "key_b").agg(
            F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    member = rows.select("doc_id", "n_shingles", "key_a", "key_b").join(
        reps.select("rep", "key_a", "key_b"), ["key_a", "key_b"], "left"
    ).select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("rep")).alias("rep"))

    band = lambda k: F.xxhash64(F.lit(k), *[F.col("signature")[k * BAND_ROWS + j] for j in range(BAND_ROWS)])
    bands = reps.select("rep", "n", F.array(*[band(k) for k in range(BANDS)]).alias("bands"))
    in_bands, bands = bands.select("rep", "bands"), bands.select("rep", "n", F.explode("bands").alias("bucket"))
    common = bands.groupBy("bucket").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("bucket")
    shared = materialize(bands.join(common, "bucket", "left_semi"), "buckets")

    candidates = materialize(shared.select("rep").distinct(), "candidates")
    sets = materialize(sets_of(docs, candidates, size), "sets")
    alone = (
        sets.select("rep", F.explode("items").alias("item"))
        .groupBy("item").agg(F.count("*").alias("c"), F.min("rep").alias("rep")).where("c = 1")
        .groupBy("rep").agg(F.collect_list("item").alias("alone"))
    )
    profiles = profiled(sets.join(alone, "rep", "left"))
    profiles = materialize(profiles.where(100 * F.col("shared") >= PERCENT * F.col("n")), "open")
    open_reps = profiles.drop("profile").distinct()
    buckets = materialize(shared.select("bucket", "rep").join(open_reps, "rep"), "open-buckets")

    # Each document against the pivot of its buckets that looks most alike.
    pivots = buckets.groupBy("bucket").agg(
        F.min_by("rep", 1 - F.col("shared") / F.col("n")).alias("pivot"),
        F.min_by("n", 1 - F.col("shared") / F.col("n")).alias("pivot_n"),
        F.min_by("shared", 1 - F.col("shared") / F.col("n")).alias("pivot_shared"),
    )
    star = buckets.join(pivots, "bucket").where("rep <> pivot").where(_possible("n", "shared", "pivot_n", "pivot_shared"))
    likely = plausible(star.select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct(), reps)
    likely = materialize(likely, "likely")
    best = likely.groupBy("a").agg(F.max_by("b", "matches").alias("b"))
    named = components(confirmed(best.select(*_pair("a", "b")).distinct(), sets))
    named = named.select(F.col("node").alias("rep"), "component")
    # Against the other pivots, where that one was not enough.
    named = joined(named, confirmed(between(named, likely).select(*_pair("a", "b")).distinct(), sets))

    # Documents of one bucket that are still apart. The largest component of a bucket is compared with the rest only.
    apart = buckets.join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    counts = apart.groupBy("bucket", "component").agg(F.count("*").alias("c"))
    main = counts.groupBy("bucket").agg(F.max_by("component", "c").alias("main"), F.count("*").alias("parts")).where("parts > 1")
    apart = apart.join(main, "bucket").drop("parts").join(profiles.select("rep", "profile"), "rep").join(in_bands, "rep")
    apart = materialize(apart, "apart")
    minor = apart.where("component <> main").select("bucket", *[F.col(c).alias(f"x_{c}") for c in ("rep", "n", "shared", "component", "profile", "bands")])
    most = F.aggregate(F.zip_with("profile", "x_profile", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    meet = apart.join(minor, "bucket").where(
        (F.col("component") != F.col("x_component"))
        & ((F.col("component") == F.col("main")) | (F.col("rep") < F.col("x_rep")))
        & _possible("n", "shared", "x_n", "x_shared")
        & (F.col("bucket") == F.array_min(F.array_intersect("bands", "x_bands")))  # a pair meets once
        & (100 * most >= PERCENT * (F.col("n") + F.col("x_n") - most))
    )
    more = plausible(meet.select(*_pair("rep", "x_rep")).distinct(), reps)
    return member, joined(named, confirmed(more, sets))


def components_of(docs: DataFrame, size: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id: whole number, text).

    A set holds the distinct shingles of ``size`` words; a text with fewer words has its whole sequence as one.
    Null, empty and blank texts have no shingles, link with nothing and name their own component. component_id
    is the smallest doc_id reachable over links, kept marks it. Rows that repeat an id share its component.
    A row without an id links with nothing, has no component and is kept. An empty table gives no rows.
    """
    member, named = link(docs, size)
    component = F.when(F.col("rep").isNull(), F.col("doc_id")).otherwise(F.coalesce("component", "rep"))
    out = member.join(named, "rep", "left").select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def dedup(docs: DataFrame, size: int = 5) -> DataFrame:
    """The documents of ``docs`` without near copies: one of each component, with all columns.

    Rows that repeat a kept id count as copies: the one with the lowest text hash stays. Rows without an id stay.
    """
    gone = components_of(docs, size).where("NOT kept").select("doc_id").distinct()
    place = "_place"
    while place in docs.columns:
        place += "_"
    from pyspark.sql import Window

    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    kept = docs.join(gone, "doc_id", "left_anti").withColumn(place, F.row_number().over(order))
    return kept.where(F.col("doc_id").isNull() | (F.col(place) == 1)).select(*docs.columns)
