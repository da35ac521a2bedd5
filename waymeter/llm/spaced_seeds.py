"""Benchmark decontamination with spaced seeds.

A window of WINDOW tokens is four blocks, and each of six masks reads two of them and ignores the others. Up to
two substituted tokens spoil two blocks at most, so one mask still reads only equal tokens: every window with
at most CHANGES substitutions is found. Test and training hashes are joined, and the windows behind a common
hash are compared token by token. A benchmark item shorter than that is one window, see LEAST.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.llm import bitmap
from waymeter.llm import words as W
from waymeter.session import materialize

BLOCKS, BLOCK = 4, 3
WINDOW, CHANGES = BLOCKS * BLOCK, 2
#: A shorter benchmark item is one window. From LEAST tokens on it is found anywhere, with up to ``short_changes`` substitutions (one mask a
#: token, which leaves that token out). Under LEAST it has to stand unchanged between borders of lines, sentences or quotations.
LEAST = 8
#: CHANGES of WINDOW in proportion, for items of LEAST to WINDOW - 1 tokens.
SHORT_CHANGES = 1
MASKS = tuple(combinations(range(BLOCKS), 2))

_COLUMNS = "{id}pos long, window long, tokens array<long>, seeds array<long>"


def _runs(h: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        out += h[k : k + len(out)] * W.factor(k)
    return out


def seeds_of(s: W.Spans, size: int, short_changes: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(first token, seeds: one column a mask) of every window of ``size`` tokens within one text."""
    h = s.hash
    n = max(0, len(h) - size + 1)
    at = np.arange(n)
    at = at[s.row[:n] == s.row[size - 1 :][:n]] if n else at
    if size < WINDOW:
        whole = _runs(h, size)[at]
        if size < LEAST or not short_changes:
            return at, W.mix(whole, 1000 + size)[:, None]
        return at, np.stack([W.mix(whole - h[at + k] * W.factor(k), 2000 + size * WINDOW + k) for k in range(size)], 1)
    block = _runs(h, BLOCK)
    read = lambda k, m: W.mix(block[at + BLOCK * MASKS[m][k]], 30 + k)
    return at, np.stack([W.mix(read(0, m) + read(1, m) * np.uint64(3), 50 + m) for m in range(len(MASKS))], 1)


def _windows(docs: DataFrame, key: str, sizes: tuple[int, ...], words: np.ndarray | None, short_changes: int) -> DataFrame:
    """The windows of texts: (key, pos, window: hash of all tokens, tokens, seeds); with a bitmap only those that pass."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches):
            s, border = W.tokens(*W.buffers(part.column("text")))
            border = np.append(border, True)
            for size in sizes:
                at, seeds = seeds_of(s, size, short_changes)
                if words is None:
                    on = np.ones(seeds.shape, bool) if size == WINDOW else np.broadcast_to((s.count == size)[s.row[at], None], seeds.shape)
                else:
                    on = bitmap.has_both(words, seeds)
                    if size < LEAST:
                        on &= (border[at] & border[at + size])[:, None]
                rows = np.flatnonzero(on.any(1))
                if not len(rows):
                    continue
                at, seeds, on = at[rows], seeds[rows], on[rows]
                tokens = s.hash[at[:, None] + np.arange(size)]
                n = np.append(0, np.cumsum(on.sum(1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key).take(pa.array(s.row[at])),
                        pa.array(at - s.first[s.row[at]]),
                        pa.array(W.mix(_runs(s.hash, size)[at], size).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * size, pa.int32()), pa.array(tokens.reshape(-1).view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(n, pa.int32()), pa.array(seeds[on].view(np.int64))),
                    ],
                    names=[key, "pos", "window", "tokens", "seeds"],
                )

    schema = f"`{key}` {kind}, " + _COLUMNS.format(id="")
    return docs.select(key, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, short_changes: int = 0) -> DataFrame:
    """One row per document that holds a window of the benchmark with at most CHANGES substituted tokens, or a whole shorter item.

    ``short_changes`` (0 or 1): substitutions allowed in items of LEAST to WINDOW - 1 tokens. Shorter ones are found unchanged, between borders.

    Columns: doc_id, item_id (the lowest of the matched items), n_windows, first_token, last_token, changes (of the best window). Tokens
    are runs of letters and digits, and single characters in scripts without blanks; case (A-Z), punctuation, symbols and blanks don't matter. Benchmark windows pass to the
    tasks as a bitmap of 4 to 32 MB by their number; what passes it is joined on the hash. Windows of equal tokens are compared once, however many
    documents or items hold them. Null and short texts have no windows; rows that repeat an id are one
    document, rows without an id are reported together under a null; an empty table on either side gives no rows.
    """
    if short_changes not in (0, 1):
        raise ValueError("short_changes is 0 or 1")
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    test = materialize(_windows(items, "item_id", tuple(range(1, WINDOW + 1)), None, short_changes), "test-windows")
    sizes = tuple(sorted(r[0] for r in test.select(F.size("tokens")).distinct().collect()))  # at most WINDOW
    test_seeds = test.select("window", F.explode("seeds").alias("seed")).distinct()
    words = bitmap.build_both(test_seeds.select("seed"), bitmap.power_for(test_seeds.count(), bitmap.LEAST_OF_TWO))
    found = materialize(_windows(docs, "doc_id", sizes, words, short_changes), "training-windows")

    ours = found.select("window", "tokens", "seeds").dropDuplicates(["window"])
    theirs = test.groupBy("window").agg(F.min("item_id").alias("item_id"), F.first("tokens").alias("test_tokens"))
    hits = (
        ours.select("window", F.explode("seeds").alias("seed"))
        .join(test_seeds.withColumnRenamed("window", "test_window"), "seed").select("window", "test_window").distinct()
    )
    changes = F.aggregate(F.zip_with("tokens", "test_tokens", lambda a, b: (a != b).cast("int")), F.lit(0), lambda x, y: x + y)
    verified = (
        hits.join(ours.select("window", "tokens"), "window")
        .join(theirs.withColumnRenamed("window", "test_window"), "test_window")
        .where(F.size("tokens") == F.size("test_tokens"))
        .select("window", "item_id", changes.alias("changes"), F.size("tokens").alias("size"))
        .where(F.col("changes") <= F.when(F.col("size") == WINDOW, CHANGES).when(F.col("size") >= LEAST, short_changes).otherwise(0))
        .groupBy("window").agg(F.min("item_id").alias("item_id"), F.min("changes").alias("changes"), F.max("size").alias("size"))
    )
    return (
        found.select("doc_id", "pos", "window").join(verified, "window")
        .groupBy("doc_id").agg(
            F.min("item_id").alias("item_id"),
            F.count("*").alias("n_windows"),
            F.min("pos").alias("first_token"),
            F.max(F.col("pos") + F.col("size") - 1).alias("last_token"),
            F.min("changes").alias("changes"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, short_changes: int = 0) -> DataFrame:
    """The documents without benchmark passages, with all columns. Rows without an id can't be named and stay."""
    return docs.join(contaminated(docs, benchmark, short_changes).select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
