"""Counts over whole texts, and what the rule and tree models read of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.llm import words as W

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_marks", "n_digits", "n_letters",
)
#: Ratios of the counts; a text without words has 0 in each.
FEATURES = (
    "symbol_share", "upper_share", "mark_share", "digit_share", "letter_share", "repeat_share", "dup_line_share",
    "distinct_share", "mean_word", "words_per_line", "log_words",
)

#: Fixed values of the contract of op10: symbols and the window of repeated words.
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5
_is = lambda chars: np.isin(np.arange(256), list(chars))
_SYMBOL, _MARK = _is(SYMBOLS), _is(b"!?.,;:")
_UPPER, _DIGIT = _is(range(65, 91)), _is(range(48, 58))
_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_HEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point

COUNTS_TYPE = T.StructType([T.StructField(n, T.LongType()) for n in COUNTS])


def count(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of each text: whole numbers, 0 for an empty text.

    Words are runs of anything but space and \\t-\\r, compared as they are. A line counts if it has a word; a
    repeated line equals an earlier one of its text. Repeated words lie in a five-word window that the text
    has twice or more, its first occurrence included.
    """
    rows = len(offsets) - 1
    s = W.spans(offsets, data, lower=False)

    def within(table: np.ndarray) -> np.ndarray:
        return W.marked(offsets, data, table)

    line = W.lines(offsets, data)
    has_word = np.searchsorted(s.start, line.end) > np.searchsorted(s.start, line.start)
    lines = np.bincount(line.row[has_word], minlength=rows)
    unlike = np.bincount(W.distinct(line.row[has_word], line.hash[has_word])[0], minlength=rows)

    value, row, at = W.windows(s, REPEAT_WINDOW, short=False)
    order = np.lexsort((value, row))
    twice = np.zeros(len(order), bool)
    if len(order) > 1:
        same = (value[order][1:] == value[order][:-1]) & (row[order][1:] == row[order][:-1])
        twice[1:] |= same
        twice[:-1] |= same
    hits = at[order[twice]]
    cover = np.zeros(len(s.hash) + 1, np.int64)
    np.add.at(cover, hits, 1)
    np.add.at(cover, hits + REPEAT_WINDOW, -1)
    repeated = np.cumsum(cover)[:-1] > 0

    return {
        "n_words": s.count,
        "word_chars": within(W.WORD_BYTES & _HEAD),
        "n_symbols": within(_SYMBOL),
        "n_dup_lines": lines - unlike,
        "n_repeat_words": np.bincount(s.row[repeated], minlength=rows),
        "n_lines": lines,
        "n_distinct": np.bincount(W.distinct(s.row, s.hash)[0], minlength=rows),
        "n_upper": within(_UPPER),
        "n_marks": within(_MARK),
        "n_digits": within(_DIGIT),
        "n_letters": within(_LETTER & _HEAD),
    }


def ratios(c: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, FEATURES) as float64."""
    words, chars, lines = (np.maximum(c[n], 1).astype(float) for n in ("n_words", "word_chars", "n_lines"))
    return np.stack([
        c["n_symbols"] / chars, c["n_upper"] / chars, c["n_marks"] / chars, c["n_digits"] / chars, c["n_letters"] / chars,
        c["n_repeat_words"] / words, c["n_dup_lines"] / lines, c["n_distinct"] / words, c["word_chars"] / words,
        c["n_words"] / lines, np.log1p(c["n_words"]),
    ], axis=1)


def ratio_columns(c: Column) -> dict[str, Column]:
    """FEATURES as columns over a struct of COUNTS; equal to ``ratios``."""
    d = lambda n: c[n].cast("double")
    words, chars, lines = (F.greatest(d(n), F.lit(1.0)) for n in ("n_words", "word_chars", "n_lines"))
    values = (
        d("n_symbols") / chars, d("n_upper") / chars, d("n_marks") / chars, d("n_digits") / chars, d("n_letters") / chars,
        d("n_repeat_words") / words, d("n_dup_lines") / lines, d("n_distinct") / words, d("word_chars") / words,
        d("n_words") / lines, F.log1p(d("n_words")),
    )
    return dict(zip(FEATURES, values, strict=True))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def append(
    docs: DataFrame, name: str, kind: T.DataType, fn: Callable[[np.ndarray, np.ndarray], pa.Array], text: str = "text"
) -> DataFrame:
    """``docs`` with a further last column, computed from whole texts without a shuffle.

    ``fn`` takes (offsets, bytes) of some texts, null as empty, and returns one value each. Memory of a task is
    bounded by a slice of texts (``words.SLICE_BYTES``) or one text.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, text):
            column = fn(*W.buffers(part.column(text)))
            yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def struct(arrays: dict[str, np.ndarray]) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(v) for v in arrays.values()], names=list(arrays))


def with_counts(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct of COUNTS as its last column."""
    return append(docs, name, COUNTS_TYPE, lambda o, x: struct({k: v.astype(np.int64) for k, v in count(o, x).items()}))


def part_of(key: Column, parts: int) -> Column:
    """The fold of a key: crc32 of it as text, modulo the number of folds. A null key is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string")) % parts, F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, 0/1 labels) of at most ``rows`` labelled documents outside fold 0, for a fit on the driver.

    The rows are those with the lowest hashes of the id, so that the choice depends on the data alone. The
    ids, at most ``rows``, are broadcast; a document that is labelled twice takes its highest label. Without
    labelled documents both arrays are empty.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (part_of(F.col("doc_id"), folds) != 0))
        .groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col(label).cast("int")).alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
    )
    texts = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(chosen), "_id").select("_id", "_label", "text")
    got = with_counts(texts, "_c").select("_id", "_label", "_c.*").orderBy("_id", *COUNTS).toArrow()
    if not got.num_rows:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    x = ratios({n: got.column(n).to_numpy() for n in COUNTS})
    return x, got.column("_label").to_numpy().astype(float)
