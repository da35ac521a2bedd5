"""Language identification by rank-order profiles and out-of-place distance.

A profile is the ranking of a language's most frequent character n-grams of one to three letters, counted over
all training texts. A document's own ranking is compared with each profile: every n-gram of the document adds
the distance of its two ranks, or the profile's length where the language lacks it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.llm import stats
from waymeter.llm import words as W

#: Ranked n-grams of a profile and of a document.
RANKS = 300
FOLDS = 5
UNKNOWN = "und"
_BLANK = 0x20
#: Slices of texts whose n-gram counts a task adds up before it hands them on.
GATHERED = 16


@cache
def _fold() -> np.ndarray:
    """Code point → its lower-case letter, or a blank for anything but a letter or a mark that belongs to one."""
    out = np.full(0x110000, _BLANK, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha() or unicodedata.category(ch)[0] == "M":
            out[c] = ord(ch.lower()[0])
    return out


def grams(
    offsets: np.ndarray, data: np.ndarray, group: np.ndarray, size: int = W.SLICE_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, n-gram code, count) of the texts of each group, sorted; ``group`` has a group number for each text.

    Words are runs of letters, with a blank at each end. A code holds up to three code points of 21 bits. Texts longer than
    ``size`` are counted in pieces of about that size, cut at blanks.
    """
    if len(data) <= 2 * size:
        return _grams(offsets, data, group)
    at, row = W.pieces(offsets, data, size)
    held, start = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)], 0
    while start < len(row):
        stop = max(start + 1, int(np.searchsorted(at, at[start] + 2 * size, "right")) - 1)
        found = _grams(at[start : stop + 1] - at[start], data[at[start] : at[stop]], group[row[start:stop]])
        g, code, n = (np.concatenate(x) for x in zip(held, found, strict=True))
        order = np.lexsort((code, g))
        g, code, n = g[order], code[order], n[order]
        first = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (code[1:] != code[:-1]))[: len(g)])
        held = [g[first], code[first], np.add.reduceat(n, first) if len(first) else n]
        start = stop
    return tuple(held)


def _grams(offsets: np.ndarray, data: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = heads[offsets]
    chars = np.full(len(points) + len(offsets), _BLANK, np.uint32)  # a blank before each text and at the end
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    chars[np.arange(len(points)) + row + 1] = _fold()[points]
    owner = np.zeros(len(chars), np.int64)
    owner[np.arange(len(points)) + row + 1] = group[row]
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != _BLANK) | (chars[:-1] != _BLANK)
    chars, owner = chars[keep], owner[keep]
    if len(chars) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

    present = np.zeros(0x110000, bool)
    present[chars] = True
    letters = np.flatnonzero(present)
    dense = np.zeros(0x110000, np.int64)
    dense[letters] = np.arange(len(letters))
    x, size = dense[chars], len(letters)
    blank = dense[_BLANK]
    middle = x[1:-1] != blank
    keys, counts = _run_lengths(((owner[1:-1] * size + x[:-2]) * size + x[1:-1])[middle] * size + x[2:][middle], None)
    g, a, b, c = keys // size**3, keys // size**2 % size, keys // size % size, keys % size
    last = c == blank
    code = lambda *p: sum(letters[v].astype(np.uint64) << np.uint64(21 * k) for k, v in enumerate(reversed(p)))
    two_keys, two_counts = _run_lengths(
        np.concatenate([(g * size + a) * size + b, (g[last] * size + b[last]) * size + blank]), np.concatenate([counts, counts[last]])
    )
    one_keys, one_counts = _run_lengths(g * size + b, counts)
    groups = np.concatenate([g, two_keys // size**2, one_keys // size])
    codes = np.concatenate([code(a, b, c), code(two_keys // size % size, two_keys % size), code(one_keys % size)])
    total = np.concatenate([counts, two_counts, one_counts])
    order = np.lexsort((codes, groups))
    return groups[order], codes[order], total[order]


def _run_lengths(keys: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs, or the sum of its weights."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.diff(np.append(first, len(keys))) if weights is None else np.add.reduceat(weights, first)


def profiles(docs: DataFrame, ranks: int = RANKS) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Language → (n-gram codes in order, their ranks), from all rows with a text and a language.

    Counts are added up by Spark; ``ranks`` rows a language reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            lang = pa.concat_arrays([h[0] for h in held]).dictionary_encode()
            number, codes, n = lang.indices.to_numpy(), *(np.concatenate([h[k] for h in held]) for k in (1, 2))
            order = np.lexsort((codes, number))
            number, codes, n = number[order], codes[order], n[order]
            first = np.flatnonzero(np.append(True, (number[1:] != number[:-1]) | (codes[1:] != codes[:-1])))
            total = np.add.reduceat(n, first)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(number[first])), pa.array(codes[first].view(np.int64)), pa.array(total)], names=["lang", "code", "n"]
            )

        for part in W.slices(batches):
            lang = part.column("lang").cast(pa.string()).dictionary_encode()
            number, codes, n = grams(*W.buffers(part.column("text")), lang.indices.to_numpy().astype(np.int64))
            if len(codes):
                held.append((lang.dictionary.take(pa.array(number)), codes, n))
            if len(held) == GATHERED:
                yield out()
        if held:
            yield out()

    learned = docs.where("text IS NOT NULL AND lang IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    counts = learned.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    # The filter is on the row number itself: so every task drops what is not among its first before the shuffle.
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= ranks)
    rows = top.select("lang", "code", (F.col("place") - 1).alias("rank")).toArrow()
    rows = rows.sort_by([("lang", "ascending"), ("code", "ascending")])
    lang, code, rank = rows.column("lang").to_numpy(), rows.column("code").to_numpy().view(np.uint64), rows.column("rank").to_numpy()
    return {name: (code[lang == name], rank[lang == name].astype(np.int64)) for name in dict.fromkeys(lang.tolist())}


def identify(docs: DataFrame, known: dict[str, tuple[np.ndarray, np.ndarray]], name: str, ranks: int = RANKS) -> DataFrame:
    """``docs`` with a struct ``name`` (lang_pred, score) from whole texts. No shuffle.

    score is 1 less the distance's share of the largest possible one. A null text, one without a letter, or any
    text where nothing was learned is UNKNOWN with score 0. Languages at one distance: the first by name. Rows
    are judged one by one, so repeated rows and null ids pass through; an empty table gives no rows.
    """
    names = sorted(known)

    def judge(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
        rows = len(offsets) - 1
        row, code, n = grams(offsets, data, np.arange(rows))
        order = np.argsort((row << 40) - n, kind="stable")
        row, code = row[order], code[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
        top = rank < ranks
        row, code, rank = row[top], code[top], rank[top]
        held = np.bincount(row, minlength=rows)
        distance = np.empty((len(names), rows))
        for k, lang in enumerate(names):
            codes, places = known[lang]
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            apart = np.where(codes[at] == code, np.abs(places[at] - rank), ranks)
            distance[k] = np.bincount(row, apart, rows)
        found = held > 0 if names else np.zeros(rows, bool)
        best = distance.argmin(0) if names else np.zeros(rows, int)
        score = np.where(found, 1 - (distance.min(0) if names else 0) / np.maximum(held * ranks, 1), 0.0)
        return stats.struct({"lang_pred": np.where(found, np.array([*names, UNKNOWN], object)[best], UNKNOWN), "score": score})

    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return stats.append(docs, name, kind, judge)
