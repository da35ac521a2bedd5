"""Words, lines and shingles of many texts at once, as numpy arrays over Arrow buffers.

Helpers that run inside Spark tasks. A slice of rows is handled as one byte buffer: bytes are classified by
table, words are the runs between separators, and a word's 64-bit hash is the difference of two prefix sums.
"""

from __future__ import annotations

import ctypes
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

# Bytes of text handled at once in a task; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CODES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Separators of words: space and \t \n \v \f \r.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
WORD_BYTES = ~BLANK
#: Letters and digits; every byte of a non-ASCII character counts as a letter.
ALNUM_BYTES = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_SAME = np.arange(256)
_LOWER = np.where((_SAME >= 65) & (_SAME <= 90), _SAME + 32, _SAME)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to ``n`` of the base of the hashes, and of its inverse."""
    bases = np.empty((2, n + 1), np.uint64)
    bases[:, 0] = 1
    bases[:, 1:] = [[_BASE], [_BASE_INVERSE]]
    base, inverse = np.multiply.accumulate(bases, 1)
    return base, inverse


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of a string or binary array; a null is an empty text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about ``size`` bytes of text and at least one row."""
    for batch in batches:
        lengths = np.diff(buffers(batch.column(column))[0]) + 64
        ends, start = np.cumsum(lengths), 0
        while start < batch.num_rows:
            before = ends[start] - lengths[start]
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        release()
    release()


@cache
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def release() -> None:
    """Give freed memory back: workers stay for later tasks."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


@dataclass
class Spans:
    """Runs of bytes. ``row`` is the text of a run, ``first`` has for each text its first run, and the end."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def spans(
    offsets: np.ndarray, data: np.ndarray, inside: np.ndarray = WORD_BYTES, lower: bool = True, kinds: np.ndarray | None = None
) -> Spans:
    """Maximal runs of the bytes of table ``inside``, within one text each, with their hashes.

    ``kinds`` gives each byte a kind; a run is cut between two bytes whose kinds are above 0 and differ.
    """
    n, rows = len(data), len(offsets) - 1
    word = inside[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] = word[edges]
    ends[edges - 1] = word[edges - 1]
    if kinds is not None and n:
        kind = kinds[data]
        turn = word[1:] & word[:-1] & (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        begins[1:] |= turn
        ends[:-1] |= turn
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return _spans(offsets, data, start, end, rows, _LOWER if lower else _SAME)


def lines(offsets: np.ndarray, data: np.ndarray) -> Spans:
    """Lines between line feeds; their bytes are taken as they are. Lines without a byte are left out."""
    newline = np.zeros(256, bool)
    newline[0x0A] = True
    return spans(offsets, data, ~newline, lower=False)


#: Kinds of characters for ``tokens``; a BORDER is a mark that may end a sentence or a quotation.
OUTSIDE, LETTER, SINGLE, BORDER = range(4)
#: Scripts written without blanks, by the start of the character's name; their characters are tokens one by one.
_UNSPACED = ("CJK ", "HIRAGANA", "KATAKANA", "HALFWIDTH KATAKANA", "BOPOMOFO", "THAI", "LAO ", "KHMER", "MYANMAR", "YI ", "TIBETAN", "JAVANESE", "NEW TAI", "TAI ")
_BORDERS = set("\n\r\t.!?:;\"()[]{}|") | set("\u0085\u2028\u2029\u2026\u203d\u037e\u061f\u06d4\u0964\u0965\u3002\u00a1\u00bf\uff01\uff0e\uff1a\uff1b\uff1f\uff61")


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    out = np.full(0x110000, LETTER, np.uint8)
    out[0x20000:0x40000] = SINGLE  # ideographs
    for k in range(0x20000):
        c = chr(k)
        group = unicodedata.category(c)
        if c in _BORDERS or group in ("Pi", "Pf", "Ps", "Pe"):
            out[k] = BORDER
        elif group[0] in "PSZ" or group in ("Cc", "Cf"):
            out[k] = OUTSIDE
        elif group[0] in "LM" and unicodedata.name(c, "").startswith(_UNSPACED):
            out[k] = SINGLE
    # Single quotes are apostrophes as often as not.
    out[[0x2018, 0x2019, 0x201A, 0x201B]] = OUTSIDE
    return out


def kinds_of(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The kind, by a table over all code points, of the character that each byte of UTF-8 text belongs to."""
    kind = table[data]
    if len(data) and data.max() >= 128:
        for size, low, high, mask in ((2, 0xC0, 0xE0, 0x1F), (3, 0xE0, 0xF0, 0x0F), (4, 0xF0, 0xF8, 0x07)):
            at = np.flatnonzero((data >= low) & (data < high))
            at = at[at + size <= len(data)]
            code = data[at].astype(np.int64) & mask
            for k in range(1, size):
                code = code << 6 | data[at + k] & 0x3F
            for k in range(size):
                kind[at + k] = table[code]
    return kind


def tokens(offsets: np.ndarray, data: np.ndarray) -> tuple[Spans, np.ndarray]:
    """Runs of letters and digits, and single characters of scripts without blanks; whether a border precedes each.

    Punctuation and symbols of all of Unicode cut. A text's first token has a border before it; a point or colon right before a letter
    or digit (3.14, 12:30) is none.
    """
    n, rows = len(data), len(offsets) - 1
    kind = kinds_of(data, _kinds())
    word = (kind == LETTER) | (kind == SINGLE)
    begins, ends = word.copy(), word.copy()
    single = (kind == SINGLE) & ((data & 0xC0) != 0x80)
    begins[1:] &= ~word[:-1] | single[1:] | ((kind[:-1] == SINGLE) & (kind[1:] == LETTER))
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] = word[edges]
    ends[:-1] &= ~word[1:] | begins[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    found = _spans(offsets, data, start, end, rows, _LOWER)
    border = kind == BORDER
    inner = (data == ord(".")) | (data == ord(":"))
    border[:-1] &= ~(inner[:-1] & (kind[1:] == LETTER))
    borders = np.flatnonzero(border)
    before = np.ones(len(start), bool)
    before[1:] = (found.row[1:] != found.row[:-1]) | (np.searchsorted(borders, start[1:]) > np.searchsorted(borders, end[:-1]))
    return found, before


def hashed(offsets: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Spans:
    """The given runs of bytes, each within one text, with their hashes; bytes are taken as they are."""
    return _spans(offsets, data, start, end, len(offsets) - 1, _SAME)


def _spans(offsets, data, start, end, rows, fold) -> Spans:
    row = np.searchsorted(offsets, start, "right") - 1
    return Spans(start, end, row, np.searchsorted(row, np.arange(rows + 1)), _hashes(data, start, end, _CODES[fold]))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray, size: int = SLICE_BYTES) -> np.ndarray:
    """Hashes of runs in their order, which don't overlap.

    A hash depends on the bytes of its run alone. So ``size`` bytes are summed up at once, and a longer run in parts: what is
    held beside the text does not grow with it, but for the runs themselves.
    """
    base, inverse = _powers(size)
    out, done = np.empty(len(start), np.uint64), 0
    while done < len(start):
        begin = int(start[done])
        stop = max(done + 1, int(np.searchsorted(end, begin + size, "right")))
        length = int(end[stop - 1]) - begin
        if length > size:
            sums = [int((codes[part] * base[: len(part)]).sum()) for part in np.split(data[begin : begin + length], range(size, length, size))]
            out[done] = sum(v * pow(int(_BASE), k * size, 1 << 64) for k, v in enumerate(sums)) % (1 << 64)
        else:
            prefix = np.zeros(length + 1, np.uint64)
            np.cumsum(codes[data[begin : begin + length]] * base[:length], out=prefix[1:])
            a, b = start[done:stop] - begin, end[done:stop] - begin
            out[done:stop] = (prefix[b] - prefix[a]) * inverse[a]
        done = stop
    return mix(out)


def windows(words: Spans, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, index of the first word) of all runs of ``size`` words of a text.

    ``short``: a text with fewer words, but one at least, has its whole sequence as the only run.
    """
    h = words.hash
    n = len(h)
    out, at = np.zeros(max(0, n - size + 1), np.uint64), np.arange(max(0, n - size + 1))
    for k in range(size):
        out += h[k : k + len(out)] * factor(k)
    whole = words.row[: len(out)] == words.row[size - 1 :][: len(out)] if len(out) else np.zeros(0, bool)
    out, at = out[whole], at[whole]
    row = words.row[at]
    if short:
        counts = words.count
        few = np.flatnonzero((counts > 0) & (counts < size))
        if len(few):
            extra = np.zeros(len(few), np.uint64)
            for k in range(size - 1):
                has = counts[few] > k
                extra[has] += h[words.first[few[has]] + k] * factor(k)
            extra += counts[few].astype(np.uint64) * factor(97)
            out = np.concatenate([out, extra])
            at, row = np.concatenate([at, words.first[few]]), np.concatenate([row, few])
            order = np.argsort(row, kind="stable")
            out, at, row = out[order], at[order], row[order]
    return mix(out, 1), row, at


def factor(k: int) -> np.uint64:
    """The odd multiplier of the k-th word of a run."""
    return np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64) | 1)


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs, sorted by both."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[keep], value[keep]


def sums(row: np.ndarray, weights: np.ndarray | None, rows: int) -> np.ndarray:
    """Whole-number sums by row."""
    return np.bincount(row, weights, rows).astype(np.int64)


def marked(offsets: np.ndarray, data: np.ndarray, table: np.ndarray, size: int = SLICE_BYTES) -> np.ndarray:
    """How many bytes of each text are in ``table``."""
    out = np.zeros(len(offsets) - 1, np.int64)
    for begin in range(0, len(data), size):
        part = table[data[begin : begin + size]]
        total = np.zeros(len(part) + 1, np.int64)
        np.cumsum(part, out=total[1:])
        out += np.diff(total[np.clip(offsets - begin, 0, len(part))])
    return out


def pieces(offsets: np.ndarray, data: np.ndarray, size: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of pieces, text of each): texts cut before a blank once ``size`` bytes are passed; a run without one stays whole."""
    cuts = []
    for row in np.flatnonzero(np.diff(offsets) > size):
        at, end = int(offsets[row]) + size, int(offsets[row + 1])
        while at < end:
            if BLANK[data[at]]:
                cuts.append(at)
                at += size
                continue
            ahead = np.flatnonzero(BLANK[data[at : min(end, at + size)]])
            at += int(ahead[0]) if len(ahead) else size
    all_cuts = np.array(cuts, np.int64)
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, all_cuts, "right") - 1])
    starts = np.concatenate([offsets[:-1], all_cuts])
    order = np.lexsort((starts, row))
    return np.append(starts[order], offsets[-1]), row[order]
