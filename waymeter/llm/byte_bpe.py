"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A leaf of the tree holds the rank of the pair that starts at a symbol, and its place; inner nodes hold the least of their
two children. So the root is the leftmost pair of the lowest rank. A merge changes three leaves (the pair itself, the one
before and the one that the right symbol began), each with a walk to the root, until the root holds no pair.

Inside a task the distinct pieces of a slice are encoded together: trees of like size are the columns of one numpy array,
and every step merges the root's pair of each. Longer pieces have a tree of their own. Rows never leave their partition, so
nothing is shuffled.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from waymeter.llm import words as W

TOKENIZER = "byte_bpe_50k.json"
#: Text that a task encodes at once; a longer text is cut into segments of that size.
SLICE_BYTES = 1 << 20
#: Pieces whose trees share an array; each has 63 bytes at most.
SHARED = 8192
#: Distinct pieces that a task remembers, and their bytes. Beyond that it starts anew.
KNOWN, KNOWN_BYTES = 200_000, 16 << 20

#: Kinds of characters: white space, letters, digits, others.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
#: Endings that are pieces of their own behind an apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
_NONE = np.iinfo(np.int32).max


def _byte_names() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {chr(b): b for b in shown}
    return names | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}


@dataclass
class Vocabulary:
    byte_ids: np.ndarray  # id of each byte
    pairs: np.ndarray  # sorted keys of the pairs that merge: left id and right id
    ranks: np.ndarray
    merged: np.ndarray  # id of the merged pair by rank
    rank_of: dict[int, int]
    starts: np.ndarray  # bytes of each id: data[starts[id] : starts[id + 1]]
    data: np.ndarray
    special: regex.Pattern | None
    special_ids: dict[str, int]
    kinds: np.ndarray  # kind of each code point

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it doesn't merge."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], -1)


@cache
def vocabulary(path: str) -> Vocabulary:
    """The byte-level BPE of a tokenizer file. Files that work otherwise are refused."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    same = (
        model.get("type") == "BPE" and not model.get("dropout") and not model.get("unk_token") and not model.get("ignore_merges") and not model.get("byte_fallback")
        and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix") and not spec.get("normalizer")
        and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and (spec.get("decoder") or {}).get("type") == "ByteLevel"
    )
    added = spec.get("added_tokens") or []
    if not same or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        raise ValueError(f"{path} is no plain byte-level BPE")
    names, ids = _byte_names(), model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    keys = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64).reshape(-1)
    order = np.argsort(keys)
    size = max([*ids.values(), *[t["id"] for t in added]]) + 1
    texts: list[bytes] = [b""] * size
    for name, i in ids.items():
        texts[i] = bytes(names[c] for c in name)
    for t in added:
        texts[t["id"]] = t["content"].encode()
    byte_ids = np.full(256, -1, np.int64)
    for name, b in names.items():
        byte_ids[b] = ids[name]
    special = {t["content"]: t["id"] for t in added}
    by_length = sorted(special, key=len, reverse=True)
    return Vocabulary(
        byte_ids, keys[order], order, np.array([ids[a + b] for a, b in merges], np.int64), {int(k): r for r, k in reversed(list(enumerate(keys)))},
        np.append(0, np.cumsum([len(t) for t in texts])), np.frombuffer(b"".join(texts), np.uint8),
        regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if special else None, special, _kinds(path),
    )


def _kinds(path: str) -> np.ndarray:
    """The kind of each code point, in the edition of Unicode that the tokenizer knows."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    kinds = np.full(0x110000, _OTHER, np.uint8)
    own = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    for kind, like, pattern in ((_SPACE, None, r"\s"), (_LETTER, "a", r"\p{L}"), (_DIGIT, "1", r"\p{N}")):
        found = regex.findall(pattern, every)
        # Python's table is older than the tokenizer's, the pattern's is newer: only what the former lacks is asked for.
        kinds[[ord(c) for c in found if like is None or unicodedata.category(c) != "Cn" or len(own(like + c)) == 1]] = kind
    return kinds


def _tree_merges(v: Vocabulary, data: bytes) -> list[int]:
    """The ids of one piece."""
    ids = v.byte_ids[np.frombuffer(data, np.uint8)].tolist()
    n = len(ids)
    size = 1 << max(1, (n - 1).bit_length())
    none, rank_of, merged = 1 << 62, v.rank_of, v.merged
    leaf = lambda p, q: (r << 32 | p) if (r := rank_of.get(ids[p] << 32 | ids[q])) is not None else none
    tree = [none] * (2 * size)
    for p in range(n - 1):
        tree[size + p] = leaf(p, p + 1)
    for k in range(size - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(p: int, value: int) -> None:
        k = size + p
        tree[k] = value
        while k > 1:
            k >>= 1
            a, b = tree[2 * k], tree[2 * k + 1]
            least = a if a < b else b
            if tree[k] == least:
                return
            tree[k] = least

    while tree[1] != none:
        rank, p = tree[1] >> 32, tree[1] & 0xFFFFFFFF
        ids[p] = int(merged[rank])
        q = after[p]
        end = after[p] = after[q]
        after[q] = -1
        put(q, none)
        if end < n:
            before[end] = p
            put(p, leaf(p, end))
        else:
            put(p, none)
        if before[p] >= 0:
            put(before[p], leaf(before[p], p))
    return [i for p, i in enumerate(ids) if after[p] != -1]


def _shared_merges(v: Vocabulary, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids one after the other, ids of each piece) of pieces of up to ``width`` bytes, one less than a power of two.

    Trees lie one after the other in a flat array, node 1 is the root of each. Place ``width`` stands before the first and behind
    the last symbol of a piece; no pair starts there.
    """
    count, leaves = len(pieces), width + 1
    shift = leaves.bit_length() - 1
    sizes = np.array([len(p) for p in pieces])
    ids = np.full((count, leaves), -1, np.int64)
    row = np.repeat(np.arange(count), sizes)
    ids[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = v.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    tree = np.full((count, 2 * leaves), _NONE, np.int32)
    rank = v.rank(ids[:, :-1], ids[:, 1:])
    tree[:, leaves:-1] = np.where(rank >= 0, rank << shift | np.arange(width), _NONE)
    for k in range(leaves - 1, 0, -1):
        np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
    after = np.broadcast_to(np.minimum(np.arange(1, leaves + 1), width), (count, leaves)).copy()
    before = np.broadcast_to(np.append(width, np.arange(width)), (count, leaves)).copy()
    flat, ids_, after_, before_ = tree.reshape(-1), ids.reshape(-1), after.reshape(-1), before.reshape(-1)

    alive = np.flatnonzero(tree[:, 1] < _NONE)
    while len(alive):
        at, base = alive * leaves, alive * (2 * leaves)
        root = flat[base + 1].astype(np.int64)
        p = root & (leaves - 1)
        q = after_[at + p]
        end = after_[at + q]
        ids_[at + p], ids_[at + q] = v.merged[root >> shift], -1
        after_[at + p], before_[at + end] = end, p
        first = before_[at + p]
        own = ids_[at + p]
        rank = v.rank(np.append(own, ids_[at + first]), np.append(ids_[at + end], own))
        leaf = np.where(rank >= 0, rank << shift | np.append(p, first), _NONE).astype(np.int32)
        # Leaves first, then the three walks to the root; the last one sees what the others changed.
        walks = [leaves + q, leaves + p, leaves + first]
        flat[base + walks[0]] = _NONE
        flat[base + walks[1]] = leaf[: len(p)]
        flat[base + walks[2]] = leaf[len(p) :]
        while walks[0][0] > 1:
            walks = [node >> 1 for node in walks]
            for node in walks:
                below = base + 2 * node
                flat[base + node] = np.minimum(flat[below], flat[below + 1])
        alive = alive[flat[base + 1] < _NONE]
    held = ids >= 0
    return ids[held], held.sum(1)


def encode_pieces(v: Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids one after the other, ids of each piece)."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    width = np.zeros(len(pieces), np.int64)  # 0: a tree of its own
    for w in (63, 31, 15, 7, 3):
        width[sizes <= w] = w
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for w in np.unique(width):
        same = np.flatnonzero(width == w)
        for mine in np.split(same, range(SHARED, len(same), SHARED)) if w else [same]:
            chosen = [pieces[k] for k in mine]
            if w:
                found, n = _shared_merges(v, chosen, int(w))
            else:
                lists = [np.array(_tree_merges(v, p), np.int64) for p in chosen]
                found, n = np.concatenate([np.zeros(0, np.int64), *lists]), np.array([len(x) for x in lists])
            out.append((mine, found, n))
    counts = np.zeros(len(pieces), np.int64)
    for mine, _, n in out:
        counts[mine] = n
    starts = np.cumsum(counts) - counts
    ids = np.zeros(counts.sum(), np.int32)
    for mine, found, n in out:
        ids[np.repeat(starts[mine] - (np.cumsum(n) - n), n) + np.arange(len(found))] = found
    return ids, counts


class Known:
    """Pieces met so far, by their hashes, and their ids."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.ids, self.ends, self.bytes = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def encoded(self, s: W.Spans, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, ids of each piece)."""
        if len(self.place) > KNOWN or self.bytes > KNOWN_BYTES:
            self.clear()
        distinct, first, group = np.unique(s.hash, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        fresh = [k for k, h in enumerate(keys) if h not in self.place]
        if fresh:
            raw = data.tobytes()
            pieces = [raw[a:b] for a, b in zip(s.start[first[fresh]].tolist(), s.end[first[fresh]].tolist(), strict=True)]
            self.bytes += sum(map(len, pieces))
            found, counts = encode_pieces(self.v, pieces)
            base = len(self.place)
            self.place.update((keys[k], base + n) for n, k in enumerate(fresh))
            self.ids, self.ends = np.append(self.ids, found), np.append(self.ends, self.ends[-1] + np.cumsum(counts))
        at = np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))[group]
        start = self.ends[at]
        counts = self.ends[at + 1] - start
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(start - (ends - counts), counts) + np.arange(total)], counts


def pieces(v: Vocabulary, offsets: np.ndarray, data: np.ndarray) -> W.Spans:
    """The pieces of some texts: an ending behind an apostrophe, or a run of one kind with the blank before it.

    Of white space before something else, the last character stands alone, or goes with what follows if it is a blank.
    """
    n = len(data)
    kind = W.kinds_of(data, v.kinds)
    lead = (data & 0xC0) != 0x80
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first[n] = True
    first = first[:n]
    begins = lead.copy()
    begins[1:] &= kind[1:] != kind[:-1]
    begins |= first
    space, last = kind == _SPACE, np.append(first[1:], True)
    # Leads of the last white space of a run that something follows.
    ends = np.flatnonzero(space[:-1] & ~space[1:] & ~last[:-1])
    blank = data[ends] == 0x20
    begins[ends[blank] + 1] = False
    ends = ends - (~lead[ends])
    ends = ends - (~lead[ends])
    begins[ends] = True
    apostrophes = np.flatnonzero(begins & (data == 0x27) & ~last)
    if len(apostrophes):
        stop = offsets[np.searchsorted(offsets, apostrophes, "right")]
        padded = np.append(data, np.zeros(2, np.uint8))
        for ending in _ENDINGS:
            has = apostrophes + len(ending) < stop
            for k, c in enumerate(ending.encode(), 1):
                has &= padded[apostrophes + k] == c
            begins[apostrophes[has] + 1] = False
            after = apostrophes[has] + 1 + len(ending)
            begins[after[after < stop[has]]] = True
    start = np.flatnonzero(begins)
    return W.hashed(offsets, data, start, np.append(start[1:], n)[: len(start)])


def _segments(v: Vocabulary, text: str) -> Iterator[str]:
    """A text cut at strings of special tokens; a long one also before white space that follows something else, where no piece goes on."""
    border = regex.compile(r"(?<=\S)\s")
    for part in v.special.split(text) if v.special is not None else [text]:
        start = 0
        while len(part) - start > SLICE_BYTES and (m := border.search(part, start + SLICE_BYTES)):
            yield part[start : m.start()]
            start = m.start()
        yield part[start:]


def encode_texts(known: Known, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids one after the other, ids of each text)."""
    v = known.v
    offsets, data = W.buffers(texts)
    odd = len(data) > 2 * SLICE_BYTES or any(pc.any(pc.match_substring(texts, s)).as_py() for s in v.special_ids)
    if not odd:
        s = pieces(v, offsets, data)
        ids, counts = known.encoded(s, data)
        return ids, W.sums(s.row, counts, len(texts))
    out, sizes = [], np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts.to_pylist()):
        for segment in _segments(v, text or ""):
            if segment in v.special_ids:
                ids = np.array([v.special_ids[segment]], np.int32)
            else:
                at, raw = W.buffers(pa.array([segment], pa.large_string()))
                ids = known.encoded(pieces(v, at, raw), raw)[0]
            out.append(ids)
            sizes[row] += len(ids)
    return np.concatenate([np.zeros(0, np.int32), *out]), sizes


def encode(docs: DataFrame, column: str = "text", into: str = "ids", path: str | None = None, decoded: str | None = None) -> DataFrame:
    """``docs`` with a column ``into``: the ids of each text, as the tokenizers library gives them without added special tokens.

    ``path`` is a tokenizer file of a plain byte-level BPE, others are refused; every worker reads it. A null text has no ids, like
    an empty one. ``decoded`` names a further column for the text that the ids decode to. Strings of special tokens in a text become their ids. Repeated rows are encoded alike, other columns stay (one named
    ``into`` is replaced), an empty table gives no rows. A task holds about 60 times a slice of 1 MB of text; of a longer text, which is
    cut into such segments, it holds the text and its ids besides. A piece without any border costs about 150 times its bytes.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    vocabulary(path)
    fresh = [into, *([decoded] if decoded else [])]
    names = [c for c in docs.columns if c not in fresh]
    shape = T.StructType([*docs.select(*names).schema, T.StructField(into, T.ArrayType(T.IntegerType())), *([T.StructField(decoded, T.StringType())] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(vocabulary(path))
        for part in W.slices(batches, column, SLICE_BYTES):
            ids, sizes = encode_texts(known, part.column(column).cast(pa.large_string()).fill_null(""))
            ends = np.append(0, np.cumsum(sizes))
            made: list[pa.Array] = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))]
            if decoded:
                made.append(pa.array([decode_ids(known.v, ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *made], names=[*names, *fresh])

    return docs.select(*names).mapInArrow(run, shape)


def decode(rows: DataFrame, column: str = "ids", into: str = "decoded", path: str | None = None) -> DataFrame:
    """``rows`` with a column ``into``: the text of each list of ids, special tokens included.

    Bytes that are no UTF-8 become U+FFFD; ids that the vocabulary lacks, and nulls, add nothing. A null list is an empty text.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    names = [c for c in rows.columns if c != into]
    shape = T.StructType([*rows.select(*names).schema, T.StructField(into, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lists = part.column(column)
                texts = [decode_ids(v, x.values.drop_null().to_numpy() if x.is_valid else np.zeros(0, np.int32)) for x in lists]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, into])

    return rows.select(*names).mapInArrow(run, shape)


def decode_ids(v: Vocabulary, ids: np.ndarray) -> str:
    ids = ids[(ids >= 0) & (ids < len(v.starts) - 1)].astype(np.int64)
    start = v.starts[ids]
    counts = v.starts[ids + 1] - start
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return v.data[np.repeat(start - (ends - counts), counts) + np.arange(total)].tobytes().decode("utf-8", "replace")


def digest_of_ids(ids: Column) -> Column:
    """Lowercase hex sha256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
