"""Language-model scores by deleted interpolation.

    P(w | v) = l2[b] c(v w) / c(v) + l1[b] c(w) / N + l0[b] / (V + 1),    b: bucket of the context's frequency c(v)

The weights l of each bucket are learned by expectation-maximisation: estimates from one part of the training
documents are mixed so that they fit the n-grams counted in the other part. Scores then use the counts of all
training documents.

Where the work goes. The most frequent words and word pairs, fixed numbers of them, are counted exactly and
travel with the tasks. Any other occurrence is routed once to the bucket of its rare word, or of the pair where
both words are frequent, so no bucket has a hot key. A bucket holds every occurrence of its rare words, which
gives their counts without another pass; only pairs of two rare words are joined with a table of counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeter.llm import words as W
from waymeter.session import materialize

#: Words and word pairs that travel with the tasks. Which these are changes no result.
FREQUENT_WORDS, FREQUENT_PAIRS = 1 << 17, 1 << 18
#: Text that a task counts at once, and the count in it from which a word or pair can be among the frequent.
CHUNK_BYTES, LOCAL_COUNT = 4 << 20, 4
#: Of the occurrences of others one in SAMPLED is noted, and from SIGNIFICANT of them on they count: a word that is rare in every
#: chunk of a large corpus is among the frequent nevertheless.
SAMPLED, SIGNIFICANT = 256, 4
#: Occurrences that a bucket holds, about.
BUCKET_ROWS = 300_000
#: Rows that a task hands on at once: large batches stay in the JVM's memory outside its heap.
OUTPUT_ROWS = 1 << 14
#: Parts of the documents by crc32 of the id: one is held out, and one of the training parts fits the weights.
FOLDS, HELD_OUT, DELETED = 7, 2, 3
ROUNDS = 60

_START, _END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
_KEPT, _DELETED, _UNSEEN = 0, 1, 2  # parts of the documents, as numbers in the tasks

# Classes of routed occurrences: a rare word after a frequent or a rare one, a frequent word after a rare one, two frequent ones.
_RARE, _BOTH_RARE, _AFTER_RARE, _PAIR = range(4)


def parts(doc_id: Column) -> tuple[Column, Column]:
    """(held_out, part): a null id is a training document."""
    fold = F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS, F.lit(0))
    return fold == HELD_OUT, F.when(fold == HELD_OUT, _UNSEEN).when(fold == DELETED, _DELETED).otherwise(_KEPT)


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return W.mix(v * W.factor(5) + w * W.factor(6), 2)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, token, row) of all tokens of some texts, the end of each text included."""
    s = W.spans(*W.buffers(texts))
    rows = len(texts)
    token = np.full(len(s.hash) + rows, _END)
    token[np.arange(len(s.hash)) + s.row] = s.hash
    row = np.repeat(np.arange(rows), s.count + 1)
    context = np.empty(len(token), np.uint64)
    context[1:] = token[:-1]
    context[np.cumsum(s.count + 1) - s.count - 1] = _START
    return context, token, row


def _count(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first of each distinct key in the order, count)."""
    order = np.argsort(keys)
    ranked = keys[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])
    return order, first, np.diff(np.append(first, len(ranked)))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for part in W.slices(batches):
        held.append(part)
        size += part.column("text").nbytes
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass
class Frequent:
    """Sorted hashes of frequent words and pairs, the words of the pairs, and counts (all, kept part) once they are known."""

    words: np.ndarray
    pairs: np.ndarray
    first: np.ndarray
    second: np.ndarray
    word_counts: np.ndarray
    pair_counts: np.ndarray


class _Places:
    """Looks values up among sorted hashes: the leading bits tell which few of them to compare."""

    #: Hashes with the same leading bits, from which on they are searched by bisection.
    MOST = 64

    def __init__(self, known: np.ndarray):
        bits = max(len(known).bit_length(), 1)
        self.known, self.shift = known, np.uint64(64 - bits)
        self.start = np.searchsorted(known >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.even = int(np.diff(self.start).max()) <= self.MOST

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each value, or -1."""
        if not self.even:
            return _find(self.known, h)
        slot = (h >> self.shift).astype(np.int64)
        at, end = self.start[slot], self.start[slot + 1]
        out = np.full(len(h), -1)
        left = np.flatnonzero(at < end)
        at, end, h = at[left], end[left], h[left]
        while len(left):
            hit = self.known[at] == h
            out[left[hit]] = at[hit]
            on = np.flatnonzero(~hit & (at + 1 < end))
            left, at, end, h = left[on], at[on] + 1, end[on], h[on]
        return out


def _find(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place of each value among sorted known ones, or -1."""
    if not len(known):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, at, -1)


def _u64(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().view(np.uint64)


def _candidates(keys: np.ndarray, name: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, count, whether noted by chance alone) of the keys of a chunk that can be among the frequent.

    Chances depend on the chunk's name, so that a task that runs again notes the same, and a key is noted by its own count.
    """
    order, first, n = _count(keys)
    at = order[first]
    drawn = (n < LOCAL_COUNT) & (W.mix(keys[at] ^ np.uint64(name), 13) % np.uint64(SAMPLED) < n.astype(np.uint64))
    on = (n >= LOCAL_COUNT) | drawn
    return at[on], n[on], drawn[on]


def _chunk_name(chunk: list[pa.RecordBatch]) -> int:
    """Of a chunk's documents, in their order."""
    keys = np.concatenate([p.column("key").to_numpy() for p in chunk])
    return int(W.mix(keys.view(np.uint64) + np.arange(len(keys), dtype=np.uint64) * W.factor(11), 12).sum(dtype=np.uint64))


def choose_frequent(docs: DataFrame) -> tuple[Frequent, int]:
    """Words and pairs with most occurrences, as far as they are frequent in some chunk of the text or were noted often enough by
    chance, and a count of all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            name = _chunk_name(chunk)
            context, token, _ = (np.concatenate(x) for x in zip(*[_tokens(p.column("text")) for p in chunk], strict=True))
            out = [(np.zeros(1, np.uint64), np.zeros(1, np.uint64), np.array([len(token)]), np.zeros(1, bool))]
            at, n, drawn = _candidates(token, name)
            out.append((np.zeros(len(at), np.uint64), token[at], n, drawn))
            at, n, drawn = _candidates(_pair(context, token), name)
            out.append((context[at], token[at], n, drawn))
            v, w, n, drawn = (np.concatenate(x) for x in zip(*out, strict=True))
            columns = v.view(np.int64), w.view(np.int64), np.where(drawn, 0, n), drawn.astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["v", "w", "n", "drawn"])

    noted = docs.select("key", "text").mapInArrow(run, "v long, w long, n long, drawn long")
    noted = noted.groupBy("v", "w").agg(F.sum("n").alias("n"), F.sum("drawn").alias("drawn"))
    drawn = F.when(F.col("drawn") >= SIGNIFICANT, F.col("drawn") * SAMPLED).otherwise(0)
    seen = materialize(noted.select("v", "w", (F.col("n") + drawn).alias("n")).where("n > 0"), "frequent")
    total = seen.where("v = 0 AND w = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Bounded: at most FREQUENT_WORDS and FREQUENT_PAIRS rows reach the driver.
    top = lambda rows, k: rows.orderBy(F.desc("n"), "v", "w").limit(k).select("v", "w").toArrow()
    words = np.unique(np.append(_u64(top(seen.where("v = 0 AND w <> 0"), FREQUENT_WORDS), "w"), [_START, _END]))
    pairs = top(seen.where("v <> 0"), FREQUENT_PAIRS)
    v, w = _u64(pairs, "v"), _u64(pairs, "w")
    vi, wi = _find(words, v), _find(words, w)
    both = (vi >= 0) & (wi >= 0)
    h = _pair(v, w)[both]
    order = np.argsort(h)
    none = np.zeros((0, 2), np.int64)
    return Frequent(words, h[order], vi[both][order], wi[both][order], none, none), int(total)


def count_frequent(docs: DataFrame, f: Frequent) -> tuple[int, int]:
    """Exact counts of the frequent words (the start: documents) and pairs in the training documents.

    Returns how many tokens all training documents and the kept part have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = len(f.words), len(f.pairs)
        words, pairs = _Places(f.words), _Places(f.pairs)
        held = np.zeros((sum(sizes) + 1, 2), np.int64)  # the last row counts all tokens
        for part in W.slices(batches):
            part = part.filter(pa.array(part.column("part").to_numpy() != _UNSEEN))
            context, token, row = _tokens(part.column("text"))
            deleted = part.column("part").to_numpy() == _DELETED
            for at, on, base in ((words.find(token), deleted[row], 0), (pairs.find(_pair(context, token)), deleted[row], sizes[0])):
                for k, mask in ((0, ~on & (at >= 0)), (1, on & (at >= 0))):
                    held[base : base + sizes[base > 0], k] += np.bincount(at[mask], minlength=sizes[base > 0])
            start = int(words.find(np.array([_START]))[0])
            held[start] += [(~deleted).sum(), deleted.sum()]
            held[-1] += [(~deleted[row]).sum(), deleted[row].sum()]
        at = np.flatnonzero(held.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at, 0]), pa.array(held[at, 1])], names=["at", "kept", "deleted"])

    rows = docs.select("text", "part").mapInArrow(run, "at long, kept long, deleted long").groupBy("at")
    got = rows.agg(F.sum("kept").alias("kept"), F.sum("deleted").alias("deleted")).toArrow()
    both = np.zeros((len(f.words) + len(f.pairs) + 1, 2), np.int64)
    at, kept = got.column("at").to_numpy(), got.column("kept").to_numpy()
    both[at, 0], both[at, 1] = kept + got.column("deleted").to_numpy(), kept
    f.word_counts, f.pair_counts = both[: len(f.words)], both[len(f.words) : -1]
    return int(both[-1, 0]), int(both[-1, 1])


_ROUTED = "bucket int, class int, chunk long, docs int, at binary, x binary, y binary"
#: A row of this class has the keys of a chunk's documents in place of occurrences.
_KEYS = 4


def _narrow(values: np.ndarray, size: int) -> bytes:
    """Whole numbers below 256 ** size."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _widen(raw: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(raw) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(-1, size)
    return out.reshape(-1).view("<u8")


#: Bytes of x and y in each class: hashes have eight, places of frequent words three, places of both six.
_WIDTHS = {_RARE: (8, 3), _BOTH_RARE: (8, 8), _AFTER_RARE: (8, 3), _PAIR: (6, 0)}


def route(docs: DataFrame, f: Frequent, buckets: int) -> DataFrame:
    """Occurrences of pairs that are not frequent, packed: a row per chunk, bucket and class.

    ``at`` has the document's place in its chunk, times four, plus its part. A chunk is named by its documents.
    """
    words, pairs = f.words, f.pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, pair = _Places(words), _Places(pairs)
        for chunk in _chunks(batches):
            docs_before, found = 0, []
            for part in chunk:
                context, token, row = _tokens(part.column("text"))
                open_at = np.flatnonzero(pair.find(_pair(context, token)) < 0)
                context, token, row = context[open_at], token[open_at], row[open_at]
                vi, wi = word.find(context), word.find(token)
                rare, after = wi < 0, vi < 0
                kind = np.where(rare, np.where(after, _BOTH_RARE, _RARE), np.where(after, _AFTER_RARE, _PAIR)).astype(np.uint8)
                packed = (np.maximum(vi, 0).astype(np.uint64) << np.uint64(24)) | np.maximum(wi, 0).astype(np.uint64)
                x = np.where(rare, token, np.where(after, context, packed))
                y = np.where(rare, np.where(after, context, vi.astype(np.uint64)), wi.astype(np.uint64))
                place = (row + docs_before) * 4 + part.column("part").to_numpy()[row]
                found.append((kind, x, y, place.astype(np.uint32)))
                docs_before += part.num_rows
            kind, x, y, place = (np.concatenate(p) for p in zip(*found, strict=True))
            keys = np.concatenate([p.column("key").to_numpy() for p in chunk])
            name = int(np.uint64(_chunk_name(chunk)).view(np.int64))
            group = (W.mix(x, 3) % np.uint64(buckets)).astype(np.int64) * 4 + kind
            order = np.argsort(group, kind="stable")
            ranked = group[order]
            first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])
            out: list[list] = [[abs(name) % buckets], [_KEYS], [name], [len(keys)], [b""], [keys.tobytes()], [b""]]
            for a, b in zip(first, np.append(first[1:], len(ranked)), strict=True):
                rows = order[a:b]
                bucket, k = divmod(int(ranked[a]), 4)
                wx, wy = _WIDTHS[k]
                at = _narrow(place[rows], 2 if len(keys) < 1 << 14 else 4)
                fields = bucket, k, name, len(keys), at, _narrow(x[rows], wx), _narrow(y[rows], wy) if wy else b""
                for values, value in zip(out, fields, strict=True):
                    values.append(value)
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 3)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=[c.split()[0] for c in _ROUTED.split(", ")])

    return docs.select("key", "part", "text").mapInArrow(run, _ROUTED)


_RESOLVED = "kind int, chunk long, at int, v long, cvw long, cv long, cw long, kept_cvw long, kept_cw long, n double, p2 double, p1 double"
#: Kinds of rows: an occurrence with all counts, after a frequent or for a rare word; one whose context's count is
#: missing; the counts of a rare word; a document's key; deleted occurrences of like estimates.
_DONE, _DONE_RARE, _OPEN, _WORD, _KEY, _CELL = range(6)


def _both(keys: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each occurrence's key in all training documents and in the kept part; the distinct keys and their counts."""
    order, first, n = _count(keys)
    group = np.empty(len(keys), np.int64)
    group[order] = np.repeat(np.arange(len(first)), n)
    counts = np.stack([np.bincount(group, fold != _UNSEEN, len(first)), np.bincount(group, fold == _KEPT, len(first))], 1).astype(np.int64)
    return counts[group], keys[order[first]], counts


def _octave(p: np.ndarray) -> np.ndarray:
    """Bin of an estimate: an eighth of an octave."""
    return np.where(p > 0, np.floor(8 * np.log2(np.maximum(p, 1e-300))), -10_000).astype(np.int64)


def resolve(routed: DataFrame, f: Frequent, kept_tokens: int) -> DataFrame:
    """Counts for every routed occurrence; a group is a bucket, whose size is bounded by the number of buckets."""
    known = f.word_counts

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {k: [] for k in range(4)}
        chunks: list[int] = []
        for batch in batches:
            for r in batch.to_pylist():
                if r["class"] == _KEYS:
                    yield from rows(_KEY, np.full(r["docs"], r["chunk"]), np.arange(r["docs"]), v=np.frombuffer(r["x"], np.int64))
                    continue
                wx, wy = _WIDTHS[r["class"]]
                at = _widen(r["at"], 2 if r["docs"] < 1 << 14 else 4).astype(np.int32)
                held[r["class"]].append((np.full(len(at), len(chunks), np.int32), at, _widen(r["x"], wx), _widen(r["y"], wy) if wy else np.zeros(len(at), np.uint64)))
                chunks.append(r["chunk"])
        names = np.array(chunks, np.int64)
        none = (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        take = lambda k: tuple(np.concatenate(p) for p in zip(*held.pop(k), strict=True)) if held[k] else none

        # Frequent words in pairs that are not frequent.
        chunk, at, x, _ = take(_PAIR)
        cv, cw = known[(x >> np.uint64(24)).astype(np.int64)], known[(x & np.uint64(0xFFFFFF)).astype(np.int64)]
        yield from done(_DONE, names[chunk], at, _both(x, at & 3)[0], cv, cw)
        # Rare words: all their occurrences are here.
        one, two = take(_RARE), take(_BOTH_RARE)
        split = len(one[0])
        chunk, at, x, y = (np.concatenate(p) for p in zip(one, two, strict=True))
        cw, rare_words, rare_counts = _both(x, at & 3)
        pair = W.mix(x ^ W.mix(y, 8), 9)
        pair[split:] = W.mix(pair[split:], 10)
        cvw = _both(pair, at & 3)[0]
        yield from done(_DONE_RARE, names[chunk[:split]], at[:split], cvw[:split], known[y[:split].astype(np.int64)], cw[:split])
        deleted = at[split:] & 3 == _DELETED
        keep = lambda c: pa.array(c[split:, 1], mask=~deleted)
        yield from rows(_OPEN, names[chunk[split:]], at[split:] >> 2, v=y[split:].view(np.int64), cvw=cvw[split:, 0], cw=cw[split:, 0], kept_cvw=keep(cvw), kept_cw=keep(cw))
        yield from rows(_WORD, np.zeros(len(rare_words), np.int64), np.zeros(len(rare_words), np.int64), v=rare_words.view(np.int64), cw=rare_counts[:, 0], kept_cw=rare_counts[:, 1])
        # Frequent words after them.
        chunk, at, x, y = take(_AFTER_RARE)
        place = _Places(rare_words).find(x)
        cv = np.zeros((len(place), 2), np.int64)
        cv[place >= 0] = rare_counts[place[place >= 0]]
        yield from done(_DONE, names[chunk], at, _both(W.mix(x ^ W.mix(y, 8), 9), at & 3)[0], cv, known[y.astype(np.int64)])
        W.release()

    def done(kind: int, chunk, at, cvw, cv, cw) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((at, chunk))
        yield from rows(kind, chunk[order], at[order] >> 2, cvw=cvw[order, 0], cv=cv[order, 0], cw=cw[order, 0])
        on = at & 3 == _DELETED
        b = buckets_of(cv[on, 1])
        p2, p1 = cvw[on, 1] / np.maximum(cv[on, 1], 1), cw[on, 1] / max(kept_tokens, 1)
        cell = (b * 32_768 + _octave(p2) + 16_384) * 32_768 + _octave(p1) + 16_384
        _, first, group = np.unique(cell, return_index=True, return_inverse=True)
        size = len(first)
        none = np.zeros(size, np.int64)
        yield from rows(_CELL, none, b[first], n=np.bincount(group, minlength=size).astype(float), p2=np.bincount(group, p2, size), p1=np.bincount(group, p1, size))

    kinds = {"kind": pa.int32(), "at": pa.int32(), "n": pa.float64(), "p2": pa.float64(), "p1": pa.float64()}

    def rows(kind: int, chunk: np.ndarray, at: np.ndarray, **columns) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(chunk), OUTPUT_ROWS):
            part = slice(start, start + OUTPUT_ROWS)
            yield some(kind, chunk[part], at[part], **{name: c[part] for name, c in columns.items()})

    def some(kind: int, chunk: np.ndarray, at: np.ndarray, **columns) -> pa.RecordBatch:
        n = len(chunk)
        columns |= {"kind": np.full(n, kind), "chunk": chunk, "at": at}
        names = [c.split()[0] for c in _RESOLVED.split(", ")]
        arrays = []
        for name in names:
            c, t = columns.get(name), kinds.get(name, pa.int64())
            arrays.append(pa.nulls(n, t) if c is None else pa.array(c).cast(t))
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return routed.groupBy("bucket").applyInArrow(bucket, _RESOLVED)


def bucket_of(count: Column) -> Column:
    """0 for an unseen context, else 1 + the whole part of log2 of its frequency."""
    return F.when(count > 0, 1 + F.length(F.bin(count)) - 1).otherwise(0)


@dataclass
class Model:
    tokens: int
    distinct: int
    weights: np.ndarray  # a row a bucket: of the pair, the word, and all words alike

    def column(self, cvw: Column, cv: Column, cw: Column) -> Column:
        """log10 P of one occurrence."""
        w = [F.array(*[F.lit(float(x)) for x in self.weights[:, k]]) for k in range(3)]
        at = lambda k: F.element_at(w[k], F.least(bucket_of(cv), F.lit(len(self.weights) - 1)) + 1)
        pair = F.when(cv > 0, cvw / cv).otherwise(0.0)
        return F.log10(at(0) * pair + at(1) * (cw / max(self.tokens, 1)) + at(2) / (self.distinct + 1))

    def logs(self, cvw: np.ndarray, cv: np.ndarray, cw: np.ndarray) -> np.ndarray:
        """The same for arrays of frequent pairs."""
        w = self.weights[np.minimum(buckets_of(cv), len(self.weights) - 1)]
        return np.log10(w[:, 0] * cvw / np.maximum(cv, 1) + w[:, 1] * cw / max(self.tokens, 1) + w[:, 2] / (self.distinct + 1))


def buckets_of(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, 1 + np.floor(np.log2(np.maximum(count, 1))).astype(np.int64), 0)


def learn_weights(b: np.ndarray, n: np.ndarray, p2: np.ndarray, p1: np.ndarray, p0: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of each bucket by EM over deleted occurrences: ``n`` of them with estimates p2, p1 and p0 in bucket ``b``.

    Buckets start from, and with few occurrences lean to, the weights of all occurrences together.
    """
    size = int(b.max()) + 1 if len(b) else 1

    def fit(rows: np.ndarray, start: np.ndarray, lean: float) -> np.ndarray:
        w = start
        estimates = np.stack([p2[rows], p1[rows], np.full(rows.sum(), p0)], 1)
        for _ in range(rounds):
            share = estimates * w
            got = (n[rows, None] * share / np.maximum(share.sum(1, keepdims=True), 1e-300)).sum(0) + lean * start
            w = got / got.sum()
        return w

    alike = np.full(3, 1 / 3)
    whole = fit(np.ones(len(b), bool), alike, 1.0) if len(b) else alike
    out = np.stack([fit(b == k, whole, 10.0) for k in range(size)])
    out[0] = np.array([0, *out[0, 1:]]) / out[0, 1:].sum()  # an unseen context has no pairs
    return out


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words, A-Z lower-cased, and an end after each text. base_score adds up one to each word's count
    in the training documents; score is the model's log10 probability. A null or blank text is one end. A row
    without an id is a training document; repeated rows each count and are scored alike. Without training
    documents all counts are 0. An empty table gives no rows.
    """
    held_out, part = parts(F.col("doc_id"))
    text = F.col("text").cast("string")
    docs = docs.select("doc_id", held_out.alias("held_out"), part.alias("part"), text.alias("text"), F.xxhash64("doc_id", text).alias("key"))
    f, total = choose_frequent(docs)
    tokens, kept_tokens = count_frequent(docs, f)
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_ROWS)
    found = materialize(resolve(route(docs, f, buckets), f, kept_tokens), "occurrences")
    kind = F.col("kind")

    rare_words = found.where(kind == _WORD).select("v", F.col("cw").alias("v_count"), F.col("kept_cw").alias("v_kept"))
    count = lambda c: F.coalesce(c, F.lit(0))
    open_rows = (
        found.where(kind == _OPEN).join(rare_words, "v", "left")
        .select("chunk", "at", "cvw", count("v_count").alias("cv"), "cw", "kept_cvw", count("v_kept").alias("kept_cv"), "kept_cw")
    )
    distinct = int((f.word_counts[f.words != _START, 0] > 0).sum()) + rare_words.where("v_count > 0").count()

    # Deleted occurrences by bucket and by their estimates, in bins of an eighth of an octave: a bounded table.
    p2 = F.when(F.col("kept_cv") > 0, F.col("kept_cvw") / F.col("kept_cv")).otherwise(0.0)
    deleted = open_rows.where("kept_cvw IS NOT NULL")
    cells = found.where(kind == _CELL).select(F.col("at").alias("b"), "n", "p2", "p1").unionByName(
        deleted.select(bucket_of(F.col("kept_cv")).alias("b"), F.lit(1.0).alias("n"), p2.alias("p2"), (F.col("kept_cw") / max(kept_tokens, 1)).alias("p1"))
    )
    bins = lambda p: F.coalesce(F.floor(8 * F.log2(F.col(p) / F.col("n"))), F.lit(-10_000))
    cells = cells.groupBy("b", bins("p2"), bins("p1")).agg(F.sum("n").alias("n"), F.sum("p2").alias("p2"), F.sum("p1").alias("p1")).toArrow()
    b, n, e2, e1 = (cells.column(c).to_numpy().astype(float) for c in ("b", "n", "p2", "p1"))
    pairs = f.pair_counts[:, 0] - f.pair_counts[:, 1]
    cv, cw = f.word_counts[f.first, 1], f.word_counts[f.second, 1]
    e2, e1 = np.append(e2 / n, f.pair_counts[:, 1] / np.maximum(cv, 1)), np.append(e1 / n, cw / max(kept_tokens, 1))
    b, n = np.append(b, buckets_of(cv)).astype(np.int64), np.append(n, pairs)
    used = n > 0
    model = Model(tokens, distinct, learn_weights(b[used], n[used], e2[used], e1[used], 1 / (distinct + 1)))

    counted = found.where(kind <= _DONE_RARE).select("chunk", "at", "cvw", "cv", "cw", (kind == _DONE_RARE).alias("rare"))
    counted = counted.unionByName(open_rows.select("chunk", "at", "cvw", "cv", "cw", F.lit(True).alias("rare")))
    rare = F.col("rare")
    sums = counted.select(
        "chunk", "at", model.column(F.col("cvw"), F.col("cv"), F.col("cw")).alias("s"),
        F.when(rare, F.log10(F.col("cw") + 1)).otherwise(0.0).alias("c"), (rare & (F.col("cw") > 0)).cast("long").alias("k"),
    ).groupBy("chunk", "at").agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.sum("k").alias("k"))
    keys = found.where(kind == _KEY).select("chunk", "at", F.col("v").alias("key")).distinct()
    sums = keys.join(sums, ["chunk", "at"]).groupBy("key").agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.sum("k").alias("k"))
    direct = docs.mapInArrow(_direct(f, model), "doc_id {}, held_out boolean, key long, n_tokens long, n_known long, c double, s double".format(docs.schema["doc_id"].dataType.simpleString()))
    direct = materialize(direct, "direct")
    alike = direct.groupBy("key").agg(F.count("*").alias("rows"))
    joined = direct.withColumnsRenamed({"c": "own_c", "s": "own_s"}).join(sums, "key", "left").join(alike, "key")
    per_row = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.col("rows")  # noqa: E731  rows of one key are equal
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + per_row("k").cast("long")).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("own_c") + per_row("c") - F.col("n_tokens") * F.log10(F.lit(float(tokens + distinct + 1)))).alias("base_score"),
        (F.col("own_s") + per_row("s")).alias("score"),
    )


def _direct(f: Frequent, model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What frequent words and pairs add to each document."""
    words, pairs, counts = f.words, f.pairs, f.word_counts[:, 0]
    logs = model.logs(f.pair_counts[:, 0], counts[f.first], counts[f.second]) if len(pairs) else np.zeros(0)
    log_counts = np.log10(counts + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, pair = _Places(words), _Places(pairs)
        for part in W.slices(batches):
            rows = part.num_rows
            context, token, row = _tokens(part.column("text"))
            w, p = word.find(token), pair.find(_pair(context, token))
            has, met = w >= 0, p >= 0
            known = np.bincount(row[has], counts[w[has]] > 0, rows).astype(np.int64)
            columns = [np.bincount(row, minlength=rows), known, *(np.bincount(r, v, rows).astype(float) for r, v in ((row[has], log_counts[w[has]]), (row[met], logs[p[met]])))]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), part.column("key"), *map(pa.array, columns)],
                names=["doc_id", "held_out", "key", "n_tokens", "n_known", "c", "s"],
            )

    return run
