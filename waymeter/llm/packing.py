"""Packing: order-preserving cuts of the token stream, chosen by dynamic programming with a monotone queue.

The documents of a Spark partition form one stream of ids in their order. A window holds at most ``size`` ids
and may end at a document's end for free, at a sentence's end for a small penalty and, so that any text can be
cut, at every ``HARD_STEP`` ids of a longer sentence for a larger one. With positions p and best costs d,

    d[i] = penalty[i] + min over p[i] - p[j] <= size of d[j] + size - (p[i] - p[j]),

whose inner term d[j] + p[j] does not depend on i, so the minimum moves along in a monotone queue.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.llm import words as W

TOKENIZER = "word_bpe_49k.json"
SIZE, END_ID = 2048, 1
SENTENCE_PENALTY, HARD_PENALTY, HARD_STEP = 6.0, 48.0, 64
#: Ids gathered before the stream so far is cut; the last window stays open for the ids that follow.
STRETCH = 64 * SIZE
#: Words whose ids a task remembers.
REMEMBERED = 300_000
#: Bytes of text encoded at once: repeated words of a slice are encoded once.
SLICE_BYTES = 2 << 20

PIECES = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
)
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True
_AFTER_LATIN = "\u0250"
#: Byte-level tokenizers name printable bytes of Latin-1 by themselves, and the others by the code points from 256.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_NAMES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_KINDS = np.zeros(256, np.int8)
_KINDS[[b for b in range(128) if chr(b).isalpha()]] = 1
_KINDS[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = 2


@cache
def _cuts_words(path: str) -> bool:
    """Whether a tokenizer file cuts texts as the default one does, so that the ids of its parts are those of a text."""
    import public_tokenizers

    def rules(file: str) -> dict:
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = {k: v for k, v in spec["model"].items() if k not in ("vocab", "merges")}
        return {k: spec.get(k) for k in ("normalizer", "pre_tokenizer", "truncation", "padding")} | {"model": model}

    return rules(path) == rules(public_tokenizers.path(TOKENIZER))


class Encoder:
    """Token ids of many texts. Ids of a text are those of its parts, one after another.

    Parts are cut at blanks, and between an ASCII letter and an ASCII mark: there the tokenizer always cuts.
    Marks of its special tokens and the apostrophe of its endings do not cut.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.by_parts = _cuts_words(path)
        self.known: dict[int, bytes] = {}

    def ids_of(self, parts: list[str]) -> list[bytes]:
        """32-bit ids of each part.

        A part of Latin letters is a single word to the tokenizer: its model takes it lower-cased, byte by byte.
        """
        out, rest = [b""] * len(parts), []
        tokenize = self.tokenizer.model.tokenize
        for k, part in enumerate(parts):
            low = part.lower()
            if low.isalpha() and max(low) < _AFTER_LATIN:
                if not low.isascii():
                    low = low.encode().decode("latin-1").translate(_BYTE_NAMES)
                out[k] = array("I", [t.id for t in tokenize(low)]).tobytes()
            else:
                rest.append(k)
        for k, e in zip(rest, self.tokenizer.encode_batch_fast([parts[k] for k in rest], add_special_tokens=False), strict=True):
            out[k] = array("I", e.ids).tobytes()
        return out

    def _encode_whole(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same by any tokenizer, each text as a whole."""
        raw = data.tobytes()
        texts = [str(raw[a:b], "utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        counts = np.array([len(e.ids) for e in found], np.int64)
        ids = np.concatenate([np.zeros(0, np.uint32), *[np.array(e.ids, np.uint32) for e in found]])
        closes = np.array([text[b - 1 : b] in (".", "!", "?") for text, e in zip(texts, found, strict=True) for _, b in e.offsets], bool)
        return ids, np.repeat(np.arange(len(texts)), counts), np.flatnonzero(closes) + 1

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, row of each id, ends: ids after which a sentence ends)."""
        if not self.by_parts:
            return self._encode_whole(offsets, data)
        s = W.spans(offsets, data, kinds=_KINDS)
        bars = np.flatnonzero(data == ord("|"))
        if len(bars):  # may be a special token, whose case matters
            at = np.unique(np.searchsorted(s.start, bars, "right") - 1)
            s.hash[at] = W.mix(W.spans(offsets, data, lower=False, kinds=_KINDS).hash[at], 9)
        order = np.argsort(s.hash)
        opens = np.append(True, s.hash[order][1:] != s.hash[order][:-1])[: len(order)]
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(opens) - 1
        first = order[opens]
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, keys = self.known, s.hash[first].tolist()
        new = [k for k, v in enumerate(keys) if v not in known]
        raw = data.tobytes()
        where = zip(s.start[first[new]].tolist(), s.end[first[new]].tolist(), strict=True)
        known.update(zip([keys[k] for k in new], self.ids_of([str(raw[a:b], "utf-8", "replace") for a, b in where]), strict=True))
        each = [known[k] for k in keys]
        lengths = np.fromiter(map(len, each), np.int64, len(each)) // 4
        flat = np.frombuffer(b"".join(each), np.uint32)
        starts = np.cumsum(lengths) - lengths
        n = lengths[at]
        ends = np.cumsum(n)
        ids = flat[np.repeat(starts[at] - (ends - n), n) + np.arange(n.sum())]
        closes = _ENDS[data[s.end - 1]] if len(s.end) else np.zeros(0, bool)
        return ids, np.repeat(s.row, n), ends[closes & (n > 0)]


def cuts(positions: np.ndarray, penalty: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Positions that end a window, of least total padding plus penalties.

    ``positions`` rise from 0 to the stream's end with steps of at most ``size``; the last one always ends a window.
    """
    p, fee = positions.tolist(), penalty.tolist()
    best, back = [0.0] * len(p), [0] * len(p)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for i in range(1, len(p)):
        here = p[i]
        while p[queue[0][1]] < here - size:
            queue.popleft()
        value, j = queue[0]
        cost = value + size - here + fee[i]
        best[i], back[i] = cost, j
        value = cost + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
    out, i = [], len(p) - 1
    while i:
        out.append(p[i])
        i = back[i]
    return np.array(out[::-1], np.int64)


def boundaries(length: int, docs: np.ndarray, sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, penalties) for ``cuts``: ends of documents, of sentences, and steps in longer stretches."""
    fee = np.full(length + 1, np.inf)
    fee[sentences] = SENTENCE_PENALTY
    fee[docs] = 0.0
    fee[[0, length]] = 0.0
    at = np.flatnonzero(np.isfinite(fee))
    gaps = np.diff(at)
    for k in np.flatnonzero(gaps > 2 * HARD_STEP):
        fee[at[k] + HARD_STEP : at[k + 1] - 1 : HARD_STEP] = HARD_PENALTY
    at = np.flatnonzero(np.isfinite(fee))
    return at, fee[at]


class Stream:
    """The ids of a partition that no finished window holds yet."""

    def __init__(self, partition: int, size: int):
        self.size, self.next = size, partition << 40
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)  # of documents, in self.ids; below 0 where a part has left
        self.doc_ids: list = []
        self.ends = np.zeros(0, np.int64)  # of sentences

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray, sentences: np.ndarray) -> None:
        base = len(self.ids)
        self.starts = np.concatenate([self.starts, base + np.cumsum(counts) - counts])
        self.ends = np.concatenate([self.ends, base + sentences])
        self.ids = np.concatenate([self.ids, ids])
        self.doc_ids += doc_ids

    def pieces(self, last: bool) -> dict[str, list] | None:
        """Pieces of the windows that are finished now; all of them if this is the stream's end."""
        total = len(self.ids)
        if not total:
            return None
        doc_ends = np.append(self.starts[1:], total)
        found = cuts(*boundaries(total, doc_ends[doc_ends > 0], self.ends[self.ends > 0]), self.size)
        if not last:
            found = found[:-1]
        if not len(found):
            return None
        done = int(found[-1])
        opens = np.append(0, found[:-1])
        begin = np.union1d(opens, self.starts[(self.starts > 0) & (self.starts < done)])
        end = np.append(begin[1:], done)
        doc = np.searchsorted(self.starts, begin, "right") - 1
        window = np.searchsorted(opens, begin, "right") - 1
        ids = self.ids.astype("<u4")
        spans = [ids[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        out = {
            "doc_id": [self.doc_ids[k] for k in doc],
            "start": begin - self.starts[doc],
            "length": end - begin,
            "ids_crc32": [zlib.crc32(x.tobytes()) for x in spans],
            "doc_tokens": (doc_ends - self.starts)[doc],
            "sequence_id": self.next + window,
            "offset": begin - opens[window],
            "ids": pa.ListArray.from_arrays(pa.array(np.append(begin, done), pa.int32()), pa.array(ids[:done].view(np.int32))),
        }
        self.next += len(found)
        k = int(np.searchsorted(doc_ends, done, "right"))
        self.starts, self.doc_ids = self.starts[k:] - done, self.doc_ids[k:]
        self.ids, self.ends = self.ids[done:], self.ends[self.ends > done] - done
        return out


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in its sequence, and its ids.

    ``tokenizer`` is a tokenizer file that every worker can read; one that cuts texts in another way than the default encodes each
    text as a whole. A document's ids are followed by END_ID, so a
    null or empty text is a piece of one id. Documents keep the order of their partition; nothing is shuffled,
    and each partition ends with at most one open sequence. Repeated rows are packed as often as they occur, a
    null id is carried, an empty table gives no rows, other columns are dropped. A task holds ``STRETCH`` ids
    plus one slice of texts or one text. ``sequence_id`` is the partition's number and a count.
    """
    schema = PIECES.format(id=docs.schema["doc_id"].dataType.simpleString())
    if not with_ids:
        schema = schema.removesuffix(", ids array<int>")
    kind = pa.RecordBatch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        encoder, stream = Encoder(path), Stream(TaskContext.get().partitionId(), size)

        def out(found: dict, id_type: pa.DataType) -> pa.RecordBatch:
            if not with_ids:
                found.pop("ids")
            arrays = [pa.array(v, id_type if n == "doc_id" else pa.int64()) if n != "ids" else v for n, v in found.items()]
            return kind.from_arrays(arrays, names=list(found))

        id_type = pa.int64()
        for part in W.slices(batches, size=SLICE_BYTES):
            id_type = part.schema.field("doc_id").type
            ids, row, ends = encoder.encode(*W.buffers(part.column("text")))
            counts = np.bincount(row, minlength=part.num_rows) + 1
            whole = np.full(len(ids) + part.num_rows, END_ID, np.uint32)
            whole[np.arange(len(ids)) + row] = ids
            ends = ends + row[ends - 1] if len(ends) else ends
            stream.add(part.column("doc_id").to_pylist(), whole, counts, ends)
            if len(stream.ids) > STRETCH and (found := stream.pieces(False)):
                yield out(found, id_type)
        if found := stream.pieces(True):
            yield out(found, id_type)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
