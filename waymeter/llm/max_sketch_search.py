"""Ranked lexical search over hashed max-sketches.

A document's sketch has a cell for each value of a hash; a cell holds the largest impact of the document's terms that fall in it.
A document's impacts differ by term frequency alone and grow with it, so a cell keeps the frequency and the impact is
worked out at lookup, when the lengths of all documents are known. The cells of a query's terms, times their weights, add up
to a bound that no score exceeds. For a batch of queries that is one matrix product a block of documents.

Bounds of all documents pick the likeliest for each query, and their exact scores give a first threshold: as many
documents have it at least as are asked for. Then documents are rescored from their texts in descending order of
bounds, and the threshold rises, until no bound reaches it. Only the best of each task are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymeter.llm import words as W
from waymeter.session import materialize

#: Cells of a sketch: the power of two from CELLS_PER_TERM times the distinct terms on, within these limits. More cells only sharpen bounds.
CELLS_PER_TERM, LEAST_CELLS, MOST_CELLS = 8, 64, 8192
#: Queries handled at once: at most so many, and so many bytes of their texts (or one longer text).
BLOCK_ITEMS, BLOCK_BYTES = 256, 1 << 20
#: Documents with the highest bounds of each query whose exact scores give the first threshold.
SEEDS = 64
#: Text whose terms are counted before the counts are handed on, and documents of one matrix product.
CHUNK_BYTES, PRODUCT_ROWS = 8 << 20, 128
#: Steps in which the documents of a slice are rescored, best bounds first.
STEPS = 4
TOP = 20

_INDEX = "doc_id long, n long, cells binary, text string, terms binary, counts binary"


def terms(texts: pa.Array) -> W.Spans:
    """Runs of ASCII letters and digits and all other non-ASCII characters, A-Z lower-cased."""
    return W.spans(*W.buffers(texts), W.ALNUM_BYTES)


def frequencies(s: W.Spans) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, frequency) of the distinct terms of each text."""
    order = np.lexsort((s.hash, s.row))
    row, h = s.row[order], s.hash[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    return row[first], h[first], np.diff(np.append(first, len(row)))


def index(docs: DataFrame) -> DataFrame:
    """A row per document (doc_id, n: terms, cells: its sketch, text), and rows of (terms, counts): documents by term, in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _INDEX.split(", ")]
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.string())]
            return pa.RecordBatch.from_arrays([*none, pa.array([found.tobytes()], pa.binary()), pa.array([n.astype(np.uint32).tobytes()], pa.binary())], names=names)

        for part in W.slices(batches):
            s = terms(part.column("text"))
            row, h, tf = frequencies(s)
            distinct = np.bincount(row, minlength=part.num_rows)
            cells = 1 << np.ceil(np.log2(np.clip(distinct * CELLS_PER_TERM, LEAST_CELLS, MOST_CELLS))).astype(np.int64)
            ends = np.append(0, np.cumsum(cells))
            sketch = np.zeros(ends[-1], np.uint8)
            np.maximum.at(sketch, ends[row] + (h & (cells[row] - 1).astype(np.uint64)).astype(np.int64), np.minimum(tf, 255).astype(np.uint8))
            arrays = pa.BinaryArray.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(sketch)])
            none = pa.nulls(part.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s.count), arrays, part.column("text"), none, none], names=names)
            held.append(h)
            size += part.column("text").nbytes
            if size >= CHUNK_BYTES:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _INDEX)


@dataclass
class Block:
    """Some queries: their distinct terms, sorted, and for each the queries that have it, how often, and the term's weight."""

    known: np.ndarray
    first: np.ndarray  # postings of a term: first[t] : first[t + 1]
    item: np.ndarray
    times: np.ndarray
    items: int
    weight: np.ndarray
    tokens: int = 0  # L and N of the documents
    docs: int = 0

    @classmethod
    def of(cls, texts: list[str | None]) -> Block:
        row, h, n = frequencies(terms(pa.array(texts, pa.large_string())))
        order = np.argsort(h, kind="stable")
        known, first = np.unique(h[order], return_index=True)
        return cls(known, np.append(first, len(h)), row[order], n[order].astype(np.float64), len(texts), np.zeros(len(known)))

    def matrix(self, cells: int) -> np.ndarray:
        """(cells, queries): weights of the query's terms in a cell."""
        out = np.zeros((cells, self.items))
        at = np.repeat((self.known & np.uint64(cells - 1)).astype(np.int64), np.diff(self.first))
        np.add.at(out, (at, self.item), self.times * np.repeat(self.weight, np.diff(self.first)))
        return out

    def length(self, n: np.ndarray) -> np.ndarray:
        """The measure m of documents of n terms."""
        return 100 - 25 + (25 * n * self.docs) // max(self.tokens, 1)

    def scores(self, texts: pa.Array, n: np.ndarray) -> np.ndarray:
        """(texts, queries): exact scores, whole numbers below 2^53."""
        row, h, tf = frequencies(terms(texts))
        at = np.minimum(np.searchsorted(self.known, h), max(len(self.known) - 1, 0))
        has = self.known[at] == h if len(self.known) else np.zeros(len(h), bool)
        row, at, tf = row[has], at[has], tf[has]
        value = impact(tf, self.length(n)[row]) * self.weight[at]
        size = np.diff(self.first)[at]
        ends = np.cumsum(size)
        posting = np.repeat(self.first[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        place = np.repeat(row, size) * self.items + self.item[posting]
        return np.bincount(place, np.repeat(value, size) * self.times[posting], len(texts) * self.items).reshape(len(texts), self.items)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Bounds:
    """Upper bounds of the scores of documents for the queries of a block."""

    def __init__(self, block: Block):
        self.block, self.matrices = block, {}

    def of(self, n: np.ndarray, cells: pa.Array) -> np.ndarray:
        ends, data = W.buffers(cells)
        size = np.diff(ends)
        out = np.zeros((len(n), self.block.items))
        m = self.block.length(n)
        for c in np.unique(size):
            if c not in self.matrices:
                self.matrices[c] = self.block.matrix(int(c))
            same = np.flatnonzero(size == c)
            for start in range(0, len(same), PRODUCT_ROWS):
                mine = same[start : start + PRODUCT_ROWS]
                tf = data[ends[mine][:, None] + np.arange(c)].astype(np.int64)
                value = impact(tf, m[mine][:, None])
                value[tf == 255] = 1_000_000  # more than any frequency gives
                out[mine] = value.astype(np.float64) @ self.matrices[c]
        return out


class Best:
    """The best ``k`` of each query so far: higher scores, then lower doc_ids, null last."""

    def __init__(self, items: int, k: int, least: np.ndarray):
        self.k, self.items, self.least = k, items, least.copy()
        self.rows = tuple(np.zeros(0, t) for t in (np.int64, np.float64, np.int64, bool))

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, missing: np.ndarray) -> None:
        item, score, doc, missing = (np.concatenate(x) for x in zip(self.rows, (item, score, doc, missing), strict=True))
        order = np.lexsort((doc, missing, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.k - 1
        full = item[last]
        self.least[full] = np.maximum(self.least[full], score[order[last]])
        kept = place < self.k
        order = order[kept]
        self.rows = item[kept], score[order], doc[order], missing[order]


def _likeliest(documents: DataFrame, block: Block) -> DataFrame:
    """(row) of the documents that are among the SEEDS highest bounds of a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, best = Bounds(block), Best(block.items, SEEDS, np.full(block.items, 1.0))
        for part in W.slices(batches, "cells", 4 * W.SLICE_BYTES):
            b = bounds.of(part.column("n").to_numpy(), part.column("cells"))
            doc, item = np.nonzero(b >= best.least)
            best.add(item, b[doc, item], part.column("row").to_numpy()[doc], np.zeros(len(doc), bool))
        yield pa.RecordBatch.from_arrays([pa.array(best.rows[0]), pa.array(best.rows[1]), pa.array(best.rows[2])], names=["item", "bound", "row"])

    found = documents.select("row", "n", "cells").mapInArrow(run, "item long, bound double, row long")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SEEDS).select("row").distinct()


_FOUND = "item long, score double, doc_id long"


def _rescored(documents: DataFrame, block: Block, k: int, least: np.ndarray) -> DataFrame:
    """(item, score, doc_id): each task's best ``k`` of each query with scores from ``least`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, best = Bounds(block), Best(block.items, k, np.maximum(least, 1.0))
        for part in W.slices(batches):
            n, doc_id = part.column("n").to_numpy(), part.column("doc_id")
            missing = doc_id.is_null().to_numpy(zero_copy_only=False)
            ids = doc_id.fill_null(0).to_numpy()
            b = bounds.of(n, part.column("cells"))
            order = np.argsort(-(b / best.least).max(1), kind="stable")
            for step in np.array_split(order, STEPS):
                step = step[(b[step] >= best.least).any(1)]
                if not len(step):
                    continue
                score = block.scores(part.column("text").take(pa.array(step)), n[step])
                at, item = np.nonzero((b[step] >= best.least) & (score >= best.least))
                best.add(item, score[at, item], ids[step[at]], missing[step[at]])
        item, score, doc, missing = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(score), pa.array(doc, mask=missing)], names=["item", "score", "doc_id"])

    return documents.select("doc_id", "n", "cells", "text").mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _weights(parts: DataFrame, known: np.ndarray, docs: int) -> np.ndarray:
    """The weight of each known term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(known), np.int64)
        for batch in batches:
            for h, n in zip(batch.column("terms"), batch.column("counts"), strict=True):
                h, n = np.frombuffer(h.as_buffer(), np.uint64), np.frombuffer(n.as_buffer(), np.uint32)
                at = np.minimum(np.searchsorted(h, known), max(len(h) - 1, 0))
                if len(h):
                    df += np.where(h[at] == known, n[at], 0)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["at", "df"])

    rows = parts.mapInArrow(run, "at long, df long").groupBy("at").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(known), np.int64)
    df[rows.column("at").to_numpy()] = rows.column("df").to_numpy()
    return np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1)))


def _blocks(items: DataFrame, key: str) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in items.select(key, "text").toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1] or "")
        if len(held) == BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "item_id") -> DataFrame:
    """(``key``, rank, doc_id, score): the ``k`` best documents of each row of ``items`` (``key``, text) with scores above 0.

    Equal scores go by ascending doc_id, null last; rows that repeat an id are documents of their own. Null and blank texts have no
    terms: such documents are not counted and never found, such queries find nothing. A repeated query is answered each time. Other
    columns are not read. Without documents or queries there are no rows. Queries pass the driver in blocks of BLOCK_ITEMS or BLOCK_BYTES; a
    task holds a block's weights by cell (34 MB for 256 queries), and about 60 times a slice of 1 MB of text or one longer text.
    """
    spark = docs.sparkSession
    stored = materialize(index(docs).withColumn("row", F.monotonically_increasing_id()), "sketches")
    documents, parts = stored.where("terms IS NULL"), stored.where("terms IS NOT NULL").select("terms", "counts")
    n, tokens = documents.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    documents = documents.where("n > 0")
    kind = items.schema[key].dataType.simpleString()
    out = spark.createDataFrame([], f"{key} {kind}, rank int, doc_id long, score long")
    for held in _blocks(items, key):
        block = Block.of([text for _, text in held])
        if not len(block.known):
            continue
        block.docs, block.tokens = n, tokens
        block.weight = _weights(parts, block.known, n)
        likely = documents.join(F.broadcast(_likeliest(documents, block)), "row", "left_semi")  # at most BLOCK_ITEMS * SEEDS rows
        last = _ranked(_rescored(likely, block, k, np.ones(block.items)), k).where(F.col("rank") == k).select("item", "score").toArrow()
        least = np.ones(block.items)
        least[last.column("item").to_numpy()] = last.column("score").to_numpy()
        ids = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(held)], f"item long, {key} {kind}")
        best = _ranked(materialize(_rescored(documents, block, k, least), "best"), k).join(F.broadcast(ids), "item")
        out = out.unionByName(best.select(key, "rank", "doc_id", F.col("score").cast("long").alias("score")))
    return out
