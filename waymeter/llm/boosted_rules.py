"""Quality rules: gradient-boosted trees over document statistics, scored from flat numpy node arrays.

Trees are grown on histograms of a bounded sample of labelled documents; the node arrays, a few kilobytes,
travel with the task and score whole batches. On a constrained feature every split keeps the order of its
children's values, and their subtrees stay on their side of the middle, so a score never rises when such a
feature moves the wrong way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.llm import stats

#: At most so many labelled documents are fitted (the bound of the sample).
SAMPLE_ROWS = 20_000
FOLDS = 5
#: Direction of the quality score in a feature: more symbols, repeats or repeated lines never raise it.
CONSTRAINTS = {"symbol_share": -1, "repeat_share": -1, "dup_line_share": -1, "upper_share": -1, "distinct_share": 1}
#: A document is kept from this probability on: the verdict is meant to spare clean documents.
KEEP_FROM = 0.3
#: Fixed values of the contract: fewest words, and the largest percentage of repeated words.
LEAST_WORDS, MOST_REPEATED = 10, 20


@dataclass
class Trees:
    """All nodes of all trees, one after another. A leaf has feature -1 and its value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                low = x[rows, np.maximum(f, 0)] <= self.threshold[node]
                node = np.where(inner, np.where(low, self.left[node], self.right[node]), node)
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, signs: np.ndarray, *, trees: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 64,
    least: int = 20, ridge: float = 1.0,
) -> Trees:
    """Boosting for the logistic loss with second-order leaf values and monotonic constraints ``signs``.

    Without rows, or with one class only, the model is a constant: the smoothed share of label 1.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    code = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1) if len(x) else x.astype(int)

    def add(value: float) -> int:
        for k, v in (("feature", -1), ("threshold", 0.0), ("left", 0), ("right", 0), ("value", value)):
            nodes[k].append(v)
        return len(nodes["value"]) - 1

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        total_g, total_h = g[rows].sum(), h[rows].sum()
        at = add(rate * float(np.clip(total_g / (total_h + ridge), low, high)))
        if level == depth or len(rows) < 2 * least:
            return at
        best = (1e-6, -1, 0, 0.0, 0.0)
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            n, gs, hs = (np.cumsum(np.bincount(code[rows, f], w, len(cut) + 1))[:-1] for w in (None, g[rows], h[rows]))
            l, r = np.clip(gs / (hs + ridge), low, high), np.clip((total_g - gs) / (total_h - hs + ridge), low, high)
            gain = (2 * gs * l - (hs + ridge) * l * l) + (2 * (total_g - gs) * r - (total_h - hs + ridge) * r * r)
            whole = np.clip(total_g / (total_h + ridge), low, high)
            gain -= 2 * total_g * whole - (total_h + ridge) * whole * whole
            gain[(n < least) | (len(rows) - n < least) | (signs[f] * (r - l) < 0)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k, float(l[k]), float(r[k]))
        _, f, k, l, r = best
        if f < 0:
            return at
        middle, goes = (l + r) / 2, code[rows, f] <= k
        lows, highs = (low, high), (low, high)
        if signs[f]:
            lows, highs = ((low, middle), (middle, high)) if signs[f] > 0 else ((middle, high), (low, middle))
        nodes["feature"][at], nodes["threshold"][at] = f, float(cuts[f][k])
        nodes["left"][at] = grow(rows[goes], g, h, level + 1, *lows)
        nodes["right"][at] = grow(rows[~goes], g, h, level + 1, *highs)
        return at

    def model() -> Trees:
        a = {k: np.array(v, np.int64 if k in ("feature", "left", "right") else float) for k, v in nodes.items()}
        return Trees(**a, roots=np.array(roots, np.int64), base=base, depth=depth)

    if not len(y) or y.min() == y.max():
        return model()
    raw = np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        roots.append(grow(np.arange(len(y)), y - p, p * (1 - p), 0, -np.inf, np.inf))
        one = model()
        one.roots, one.base = one.roots[-1:], 0.0
        raw += one.raw(x)
    return model()


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Trees:
    x, y = stats.labelled_sample(docs, labels, label, rows, FOLDS)
    return fit(x, y, np.array([CONSTRAINTS.get(n, 0) for n in stats.FEATURES]))


VERDICT = T.StructType([*stats.COUNTS_TYPE.fields, T.StructField("score", T.DoubleType())])


def judge(docs: DataFrame, trees: Trees, name: str) -> DataFrame:
    """``docs`` with a struct ``name``: the counts, score, base_failed and kept. No shuffle.

    base_failed: fewer than 10 words, or more than 20 % of the words in repeated windows. kept: not failed, and
    the trees' probability is at least KEEP_FROM. A null text has no words, so it fails. Rows are judged one by
    one: repeated rows and null ids pass through, an empty table gives none.
    """

    def score(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
        counts = stats.count(offsets, data)
        columns = {k: v.astype(np.int64) for k, v in counts.items()}
        return stats.struct(columns | {"score": trees.probability(stats.ratios(counts))})

    out = stats.append(docs, name, VERDICT, score)
    s = F.col(f"`{name}`")
    failed = (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEATED * s["n_words"])
    return out.withColumn(name, s.withField("base_failed", failed).withField("kept", ~failed & (s["score"] >= KEEP_FROM)))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    name = stats.unused(docs, "_verdict")
    return judge(docs, train(docs, labels), name).where(F.col(f"`{name}`.kept")).drop(name)
