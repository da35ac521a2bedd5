from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_words import words
from pyspark.sql import functions as F

from waymeter.llm import boosted_rules as B
from waymeter.llm import queries, rule_ensemble, stats
from waymeter.llm import words as W


def base(text):
    w = words(text, lower=False)
    lines = [x for x in (text or "").split("\n") if words(x)]
    runs = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    often = Counter(runs)
    hit = {j for k, r in enumerate(runs) if often[r] > 1 for j in range(k, k + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_counts_equal_a_plain_restatement(given, odd):
    for df in (given("documents"), odd):
        texts = [r.text for r in df.select("text").collect()]
        c = stats.count(*W.buffers(pa.array(texts, pa.string())))
        assert [tuple(int(c[n][k]) for n in stats.COUNTS[:5]) for k in range(len(texts))] == [base(t) for t in texts]


def test_query_judges_every_document(spark, given):
    got = {r.doc_id: r for r in queries.op10_boosted_rules(spark, "/root/testdata/sf0.001").collect()}
    docs = {r.doc_id: r.text for r in given("documents").collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        n, chars, symbols, lines, repeated = base(t)
        r = got[i]
        failed = n < 10 or 100 * repeated > 20 * n
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (n, chars, symbols, lines, repeated, failed)
        assert not (failed and r.kept)


def held_out_accuracy(df, labels, verdict):
    rows = df.join(labels, "doc_id").where(stats.part_of(F.col("doc_id"), 5) == 0).select(verdict.alias("p"), "quality").collect()
    return np.mean([r.p == (r.quality == 1) for r in rows])


def test_trees_and_rules_tell_held_out_documents_apart(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = B.judge(docs, B.train(docs, labels), "v")
    assert held_out_accuracy(judged, labels, F.col("v.score") >= B.KEEP_FROM) > 0.95
    scored = rule_ensemble.score(docs, rule_ensemble.train(docs, labels), "s")
    assert held_out_accuracy(scored, labels, F.col("s") >= rule_ensemble.THRESHOLD) > 0.95
    assert scored.where("s IS NULL OR s < 0 OR s > 1").count() == 0


def test_constraints_hold_everywhere():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 3))
    y = ((x[:, 0] + 0.5 * np.sin(9 * x[:, 0]) - x[:, 1] + 0.3 * rng.standard_normal(2000)) > 0.1).astype(float)
    signs = np.array([1, -1, 0])
    m = B.fit(x, y, signs)
    grid = np.linspace(0, 1, 200)
    for f in (0, 1):
        for point in rng.random((20, 3)):
            rows = np.repeat(point[None], 200, 0)
            rows[:, f] = grid
            assert (np.diff(m.raw(rows)) * signs[f] >= -1e-12).all()
    assert ((m.probability(x) > 0.5) == (y == 1)).mean() > 0.75


def test_models_without_rows_or_with_one_class_are_constant(spark):
    none = B.fit(np.zeros((0, 11)), np.zeros(0), np.zeros(11))
    assert none.probability(np.zeros((2, 11))).tolist() == [0.5, 0.5]
    one = B.fit(np.ones((8, 11)), np.ones(8), np.zeros(11))
    assert np.allclose(one.probability(np.ones((1, 11))), 0.9)
    assert rule_ensemble.fit(spark, np.zeros((0, 11)), np.zeros(0)).rules == ()


def test_columns_of_statistics_equal_the_arrays(spark, odd):
    rows = stats.with_counts(odd, "counts").select("text", "counts.*", *[v.alias(k) for k, v in stats.ratio_columns(F.col("counts")).items()]).collect()
    c = stats.count(*W.buffers(pa.array([r.text for r in rows], pa.string())))
    assert np.allclose(stats.ratios(c), [[r[n] for n in stats.FEATURES] for r in rows])


def test_stages_keep_columns_and_survive_empty_tables(given, odd):
    labels = given("labels")
    for module in (B, rule_ensemble):
        assert module.keep(odd, labels).columns == odd.columns
        assert module.keep(odd.limit(0), labels.limit(0)).count() == 0
        twice = labels.unionByName(labels).withColumn("n_words", F.lit(1))
        module.keep(odd, twice).count()


def test_flat_trees_equal_a_recursive_walk():
    rng = np.random.default_rng(4)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    m = B.fit(x, y, np.array([0, 0, 1, -1]), trees=7)

    def walk(node, row):
        if m.feature[node] < 0:
            return m.value[node]
        return walk(m.left[node] if row[m.feature[node]] <= m.threshold[node] else m.right[node], row)

    points = rng.random((200, 4)) * 1.2 - 0.1
    assert len(m.roots) == 7 and (m.feature >= 0).any()
    assert np.allclose(m.raw(points), [m.base + sum(walk(r, p) for r in m.roots) for p in points])


def test_the_first_tree_splits_where_brute_force_does():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 20, (400, 2)).astype(float)
    y = (x[:, 1] + rng.normal(0, 4, 400) > 11).astype(float)
    m = B.fit(x, y, np.zeros(2), trees=1, depth=1, rate=1.0)
    p = 1 / (1 + np.exp(-m.base))
    g, h = y - p, np.full(400, p * (1 - p))
    part = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + 1)
    best = max(
        (part(low) + part(~low), f, t)
        for f in (0, 1) for t in np.unique(x[:, f]) for low in [x[:, f] <= t]
        if low.sum() >= 20 and (~low).sum() >= 20
    )
    root = m.roots[0]
    low = x[:, m.feature[root]] <= m.threshold[root]
    assert part(low) + part(~low) == np.float64(best[0]) or np.isclose(part(low) + part(~low), best[0])
    for rows, leaf in ((low, m.left[root]), (~low, m.right[root])):
        assert np.isclose(m.value[leaf], g[rows].sum() / (h[rows].sum() + 1))


def test_rules_are_the_paths_of_the_forest_and_the_column_adds_their_weights(spark):
    rng = np.random.default_rng(8)
    x = rng.random((400, len(stats.FEATURES)))
    y = ((x[:, 0] > 0.6) | (x[:, 3] < 0.2)).astype(float)
    e = rule_ensemble.fit(spark, x, y, trees=3, depth=2)
    assert e.rules and len(set(e.rules)) == len(e.rules)
    met = lambda rule, row: all((row[c.feature] > c.value) == c.above for c in rule)
    want = [1 / (1 + np.exp(-(e.intercept + sum(w for r, w in zip(e.rules, e.weights, strict=True) if met(r, row))))) for row in x]
    df = spark.createDataFrame([v.tolist() for v in x], ", ".join(f"{n} double" for n in stats.FEATURES))
    got = df.select(e.column({n: F.col(n) for n in stats.FEATURES}).alias("p"), *stats.FEATURES).collect()
    found = {tuple(r)[1:]: r.p for r in got}
    assert np.allclose([found[tuple(v)] for v in x.tolist()], want)
    assert np.mean((np.array(want) > 0.5) == (y == 1)) > 0.95

    # The weights are a minimum of the penalised loss: no step along a single weight lowers it.
    marks = np.array([[met(r, row) for r in e.rules] for row in x], float)

    def loss(w):
        z = e.intercept + marks @ w
        return np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z)))) + 0.0003 * np.abs(w).sum()

    w = np.array(e.weights)
    least = min(loss(w + d * np.eye(len(w))[k]) for k in range(len(w)) for d in (-0.3, -0.05, 0.05, 0.3))
    assert loss(w) <= least + 2e-3
