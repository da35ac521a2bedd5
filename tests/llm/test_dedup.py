from __future__ import annotations

import random

import pytest
from llm_words import grouped, words
from pyspark.sql import functions as F

from waymeter.llm import minhash_dedup as M
from waymeter.llm.components import components


def brute(rows, size):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets.setdefault(i, []).append(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    flat = [(i, s) for i, many in sets.items() for s in many if s]
    links = [
        (a, b) for k, (a, x) in enumerate(flat) for b, y in flat[:k] if a != b and 100 * len(x & y) >= 80 * len(x | y)
    ]
    return sets, grouped(links, sets)


def check(df, size):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    sets, want = brute([r for r in rows if r[0] is not None], size)
    got = M.components_of(df, size).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id], r
            assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
            assert r.kept == (r.doc_id == r.component_id)
    return want


def test_equals_brute_force_on_the_given_table(given):
    want = check(given("documents"), 4)
    assert len(set(want.values())) < len(want)


def near_copies(n, seed, changed):
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(120)]
    for _ in range(n):
        t = list(base)
        for k in rng.sample(range(120), rng.randint(0, changed)):
            t[k] = f"n{rng.random()}"
        yield " ".join(t)


def test_a_large_loose_group_keeps_every_link(spark):
    rows = list(enumerate(near_copies(150, 1, 6))) + [(1000 + k, f"other {k} text with words") for k in range(10)]
    want = check(spark.createDataFrame(rows, "doc_id long, text string"), 5)
    assert 1 < len(set(want.values())) < 150


def test_odd_rows(odd):
    check(odd, 4)
    kept = M.dedup(odd, 4)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and ids.count(None) == 1 and 11 in ids and 12 not in ids


@pytest.mark.parametrize("texts", [[], [None, "", " "]])
def test_nothing_to_link(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [(r.n_shingles, r.kept) for r in M.components_of(df).collect()] == [(0, True)] * len(texts)


def test_pairs_at_the_similarity_are_not_pruned():
    for seen in range(M.BATCH, M.HASHES + 1, M.BATCH):
        need = M.fewest_matches(seen)
        assert 0 <= need < 0.8 * seen
    assert M.fewest_matches(M.HASHES) > 0.5 * M.HASHES


def test_components_of_a_long_path_and_of_a_star(spark):
    path = [(k, k + 1) for k in range(0, 60)]
    star = [(1000, 1001 + k) for k in range(40)] + [(7000, 7000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert got == grouped(path + star, {n for e in path + star for n in e})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert spark.range(1).select(F.lit(1)).count() == 1
