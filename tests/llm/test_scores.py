from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_words import words

from waymeter.llm import interpolation as I  # noqa: E741


def plain(rows):
    """Scores by the definition, with plain dictionaries."""
    fold = [zlib.crc32(str(i).encode()) % 7 if i is not None else 0 for i, _ in rows]
    tokens = [[*words(t), ""] for _, t in rows]
    every, kept, deleted = (Counter(), Counter()), (Counter(), Counter()), Counter()
    for f, w in zip(fold, tokens, strict=True):
        pairs = list(zip([" ", *w[:-1]], w, strict=True))
        for part, on in ((every, f != 2), (kept, f not in (2, 3))):
            if on:
                part[0].update([" ", *w])
                part[1].update(pairs)
        if f == 3:
            deleted.update(pairs)
    n, v = sum(every[0].values()) - every[0][" "], len(every[0]) - (" " in every[0])
    n_kept = sum(kept[0].values()) - kept[0][" "]
    bucket = lambda c: 1 + int(math.log2(c)) if c else 0
    cells = [(bucket(kept[0][a]), k, kept[1][a, b] / kept[0][a] if kept[0][a] else 0, kept[0][b] / max(n_kept, 1)) for (a, b), k in deleted.items()]
    columns = [np.array(c, float) for c in zip(*cells, strict=True)] if cells else [np.zeros(0)] * 4
    weights = I.learn_weights(columns[0].astype(int), *columns[1:], 1 / (v + 1))
    for f, w in zip(fold, tokens, strict=True):
        score = 0.0
        for a, b in zip([" ", *w[:-1]], w, strict=True):
            x = weights[min(bucket(every[0][a]), len(weights) - 1)]
            score += math.log10(x[0] * (every[1][a, b] / every[0][a] if every[0][a] else 0) + x[1] * every[0][b] / max(n, 1) + x[2] / (v + 1))
        base = sum(math.log10((every[0][b] + 1) / (n + v + 1)) for b in w)
        yield f == 2, len(w), sum(every[0][b] > 0 for b in w), n, base, score


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = sorted(((i if i is not None else -1, t or "", *p) for (i, t), p in zip(rows, plain(rows), strict=True)), key=lambda r: (r[0], r[3]))
    got = sorted(I.score(df).collect(), key=lambda r: (r.doc_id if r.doc_id is not None else -1, r.n_tokens))
    assert len(got) == len(want)
    for r, (i, _, held_out, n_tokens, known, n, base, score) in zip(got, want, strict=True):
        assert (r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i, held_out, n_tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(score, rel=1e-4, abs=1e-4)  # the weights are learned from binned estimates
    return got


@pytest.mark.parametrize("frequent", [None, 0, 50])
def test_given_documents(given, monkeypatch, frequent):
    if frequent is not None:
        monkeypatch.setattr(I, "FREQUENT_WORDS", frequent)
        monkeypatch.setattr(I, "FREQUENT_PAIRS", frequent)
    got = check(given("documents"))
    held_out = [r for r in got if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_odd_rows_and_empty_tables(odd, spark):
    check(odd)
    check(odd.limit(0))
    check(spark.createDataFrame([(2, "only a held-out text"), (None, None)], "doc_id long, text string"))


def test_weights_are_mixtures():
    rng = np.random.default_rng(1)
    w = I.learn_weights(rng.integers(0, 5, 300), rng.integers(1, 9, 300).astype(float), rng.random(300), rng.random(300) / 10, 1e-3)
    assert np.allclose(w.sum(1), 1) and (w >= 0).all() and w[0, 0] == 0
    assert I.learn_weights(*[np.zeros(0)] * 4, 1.0).shape == (1, 3)
    assert I.buckets_of(np.array([0, 1, 2, 3, 4, 1023, 1024])).tolist() == [0, 1, 2, 2, 3, 10, 11]


def test_a_word_that_is_rare_in_every_chunk_is_a_candidate_when_there_are_many():
    often, noted, sure, seen = np.uint64(77), 0, 0, {}
    rng = np.random.default_rng(5)
    for k in range(3_000):
        once = rng.integers(1 << 20, 1 << 62, 50, dtype=np.uint64)
        keys = np.concatenate([np.full(3, often), once, np.full(6, np.uint64(78))])
        at, n, drawn = I._candidates(keys, k * 0x9E3779B97F4A7C15 % (1 << 64))
        again = I._candidates(keys[::-1], k * 0x9E3779B97F4A7C15 % (1 << 64))
        assert sorted(keys[at]) == sorted(keys[::-1][again[0]])
        noted += int(drawn[keys[at] == often].sum())
        sure += int((n * ~drawn)[keys[at] == 78].sum())
        for key in keys[at][drawn]:
            seen[int(key)] = seen.get(int(key), 0) + 1
    assert sure == 18_000
    assert 0.5 * 9_000 < noted * I.SAMPLED < 2 * 9_000 and noted >= I.SIGNIFICANT
    assert all(c < I.SIGNIFICANT for key, c in seen.items() if key != 77)


def test_half_of_all_words_alike(spark):
    rows = [(k, " ".join("the" if j % 2 else f"r{(k * 31 + j) % 97}" for j in range(40))) for k in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_places_by_leading_bits_equal_a_bisection():
    rng = np.random.default_rng(3)
    even = np.unique(rng.integers(0, 1 << 64, 5_000, dtype=np.uint64))
    crowded = np.arange(500, dtype=np.uint64) + np.uint64(1 << 40)  # all in one slot
    for known in (even, even[:1], even[:0], np.append(even, np.uint64((1 << 64) - 1)), np.append(np.uint64(0), even), crowded):
        asked = np.concatenate([known, known + np.uint64(1), rng.integers(0, 1 << 64, 2_000, dtype=np.uint64)])
        assert (I._Places(known).find(asked) == I._find(known, asked)).all()
        assert (I._Places(known).find(known) == np.arange(len(known))).all()
    assert I._Places(even).even and not I._Places(crowded).even
    assert len(I._Places(even).find(even[:0])) == 0
