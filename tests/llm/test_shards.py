from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from waymeter.llm import label_shards as L


def check(df, shards):
    rows = df.select("doc_id", "text").collect()
    got = L.shard_rows(df, shards).collect()
    facts = lambda t: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r.doc_id, *facts(r.text)) for r in rows)
    held = defaultdict(list)
    for r in got:
        held[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in held.values())
    counts = [len(held[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    return got


def test_groups_stay_together_and_sizes_even(given):
    groups = defaultdict(set)
    many = Counter()
    for r in check(given("documents"), 4):
        groups[r.text_crc32].add(r.shard)
        many[r.text_crc32] += 1
    copied = [c for c in groups if many[c] > 1]
    assert sum(len(groups[c]) == 1 for c in copied) > 0.9 * len(copied)


def test_a_group_of_a_third_fills_few_shards(spark):
    rows = [(k, "same" if k % 3 == 0 else f"text {k}") for k in range(300)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), 10)
    per_shard = Counter(r.shard for r in got if r.doc_id % 3 == 0)
    assert sum(n for _, n in per_shard.most_common(5)) > 60


@pytest.mark.parametrize(("size", "linked"), [(4, 1.0), (20, 1.0), (4, 0.9)])
def test_groups_meet_where_most_rows_have_a_copy(spark, size, linked):
    n, shards = 4000, 8
    rows = [(k, f"group {k % int(n * linked / size)}" if k < n * linked else f"text {k}") for k in range(n)]
    held = defaultdict(Counter)
    for r in check(spark.createDataFrame(rows, "doc_id long, text string"), shards):
        held[r.text_crc32][r.shard] += 1
    outside = sum(sum(c.values()) - max(c.values()) for c in held.values())
    assert outside < 0.05 * n * linked


def test_shards_exchange_rows_without_room():
    requests = np.zeros((2, 3, 3), np.int64)
    requests[0, 0, 1] = requests[0, 1, 0] = requests[1, 2, 0] = 5
    assert L.admitted(requests, np.array([10, 10, 10]), 10) == [1, 2, 2]


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_odd_rows(odd, shards):
    check(odd, shards)


def test_an_empty_table_and_no_python(given, odd):
    assert L.shard_rows(odd.limit(0)).count() == 0
    plan = L.shard_rows(given("documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
