from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymeter.llm import bitmap, minhash_dedup, rank_profiles, stats
from waymeter.llm import words as W

from llm_words import words


@settings(max_examples=60, deadline=None)
@cases(st.lists(st.one_of(st.none(), st.text("aAbB \t\né .", max_size=30)), max_size=6))
def test_words_of_several_texts_equal_those_of_each(texts):
    o, x = W.buffers(pa.array(texts, pa.string()))
    s = W.spans(o, x)
    got = [[bytes(x[a:b]).decode().lower() for a, b, r in zip(s.start, s.end, s.row, strict=True) if r == k] for k in range(len(texts))]
    assert got == [[w.lower() for w in words(t)] for t in texts]
    names: dict[int, str] = {}
    for a, b, h in zip(s.start, s.end, s.hash.tolist(), strict=True):
        w = "".join(words(bytes(x[a:b]).decode()))
        assert names.setdefault(h, w) == w


def test_runs_stay_within_a_text_and_short_texts_have_one():
    texts = pa.array(["a b c", "a b c d e", "", "a b c d"])
    value, row, at = W.windows(W.spans(*W.buffers(texts)), 4)
    assert row.tolist() == [0, 1, 1, 3]
    assert value[1] == value[3] and len(set(value.tolist())) == 3
    assert at.tolist() == [0, 3, 4, 8]


def test_slices_cover_all_rows_in_order():
    batch = pa.record_batch({"text": pa.array(["x" * n for n in (10, 3000, 0, 5, 900)])})
    parts = list(W.slices(iter([batch]), size=1000))
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()
    assert len(parts) > 1


def test_distinct_pairs():
    row, value = W.distinct(np.array([1, 0, 1, 1]), np.array([5, 5, 5, 4], np.uint64))
    assert row.tolist() == [0, 1, 1] and value.tolist() == [5, 4, 5]


@settings(max_examples=60, deadline=None)
@cases(st.lists(st.text("ab é\n", max_size=40), max_size=5), st.integers(1, 12))
def test_blocks_of_any_size_give_the_same(texts, size):
    o, x = W.buffers(pa.array(texts, pa.string()))
    s = W.spans(o, x)
    assert np.array_equal(W._hashes(x, s.start, s.end, W._CODES[W._LOWER], size), s.hash)
    assert W.marked(o, x, W.BLANK, size).tolist() == [sum(c in " \n" for c in t) for t in texts]
    group = np.arange(len(texts)) % 2
    for a, b in zip(rank_profiles.grams(o, x, group, size), rank_profiles.grams(o, x, group), strict=True):
        assert a.tolist() == b.tolist()


@settings(max_examples=60, deadline=None)
@cases(st.lists(st.text("ab \n", max_size=40), max_size=5), st.integers(1, 12))
def test_pieces_put_texts_together_again_and_cut_no_word(texts, size):
    o, x = W.buffers(pa.array(texts, pa.string()))
    at, row = W.pieces(o, x, size)
    parts = [bytes(x[a:b]).decode() for a, b in zip(at, at[1:], strict=False)]
    assert ["".join(p for p, r in zip(parts, row, strict=True) if r == k) for k in range(len(texts))] == texts
    assert [w for p in parts for w in words(p)] == [w for t in texts for w in words(t)]


def test_a_very_long_text_takes_a_few_times_its_size():
    text = " ".join(f"w{k * 7919 % 50_021}{chr(10) if k % 13 == 0 else 'é'}" for k in range(500_000))
    texts = pa.array([text, "a short one"])
    o, x = W.buffers(texts)
    assert len(x) > 4 * W.SLICE_BYTES
    both = [W.spans(o, x).hash[-3:], W.spans(*W.buffers(texts[1:])).hash]
    assert both[0].tolist() == both[1].tolist()
    rank_profiles._fold(), W._kinds(), W._powers(W.SLICE_BYTES)
    calls = {
        "spans": (lambda: W.spans(o, x), 12), "tokens": (lambda: W.tokens(o, x), 18), "counts": (lambda: stats.count(o, x), 18),
        "shingles": (lambda: minhash_dedup.shingles(texts, 5), 14), "grams": (lambda: rank_profiles.grams(o, x, np.arange(2)), 20),
    }
    for name, (call, most) in calls.items():
        tracemalloc.start()
        call()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * len(x), name


def test_bitmaps_grow_with_their_keys_up_to_a_bound():
    assert bitmap.power_for(0) == bitmap.power_for(1 << 20) == bitmap.LEAST
    assert bitmap.power_for((1 << 20) + 1) == bitmap.LEAST + 1
    assert bitmap.power_for(10, bitmap.LEAST_OF_TWO) == bitmap.LEAST_OF_TWO
    assert bitmap.power_for(1 << 40) == bitmap.MOST


def test_bitmaps_of_every_size_hold_their_keys(spark):
    keys = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 600)
    df = spark.createDataFrame([(int(k),) for k in keys[:300]], "k long")
    for power in (23, 26):
        both = bitmap.has_both(bitmap.build_both(df, power), keys.view(np.uint64))
        assert both[:300].all() and both[300:].sum() < 3
        places = spark.createDataFrame([(int(k),) for k in keys], "k long").select(bitmap.placed(F.col("k"), power).alias("p"))
        one = bitmap.has(bitmap.build(df, F.col("k"), power), np.array([r.p for r in places.collect()]))
        assert one[:300].all() and one[300:].sum() < 3
