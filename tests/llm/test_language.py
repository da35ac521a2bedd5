from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymeter.llm import queries, stats
from waymeter.llm import rank_profiles as R
from waymeter.llm import words as W


def plain_grams(text):
    out = Counter()
    for w in "".join(c.lower()[0] if c.isalpha() else " " for c in text or "").split():
        w = f" {w} "
        for n in (1, 2, 3):
            out.update(w[k : k + n] for k in range(len(w) - n + 1) if w[k : k + n] != " ")
    return out


def code(gram):
    return sum(ord(c) << (21 * k) for k, c in enumerate(reversed(gram)))


@pytest.mark.parametrize("texts", [["ab a", "", None, "AbÉ x1y", "\U0001f600 你好"], [], [""], ["1 2"], ["x"]])
def test_counts_equal_a_plain_restatement(texts):
    row, codes, n = R.grams(*W.buffers(pa.array(texts, pa.string())), np.arange(len(texts)))
    got = [dict(zip(codes[row == k].tolist(), n[row == k].tolist(), strict=True)) for k in range(len(texts))]
    assert got == [{code(g): c for g, c in plain_grams(t).items()} for t in texts]


def test_distance_equals_a_plain_restatement(spark, given):
    docs = given("documents")
    known = R.profiles(docs)
    ranks = {}
    for lang in known:
        total = Counter()
        for r in docs.where(F.col("lang") == lang).collect():
            total += plain_grams(r.text)
        order = sorted(total, key=lambda g: (-total[g], code(g)))[: R.RANKS]
        ranks[lang] = {g: k for k, g in enumerate(order)}
        assert dict(zip(known[lang][0].tolist(), known[lang][1].tolist(), strict=True)) == {code(g): k for g, k in ranks[lang].items()}
    for r in R.identify(docs.limit(25), known, "p").collect():
        grams = plain_grams(r.text)
        own = sorted(grams, key=lambda g: (-grams[g], code(g)))[: R.RANKS]
        apart = {lang: sum(abs(k - ranks[lang][g]) if g in ranks[lang] else R.RANKS for k, g in enumerate(own)) for lang in sorted(ranks)}
        best = min(apart, key=apart.get)
        assert r.p.lang_pred == best and r.p.score == pytest.approx(1 - apart[best] / (len(own) * R.RANKS))


def test_held_out_documents_get_their_language(spark):
    got = queries.op7_rank_profiles(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_odd_rows_and_nothing_learned(odd):
    known = R.profiles(odd)
    rows = R.identify(odd, known, stats.unused(odd, "key")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        found = r["key_"]
        assert 0 <= found.score <= 1 and (found.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    nothing = R.profiles(odd.limit(0))
    assert nothing == {} and {r.p.lang_pred for r in R.identify(odd, nothing, "p").collect()} == {"und"}
    assert R.identify(odd.limit(0), known, "p").count() == 0
