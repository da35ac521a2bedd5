from __future__ import annotations

import re

import corpus_pipeline
from llm_words import grouped, words
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def copies(docs):
    """Documents that are not the least of their group: all pairs of five-word shingle sets."""
    sets = {}
    for r in docs:
        w = words(r.text)
        sets[r.doc_id] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    ids = sorted(i for i in sets if sets[i])
    links = [(a, b) for a in ids for b in ids if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {i for i, c in grouped(links, list(sets)).items() if i != c}


def passages(docs, items):
    """Documents with a window of twelve tokens of an item, two of them changed at most. Items here are longer than that."""
    split = lambda t: re.findall(r"[^\W_]+", t or "")
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    index = {}
    for t in map(split, map(low, items)):
        assert len(t) >= 12
        for k in range(len(t) - 11):
            window = t[k : k + 12]
            # Of three parts of four tokens, two changes leave one as it is.
            for part in range(3):
                index.setdefault((part, *window[4 * part : 4 * part + 4]), set()).add(tuple(window))
    out = set()
    for r in docs:
        t = split(low(r.text))
        for k in range(len(t) - 11):
            near = (w for part in range(3) for w in index.get((part, *t[k + 4 * part : k + 4 * part + 4]), ()))
            if any(sum(a != b for a, b in zip(t[k : k + 12], w, strict=True)) <= 2 for w in near):
                out.add(r.doc_id)
                break
    return out


def test_each_stage_works_on_what_its_predecessor_kept(spark, given):
    docs = given("documents").withColumns({"_verdict": F.lit(1), "place": F.lit(2)})
    labels = {r.doc_id: r.quality for r in given("labels").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before = ids(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= len(before)
        kept = ids(out)
        gone = before - kept
        if name.startswith("quality"):
            texts = {r.doc_id: r.text for r in docs.collect()}
            clean = [i for i in before if labels.get(i) == 1 and len(words(texts[i])) >= 10]
            assert sum(i in gone for i in clean) <= 0.05 * len(clean) + 2
            assert name != "quality_rules" or gone
        if name == "near_duplicates":
            assert gone == copies(docs.collect())
        if name == "decontamination":
            assert gone == passages(docs.collect(), [r.text for r in given("benchmark").collect()])
        docs = spark.createDataFrame(out.collect(), out.schema)
        before = kept
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert ids(pieces) == before


def test_run_equals_its_stages_and_empty_input(spark, given):
    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset", "ids"} <= set(rows.columns) and rows.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, given("documents").limit(0), SF).count() == 0
