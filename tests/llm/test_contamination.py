from __future__ import annotations

import random
import re

import pyarrow as pa

from waymeter.llm import spaced_seeds as S
from waymeter.llm import words as W


def tokens(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode())


def brute(docs, items):
    """(doc) → positions of windows with at most CHANGES substitutions, or whole shorter items."""
    tests = [tokens(t) for t in items]
    windows = [w[p : p + S.WINDOW] for w in tests for p in range(len(w) - S.WINDOW + 1)]
    short = [w for w in tests if S.LEAST <= len(w) < S.WINDOW]
    out = {}
    for i, t in docs:
        w = tokens(t)
        hits = {(S.WINDOW, p) for p in range(len(w) - S.WINDOW + 1) if any(sum(a != b for a, b in zip(w[p:], x, strict=False)) <= S.CHANGES for x in windows)}
        hits |= {(len(x), p) for x in short for p in range(len(w) - len(x) + 1) if w[p : p + len(x)] == x}
        if hits:
            out.setdefault(i, set()).update(hits)
    return out


def test_finds_exactly_the_windows_within_the_tolerance(spark):
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(12)]
    items = [" ".join(rng.choices(vocabulary, k=n)) for n in (20, 12, 9, 8, 7, 0)] + [None]
    docs = []
    for k in range(60):
        body = rng.choices(vocabulary, k=rng.randint(0, 40))
        t = items[k % 4].split()
        for p in rng.sample(range(len(t)), rng.randint(0, 4)):
            t[p] = "changed"
        docs.append((k, " ".join(body[:10]) + ", " + "! ".join(t).upper() + "\n" + " ".join(body[10:])))
    docs += [(100, None), (101, ""), (None, items[0]), (0, "again")]
    got = S.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    ).collect()
    want = brute(docs, items)
    assert {r.doc_id: r.n_windows for r in got} == {i: len(h) for i, h in want.items()}
    for r in got:
        assert r.first_token == min(p for _, p in want[r.doc_id]) and r.last_token == max(n + p - 1 for n, p in want[r.doc_id])


def test_given_passages_are_found_and_other_documents_left_alone(given):
    docs, items = given("documents"), [r.text for r in given("benchmark").collect()]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = {r.doc_id for r in S.contaminated(docs, given("benchmark")).collect()}
    assert {i for i, t in rows if any(x in t for x in items)} <= found
    clean = S.decontaminate(docs, given("benchmark"))
    assert clean.columns == docs.columns and {r.doc_id for r in clean.select("doc_id").collect()} == {i for i, _ in rows} - found


def test_odd_and_empty_tables(odd, given):
    benchmark = given("benchmark").selectExpr("item_id", "text", "1 AS seed", "2 AS window")
    assert S.contaminated(odd, benchmark).count() == 0
    assert S.decontaminate(odd, benchmark).count() == odd.count()
    assert S.contaminated(odd.limit(0), benchmark).count() == 0
    assert S.contaminated(odd, benchmark.limit(0)).count() == 0


def found(spark, docs, items):
    docs, items = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id, r.changes) for r in S.contaminated(docs, items, S.SHORT_CHANGES).collect()}


def test_items_under_a_window_are_found(spark):
    items = ["What is the capital of France?", "one two three four five six seven eight nine", "法国首都是哪里？", "Wie heißt “Der Prozess” von Franz Kafka auf Englisch richtig?"]
    docs = [
        "Trivia. What is the CAPITAL of France? Paris.",
        "they ask what is the capital of France every day",  # within a sentence: clean
        "so one two three four FIVES six seven eight nine ten",
        "so one two three four FIVES sixes seven eight nine ten",  # two substitutions
        "他问道：法国首都是哪里？答案。",
        "你知道法国首都是哪里吗",
        "und wie heißt «Der Prozess» von Franz Kafka auf Englisch richtig – oder",
    ]
    assert found(spark, docs, items) == {(0, 0, 0), (2, 1, 1), (4, 2, 0), (6, 3, 0)}


def test_unicode_punctuation_cuts_tokens():
    s, border = W.tokens(*W.buffers(pa.array(["it’s “so” 3.14—née. 東京x", "a", "", "b"])))
    assert s.count.tolist() == [9, 1, 0, 1]
    assert border.tolist() == [True, False, True, True, False, False, True, False, False, True, True]
