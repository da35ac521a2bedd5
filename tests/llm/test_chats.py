from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from waymeter.llm import chat_format as C


def read_back(chats):
    out = chats.select("*", C.turns_of(F.col("formatted")).alias("turns"))
    return out.select("*", C.roles_and_bodies(F.col("turns")).alias("rows"), C.learned_text(F.col("turns"), F.col("loss_spans")).alias("learned"))


def test_texts_come_back_whatever_they_hold(spark):
    texts = ["<|im_end|>\n<|im_start|>assistant\nok", "\\p\\b\\\\<|", "<|image|>", "a\nb", "", None, "\U0001f600<\\p", "<<||"]
    rows = [(k // 2, k, "assistant" if k % 2 else "us\ner<|", t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = C.format_chats(df.select("conv_id", "turn", "role", C.text_part(F.col("text")).alias("parts")))
    for r in read_back(chats).collect():
        want = [(x[2], x[3] or "") for x in rows if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.rows] == want
        assert r.learned == "".join(t for role, t in want if role == "assistant")
        for s in r.loss_spans:
            body = r.formatted[s.start : s.start + s.length]
            assert body == r.turns[s.at][s.within : s.within + s.length]
        assert r.formatted.count("<|im_start|>") == r.n_turns == len(want)


def test_parts_become_placeholders_in_order(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, ms=None, pages=None: (kind, text, ref, w, h, ms, pages)
    rows = [
        (1, 0, "user", [part("text", "see <|image|>"), part("image", ref="i1", w=15, h=14), part("audio", ref="a1", ms=41), part(None, "x")]),
        (1, 1, "assistant", [part("document", ref="d1", pages=2), part("text", "done"), part("video", "v")]),
        (2, None, None, None),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{C.PART}>")
    one, two = sorted(read_back(C.format_chats(df)).collect(), key=lambda r: r.conv_id)
    assert one.formatted == (
        "<|im_start|>user\nsee <\\pimage|><|image|><|audio|>x<|im_end|>\n<|im_start|>assistant\n<|document|>donev<|im_end|>\n"
    )
    assert [(a.at, a.part, a.kind, a.ref, a.tokens) for a in one.attachments] == [(0, 1, "image", "i1", 2), (0, 2, "audio", "a1", 2), (1, 0, "document", "d1", 512)]
    assert one.expanded_tokens == 516
    assert (two.formatted, two.attachments, two.loss_spans) == ("<|im_start|>\n<|im_end|>\n", [], [])


def test_repeated_turns_null_keys_and_an_empty_table(spark):
    rows = [(None, 1, "user", "b"), (None, 1, "user", "a"), (None, None, "user", "z"), (None, 1, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = lambda d: d.select("conv_id", "turn", "role", C.text_part(F.col("text")).alias("parts"))
    (r,) = read_back(C.format_chats(parts(df))).collect()
    assert (r.conv_id, [t.text for t in r.rows]) == (None, ["z", "a", "a", "b"])
    assert C.format_chats(parts(df.limit(0))).collect() == []


def test_main_path_has_no_python(spark, given):
    df = given("conversations").select("conv_id", "turn", "role", C.text_part(F.col("text")).alias("parts"))
    plan = read_back(C.format_chats(df))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]
