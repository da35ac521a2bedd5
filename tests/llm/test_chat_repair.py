from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache
from itertools import product

import pytest

from waymeter.llm import chat_repair as C
from waymeter.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def plain_report(rows):
    """One conversation, by the definitions; the least of (cost, letters) over all edits."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    rows = [(t, r or "", x or "") for _, t, r, x in rows]
    fault, seen = [], set()
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        fault.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(i, made, inserts):
        """(cost, letters, rows made) to finish behind the initials ``made``, of which the last two and the number matter."""
        found = []
        if i == len(rows):
            if made in ("", "a"):
                found.append((0, "", ()))
        else:
            role, text = rows[i][1:]
            extra = fault[i] == "truncated"
            options = [("D", 3, made, None)]
            if fault[i] not in ("blank", "duplicate"):
                options += [("K", int(extra), role[:1], (role, text))] + [("R", 2 + extra, r[0], (r, text)) for r in ("user", "assistant")]
            for letter, cost, after, row in options:
                if letter != "D" and (made + after if after else "") not in ("s", "u", "su", "ua", "au"):
                    continue
                c, letters, more = best(i + 1, after, 0)
                found.append((cost + c, letter + letters, (row, *more) if row else more))
        if inserts < 3:
            for r in ("user", "assistant"):
                if (made + r[0]) in ("u", "su", "ua", "au"):
                    c, letters, more = best(i, r[0], inserts + 1)
                    found.append((2 + c, "I" + letters, ((r, ""), *more)))
        return min(found) if found else (10**9, "", ())

    cost, audit, made = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[fault.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
    )


def check(spark, rows, found=None):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    found = C.report(spark.createDataFrame(rows, SCHEMA)) if found is None else found
    got = {r.conv_id: tuple(r)[1:] for r in found.collect()}
    assert got.keys() == by.keys() and found.count() == len(by)
    for conv, some in by.items():
        assert got[conv] == plain_report(some), (conv, some)


def chats(seed, count, longest, texts=("Yes.", "No!", "so", "", " \n", "Why? ", "a.b", "x")):
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 4 + ["system", "tool", None, ""]
    return [(c, rng.choice([None, *range(longest)]), rng.choice(roles), rng.choice([None, *texts])) for c in range(count) for _ in range(rng.randint(1, longest))]


def test_random_chats(spark):
    check(spark, chats(1, 300, 9) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")])


@pytest.mark.parametrize("rows", [1, 2, 5])
def test_pieces_of_any_size_are_stitched(spark, monkeypatch, partitions, rows):
    monkeypatch.setattr(C, "PIECE_ROWS", rows)
    partitions(3)
    texts = tuple(f"Text {k}{'.' if k % 4 else ''}" for k in range(60))
    check(spark, chats(2, 40, 60, texts))


def test_runs_that_never_converge_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE_ROWS", 3)
    tools = [(1, k, "tool", f"{k}.") for k in range(40)] + [(1, 40, "user", "Q?")]
    same = [(2, k, "user", "same.") for k in range(50)] + [(2, None, "user", "same.")] * 9
    users = [(3, k, "user", f"{k}") for k in range(30)]
    check(spark, tools + same + users + [(4, None, None, None)])


def test_passes_are_few_where_vectors_converge():
    """From any vector, a row of a known role and one more lead to the same vector."""
    rows = [C._INITIALS.index(c) for c in "uauauau"]
    ends = {C.backward(bytes(rows), (0, *v))[0] for v in product(range(5), repeat=3) if all((0, *v)[q] <= 2 + (0, *v)[C._NEXT[q]] for q in range(4))}
    assert len(ends) <= 3


def test_given_conversations_and_query(spark, given):
    rows = [tuple(r) for r in given("conversations").select("conv_id", "turn", "role", "text").collect()]
    odd = [(10**6, 0, "user", None), (10**6, None, None, "x"), (10**6 + 1, 3, "assistant", "a.")]
    damaged = plain_damage(rows + odd)
    df = spark.createDataFrame(rows + odd, SCHEMA)
    assert sorted(map(repr, damaged)) == sorted(repr(tuple(r)) for r in C.damaged(df).collect())
    left = {r[0] for r in damaged}
    found = queries.op11_chat_repair(spark, "/root/testdata/sf0.001")
    assert found.count() == len({r[0] for r in rows})
    zeros = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    for r in found.collect():
        some = [x for x in damaged if x[0] == r.conv_id]
        assert tuple(r)[1:] == (plain_report(some) if r.conv_id in left else zeros)


def test_no_rows_and_other_columns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", 2, "k")], SCHEMA + ", piece long, kinds string")
    assert [tuple(r)[1:8] for r in C.report(rows).collect()] == [(0, 0, 0, 0, 0, 2, "KI")]
    assert C.report(rows.limit(0)).count() == 0
    gone = C.report(rows.limit(0), rows).collect()
    assert len(gone) == 1 and gone[0].audit == "" and gone[0].cost == 0


def test_edits_are_rows(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "Ho."), (1, 1, "tool", "T."), (1, 1, "tool", "T."), (1, 2, "user", "")], SCHEMA)
    edits = [e.asDict() for r in C.repaired(C.pieces(rows)).collect() for e in r.edits]
    assert [(e["edit"], e["copies"], e["role"], e["text"]) for e in edits] == [("R", 1, "user", "Ho."), ("R", 1, "assistant", "T."), ("D", 1, "tool", "T."), ("D", 1, "user", "")]
