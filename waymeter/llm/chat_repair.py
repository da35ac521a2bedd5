"""Conversation structure repair: the cheapest edits that make roles alternate, by rank-convergence parallel Viterbi.

Rows of a conversation, by turn, are kept, re-roled, deleted, or preceded by inserted rows, so that role initials read
(s?(ua)+)?. A state is what the last role was; a cost vector has the least cost to go from each state.

Conversations are cut into pieces of bounded size, which are one to most and many to a hot one. Every piece starts from a
speculative vector behind its last row, that of a conversation's end. Fix-up passes compare it with the one that the piece behind
found and rerun the pieces where the two differ by more than a constant, until none does; as vectors soon depend on the rows
alone, few passes do. The stitched vectors then decide each edit from the front, the first by letter among the cheapest.

Blank and repeated rows must go. They change no vector and are deleted where they stand, so runs of them delay nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymeter.session import materialize

#: Rows and bytes of text of a piece, at most (or one longer text).
PIECE_ROWS, PIECE_BYTES = 4096, 1 << 20
#: Costs: a deleted, re-roled or inserted row, and a truncated one that stays.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1

#: States: nothing yet, after the system's row, after a user's, after an assistant's. Inserted and re-roled rows lead to NEXT.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_INITIALS = "?sua"
#: Kinds of rows: place of the role's initial, then bits for a truncated row and for one that must go.
_CUT_SHORT, _MUST_GO = 4, 8
#: Costs to go behind the last row.
_END = (0, 4, 2, 0)
_BLANKS = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


def _kept(state: int, initial: int) -> int | None:
    """The state after a kept row, or None where it can't stand."""
    fits = {1: (_START,), 2: (_START, _SYSTEM, _ASSISTANT), 3: (_USER,)}.get(initial, ())
    return initial if state in fits else None


@cache
def step(behind: Vector, kind: int) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """Costs to go before a row, less their minimum, and for each state the edits up to the row's own and the state after them."""
    if kind & _MUST_GO:
        return behind, tuple(("D", q) for q in range(4))
    extra = TRUNCATED if kind & _CUT_SHORT else 0
    choices = []
    for q in range(4):
        own = {"D": (DELETE + behind[q], q), "R": (REROLE + extra + behind[_NEXT[q]], _NEXT[q])}
        if (to := _kept(q, kind & 3)) is not None:
            own["K"] = (extra + behind[to], to)
        choices.append(own)
    cost = [min(c for c, _ in own.values()) for own in choices]
    for _ in range(3):
        cost = [min(c, INSERT + cost[_NEXT[q]]) for q, c in enumerate(cost)]
    moves = []
    for q in range(4):
        letters = ""
        while True:
            for letter in "DIKR":
                if letter == "I" and cost[q] == INSERT + cost[_NEXT[q]]:
                    q = _NEXT[q]
                    break
                if letter in choices[q] and choices[q][letter][0] == cost[q]:
                    q = choices[q][letter][1]
                    break
            letters += letter
            if letter != "I":
                break
        moves.append((letters, q))
    least = min(cost)
    return tuple(c - least for c in cost), tuple(moves)


def backward(kinds: bytes, behind: Vector) -> tuple[Vector, list]:
    """The vector before a piece's rows and the moves at each row."""
    moves = []
    for kind in reversed(kinds):
        behind, found = step(behind, kind)
        moves.append(found)
    moves.reverse()
    return behind, moves


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of chats (conv_id, turn, role, text) as a faulty transport leaves them, by the checksum of conversation and turn.

    Nulls are one blank. Of twenty rows one is lost, one is emptied, one loses its full stops, one comes twice, one becomes a user's.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    out = rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), F.when(fault == 3, 2).otherwise(1).alias("_times"), fault.alias("_fault"))
    out = out.where("_fault <> 0")
    return out.withColumn("_times", F.explode(F.array_repeat(F.lit(1), F.col("_times")))).select("conv_id", "turn", "role", "text")


def _distinct(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n: equal rows, blank, truncated, first: its role and text have not been seen before)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"))
    rows = rows.withColumn("key", F.unhex(F.sha2("text", 256)))
    order = F.min(F.struct(F.col("turn").isNotNull().alias("set"), "turn")).alias("t")
    firsts = rows.groupBy("conv_id", "role", "key").agg(order).select("conv_id", F.col("t.turn").alias("turn"), "role", "key", F.lit(None).cast("string").alias("text"), F.lit(0).alias("n"), F.lit(1).alias("first"))
    every = rows.select("conv_id", "turn", "role", "key", "text", F.lit(1).alias("n"), F.lit(0).alias("first")).unionByName(firsts)
    every = every.groupBy("conv_id", "turn", "role", "key").agg(F.sum("n").alias("n"), F.max("first").alias("first"), F.max("text").alias("text"))
    said = F.rtrim("text", F.lit(_BLANKS))
    return every.select("conv_id", "turn", "role", "text", "n", (said == "").alias("blank"), (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("truncated"), (F.col("first") == 1).alias("first"))


_PIECE = (
    "piece long, kinds binary, turns array<long>, roles array<string>, texts array<string>, copies array<long>, blank long, duplicate long, "
    "truncated long, illegal long, turn_count long, first_initial int, last_initial int, first_turn long, last_turn long"
)
_LEGAL = {(1, 2), (2, 3), (3, 2)}


def pieces(rows: DataFrame) -> DataFrame:
    """The rows of conversations in order, as pieces of bounded size; ``piece`` rises along a conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ordered = materialize(_distinct(rows), "chat-rows").repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
    legal = np.zeros((4, 4), bool)
    legal[tuple(zip(*_LEGAL, strict=True))] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            conv, turn = batch.column("conv_id"), batch.column("turn")
            n, blank, truncated, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "blank", "truncated", "first"))
            n = n.astype(np.int64)
            initial = np.array([max(_INITIALS.find(r[:1]), 0) if r else 0 for r in batch.column("role").to_pylist()], np.int64)
            ids = conv.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            sizes = np.array(pc.binary_length(batch.column("text")))
            free = first & ~blank
            kinds = (initial + _CUT_SHORT * (free & truncated) + _MUST_GO * ~free).astype(np.uint8)
            cuts, held = [0], 0
            for k in range(batch.num_rows):
                if k > cuts[-1] and (ids[k] != ids[k - 1] or k - cuts[-1] >= PIECE_ROWS or held + sizes[k] > PIECE_BYTES):
                    cuts.append(k)
                    held = 0
                held += sizes[k]
            start, end = np.array(cuts), np.array([*cuts[1:], batch.num_rows])
            if not batch.num_rows:
                continue
            total = lambda x: np.add.reduceat(x.astype(np.int64), start)  # noqa: E731, B023
            inside = np.ones(batch.num_rows, bool)
            inside[start] = False
            bad = np.zeros(batch.num_rows, bool)
            bad[1:] = ~legal[initial[:-1], initial[1:]]
            has = ~turn.is_null().to_numpy(zero_copy_only=False)
            turns = turn.fill_null(0).to_numpy()
            fresh = has.copy()
            fresh[1:] &= ~(has[:-1] & (turns[1:] == turns[:-1]) & inside[1:])
            offsets = pa.array(np.append(start, batch.num_rows), pa.int32())
            lists = lambda c: pa.ListArray.from_arrays(offsets, batch.column(c))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [
                    conv.take(pa.array(start)), pa.array(number + np.arange(len(start))), pa.array([kinds[a:b].tobytes() for a, b in zip(start, end, strict=True)], pa.binary()),
                    lists("turn"), lists("role"), lists("text"), pa.ListArray.from_arrays(offsets, pa.array(n)),
                    pa.array(total(n * blank)), pa.array(total(n * ~blank - free)), pa.array(total(free & truncated)), pa.array(total((bad & inside) + n - 1)), pa.array(total(fresh)),
                    pa.array(initial[start], pa.int32()), pa.array(initial[end - 1], pa.int32()), turn.take(pa.array(start)), turn.take(pa.array(end - 1)),
                ],
                names=["conv_id", *[c.split()[0] for c in _PIECE.split(", ")]],
            )
            number += len(start)

    return materialize(ordered.mapInArrow(run, f"conv_id {kind}, {_PIECE}"), "chat-pieces")


def _vectors(cut: DataFrame) -> DataFrame:
    """(piece, behind, state, last) of the pieces of conversations that have several: their vectors and first states, stitched."""
    many = cut.groupBy("conv_id").agg(F.count("*").alias("parts")).where("parts > 1").select(F.col("conv_id").alias("_id"))
    cut = materialize(cut.select("conv_id", "piece", "kinds").join(many, F.col("conv_id").eqNullSafe(F.col("_id")), "left_semi"), "chat-cut")
    conv = f"conv_id {cut.schema['conv_id'].dataType.simpleString()}"
    end = F.array(*[F.lit(x) for x in _END])
    in_order = Window.partitionBy("conv_id").orderBy("piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(backward(k, tuple(v))[0]) for k, v in zip(batch.column("kinds").to_pylist(), batch.column("behind").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("piece"), batch.column("behind"), pa.array(found, pa.list_(pa.int32()))], names=["conv_id", "piece", "behind", "before"])

    passed = lambda df: df.select("conv_id", "piece", "kinds", "behind").mapInArrow(run, f"{conv}, piece long, behind array<int>, before array<int>")
    done = materialize(passed(cut.withColumn("behind", end)), "chat-vectors")
    while True:
        stitched = materialize(done.withColumn("found", F.coalesce(F.lead("before").over(in_order), end)), "chat-stitched")
        wrong = stitched.where("found <> behind")
        if wrong.isEmpty():
            break
        again = wrong.select("piece", F.col("found").alias("behind")).join(cut, "piece")
        done = materialize(stitched.where("found = behind").drop("found").unionByName(passed(again)), "chat-vectors")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for kinds, behind in zip(batch.column("kinds").to_pylist(), batch.column("behind").to_pylist(), strict=True):
                moves, states = backward(kinds, tuple(behind))[1], [0, 1, 2, 3]
                for at in moves:
                    states = [at[q][1] for q in states]
                found.append(states)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("piece"), batch.column("behind"), pa.array(found, pa.list_(pa.int32()))], names=["conv_id", "piece", "behind", "ends"])

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: object = ()
        state = _START
        for batch in batches:
            found = []
            for conv_id, to in zip(batch.column("conv_id").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                state = state if before == (conv_id,) else _START
                before = (conv_id,)
                found.append(state)
                state = to[state]
            yield pa.RecordBatch.from_arrays([batch.column("piece"), batch.column("behind"), pa.array(found, pa.int32()), batch.column("last")], names=["piece", "behind", "state", "last"])

    maps = done.select("piece", "behind").join(cut, "piece").select("conv_id", "piece", "kinds", "behind").mapInArrow(ends, f"{conv}, piece long, behind array<int>, ends array<int>")
    maps = maps.withColumn("last", F.lead("piece").over(in_order).isNull())
    return maps.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(states, "piece long, behind array<int>, state int, last boolean")


_EDIT = "array<struct<edit:string,copies:bigint,turn:bigint,role:string,text:string>>"


def repaired(cut: DataFrame) -> DataFrame:
    """(conv_id, piece, cost, edits) of each piece: in order, the cheapest edits, ``copies`` of each; kept, re-roled and inserted rows with their role and text."""
    several = _vectors(cut)
    rows = cut.select("conv_id", "piece", "kinds", "turns", "roles", "texts", "copies").join(several, "piece", "left")
    kind = cut.schema["conv_id"].dataType.simpleString()
    edit = pa.struct([("edit", pa.string()), ("copies", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                costs, every = [], []
                for r in part.select(["kinds", "turns", "roles", "texts", "copies", "behind", "state", "last"]).to_pylist():
                    cost, edits = _edits(r["kinds"], r["turns"], r["roles"], r["texts"], r["copies"], tuple(r["behind"] or _END), r["state"] or _START, r["last"] is not False)
                    costs.append(cost)
                    every.append(edits)
                yield pa.RecordBatch.from_arrays([part.column("conv_id"), part.column("piece"), pa.array(costs, pa.int64()), pa.array(every, pa.list_(edit))], names=["conv_id", "piece", "cost", "edits"])

    return rows.select("conv_id", "piece", "kinds", "turns", "roles", "texts", "copies", "behind", "state", "last").mapInArrow(run, f"conv_id {kind}, piece long, cost long, edits {_EDIT}")


def _edits(kinds: bytes, turns: list, roles: list, texts: list, copies: list, behind: Vector, state: int, last: bool) -> tuple[int, list]:
    cost, out = 0, []

    def insert() -> None:
        nonlocal cost, state
        cost, state = cost + INSERT, _NEXT[state]
        out.append(("I", 1, None, _ROLES[state], ""))

    for kind, moves, turn, role, text, n in zip(kinds, backward(kinds, behind)[1], turns, roles, texts, copies, strict=True):
        letters, to = moves[state]
        for _ in letters[:-1]:
            insert()
        gone = n - 1
        if letters[-1] == "D":
            gone = n
        else:
            re_roled = letters[-1] == "R"
            cost += (REROLE if re_roled else 0) + (TRUNCATED if kind & _CUT_SHORT else 0)
            out.append((letters[-1], 1, turn, _ROLES[to] if re_roled else role, text))
        if gone:
            cost += DELETE * gone
            out.append(("D", gone, turn, role, text))
        state = to
    while last and _END[state]:
        insert()
    return cost, [dict(zip(("edit", "copies", "turn", "role", "text"), e, strict=True)) for e in out]


def faults(cut: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal) of each conversation."""
    in_order = Window.partitionBy("conv_id").orderBy("piece")
    before = lambda c: F.lag(c).over(in_order)
    legal = F.array(*[F.lit(10 * a + b) for a, b in sorted(_LEGAL)])
    small = cut.select("conv_id", "piece", "blank", "duplicate", "truncated", "illegal", "turn_count", "first_initial", "last_initial", "first_turn", "last_turn")
    joints = small.withColumns({
        "illegal": F.col("illegal") + (before("piece").isNotNull() & ~F.array_contains(legal, 10 * before("last_initial") + F.col("first_initial"))).cast("long"),
        "turn_count": F.col("turn_count") - F.coalesce(before("last_turn") == F.col("first_turn"), F.lit(False)).cast("long"),
    })
    # Nulls come first, so a piece's last turn is its highest; only its first may be null while others are not.
    span = F.max("last_turn") - F.min("low") + 1 - F.sum("turn_count")
    low = cut.select("piece", F.array_min("turns").alias("low"))
    return joints.join(low, "piece").groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    )


def _digests(edited: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): of the repaired rows as role:text, one a line. A conversation passes its task piece by piece."""
    kind = edited.schema["conv_id"].dataType.simpleString()
    stays = F.filter("edits", lambda e: e["edit"] != "D")
    lines = F.when(F.size(stays) > 0, F.array_join(F.transform(stays, lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, digests, current, begun = [], [], None, False
        for batch in batches:
            for conv_id, line in zip(batch.column("conv_id").to_pylist(), batch.column("lines").to_pylist(), strict=True):
                if not ids or ids[-1] != conv_id:
                    if ids:
                        digests.append(current.hexdigest())
                    ids.append(conv_id)
                    current, begun = hashlib.sha256(), False
                if line is not None:
                    current.update((("\n" if begun else "") + line).encode())
                    begun = True
            if len(ids) > 1:
                yield pa.RecordBatch.from_arrays([pa.array(ids[:-1], batch.schema.field("conv_id").type), pa.array(digests, pa.string())], names=["conv_id", "repaired_sha256"])
                ids, digests = ids[-1:], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("conv_id").type), pa.array([current.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    rows = edited.select("conv_id", "piece", lines.alias("lines")).repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return rows.select("conv_id", "lines").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def report(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation of ``rows``.

    ``rows`` has conv_id, turn, role and text, a null role or text is empty, and an empty role fits nowhere; rows go by turn, nulls first, then role and text. A null
    conv_id is a conversation like others. ``conversations`` (conv_id) adds those without rows: zeros, an empty audit, the digest of
    an empty text. Other columns are not read; an empty table gives no rows. A piece is the largest thing in a task, but the audit
    of a conversation is one string, and its digest is taken by one task that sees the pieces one after the other.
    """
    cut = pieces(rows)
    edited = materialize(repaired(cut), "chat-edits")
    letters = F.array_join(F.transform("edits", lambda e: F.repeat(e["edit"], e["copies"].cast("int"))), "")
    audits = edited.select("conv_id", "piece", "cost", letters.alias("letters")).groupBy("conv_id").agg(
        F.sum("cost").alias("cost"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "letters"))), lambda p: p["letters"]), "").alias("audit")
    )
    ids = rows.select("conv_id") if conversations is None else conversations.select("conv_id").unionByName(rows.select("conv_id"))
    out = ids.distinct()
    for part in (faults(cut), audits, _digests(edited)):
        part = part.withColumnRenamed("conv_id", "_id")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
