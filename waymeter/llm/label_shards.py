"""Sharding by balanced label propagation.

A shard is a label. In each round documents learn where the other members of their groups are and ask to move to
one shard that holds some of them, in the first round the one with most. A shard lets in what its quota of N / shards and a
little SLACK leave room for beside the linked documents that it keeps: places of those who leave in the same round count as
room, so shards full of linked documents exchange them. Requests are let in by buckets of whole groups. Rounds go on until
no document is outside the main shard of its group, or their number has not fallen for PATIENCE rounds; the best labels
are kept. At the end every shard has N / shards documents, at most one apart: surplus documents, those without links
first, then cut ones, then whole groups, fill the shards that lack some.

Groups are hubs: members are linked through a hub row, never pair by pair. A group larger than a part of a
shard aims at several shards, the ones with most members.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymeter.session import materialize

#: Most rounds; they end earlier when the cut stops falling.
ROUNDS = 20
PATIENCE = 2
#: A shard may hold so much more than its quota between rounds.
SLACK = 0.05
#: Counts of requests that reach the driver in a round, about: (shard, shard, bucket of groups).
REQUESTS = 100_000
#: A group aims at a further shard for each started such part of a shard's quota.
GROUP_SHARE = 0.5
#: Rows that are numbered together in one task, about.
NUMBERED = 100_000


def numbered(rows: DataFrame, group: str, rank: Column, n: int, name: str) -> DataFrame:
    """``rows`` and their place in the group, gapless from 0, by ``rank`` (0 to 2), then by ``key``, then by ``row``, which is unique.

    Rows are numbered in parts by hash of the key, and a part starts after the counts of the parts before it, so that no
    task has to hold a group.
    """
    parts = max(1, n // NUMBERED)
    place = F.pmod(F.xxhash64("key"), F.lit(parts)) + rank * parts
    rows = rows.withColumn("_part", place)
    counts = rows.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_part").orderBy("key", "row")
    rows = rows.withColumn("_k", F.row_number().over(inside) - 1).join(counts, [group, "_part"])
    return rows.withColumn(name, F.col("_before") + F.col("_k")).drop("_part", "_k", "_before")


def admitted(requests: np.ndarray, held: np.ndarray, limit: int) -> list[int]:
    """How many buckets each shard lets in, from requests[bucket, from, to] and what the shards hold.

    All are let in at first. A shard that would exceed the limit, its departures taken off, drops its last bucket; that may
    keep documents in other shards, so this is repeated until every shard fits or lets nobody in.
    """
    total = np.concatenate([np.zeros((1, *requests.shape[1:]), np.int64), requests.cumsum(0)])
    let = np.full(len(held), len(requests))
    while True:
        moves = np.take_along_axis(total, let[None, None, :], 0)[0]
        over = (held + moves.sum(0) - moves.sum(1) > limit) & (let > 0)
        if not over.any():
            return let.tolist()
        let -= over


def _pick(key: Column, values: dict[int, int]) -> Column:
    return F.element_at(F.array(*[F.lit(values[k]) for k in sorted(values)]), key + 1)


def _share(shards: int, n: int) -> int:
    return max(1, int(GROUP_SHARE * n / shards))


def propagate(members: DataFrame, shards: int, n: int, rounds: int = ROUNDS) -> DataFrame:
    """(row, key, shard, cut) of linked rows after at most ``rounds`` rounds, from (row, hub, key, shard).

    ``n`` counts all rows. ``cut`` tells that a row is outside the main shards of its group. ``key`` is equal for rows that
    are let in together: a hash of the hub, or in groups larger than a share one of the row.
    """
    share = _share(shards, n)
    limit = int(np.ceil(n / shards * (1 + SLACK)))
    buckets = max(4, REQUESTS // shards**2)
    best, least, stalled = None, 0, 0
    for k in range(rounds + 1):
        held = members.groupBy("hub", "shard").agg(F.count("*").alias("n"))
        # A refused group asks elsewhere: shards are drawn with chances by their number of members.
        drawn = -F.log((F.pmod(F.xxhash64("hub", "shard", F.lit(k)), F.lit(1 << 30)) + 1) / (1 << 30)) / F.col("n")
        turn = F.pmod(F.hash("hub") + F.col("shard"), F.lit(shards))
        ranked = held.groupBy("hub").agg(
            F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), turn.alias("turn"), "shard"))).alias("by"),
            F.min_by("shard", drawn).alias("drawn"),
            F.sum("n").alias("size"),
        )
        main = F.slice("by.shard", 1, F.ceil(F.col("size") / share).cast("int"))
        ranked = ranked.select("hub", main.alias("main"), F.when((F.col("size") <= share) & F.lit(k > 0), F.array("drawn")).otherwise(main).alias("aims"))
        asked = members.join(ranked, "hub").select(
            "row", "hub", "key", "shard", (~F.array_contains("main", F.col("shard"))).alias("cut"),
            F.when(F.array_contains("aims", F.col("shard")), F.col("shard")).otherwise(F.get("aims", F.pmod(F.hash("row"), F.size("aims")))).alias("to"),
            F.pmod(F.xxhash64("key", F.lit(k)), F.lit(buckets)).cast("int").alias("bucket"),
        )
        asked = materialize(asked, "asked")
        counts = asked.groupBy("shard", "to", F.when(F.col("to") != F.col("shard"), F.col("bucket")).otherwise(0).alias("bucket"))
        found = counts.agg(F.count("*").alias("n"), F.sum(F.col("cut").cast("int")).alias("cut")).toArrow().to_pydict()
        cut = sum(found["cut"])
        if best is None or cut < least:
            best, least, stalled = asked, cut, 0
        else:
            stalled += 1
        if not cut or stalled == PATIENCE or k == rounds:
            break
        at, to, n_rows = (np.array(found[c], np.int64) for c in ("shard", "to", "n"))
        requests = np.zeros((buckets, shards, shards), np.int64)
        np.add.at(requests, (np.array(found["bucket"], np.int64), at, to), n_rows * (at != to))
        let = admitted(requests, np.bincount(at, n_rows, shards).astype(np.int64), limit)
        goes = F.col("bucket") < _pick(F.col("to"), dict(enumerate(let)))
        members = asked.select("row", "hub", "key", F.when(goes, F.col("to")).otherwise(F.col("shard")).alias("shard"))
    return best.select("row", "key", "shard", "cut")


def shard_rows(docs: DataFrame, shards: int = 40, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law 'rows', shard, slot, grown_shard null) of every row of ``docs``.

    Rows of equal text are linked. Shard counts are at most one apart, slots are gapless from 0 within a shard.
    A null text counts as empty for size and checksum but links with nothing; equal empty texts are linked.
    Repeated rows and null ids are rows like any other. An empty table gives no rows.
    """
    text = F.col("text").cast("string")
    hub = F.when(text.isNotNull(), F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("2"), text).alias("b")))
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        hub.alias("hub"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "shard-rows").withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    n = rows.count()
    groups = rows.where("hub IS NOT NULL").groupBy("hub").agg(F.count("*").alias("c")).where("c > 1")
    key = F.xxhash64(F.when(F.col("c") > _share(shards, n), F.col("row")).otherwise(F.col("hub.a")))
    linked = rows.where("hub IS NOT NULL").join(groups, "hub").select("row", "hub", key.alias("key"), "shard")
    labels = propagate(materialize(linked, "linked"), shards, n, rounds).select("row", "key", F.col("shard").alias("label"), "cut")

    placed = rows.join(labels, "row", "left").withColumn("shard", F.coalesce("label", "shard"))
    placed = placed.withColumn("key", F.coalesce("key", F.xxhash64("row")))
    placed = numbered(placed, "shard", F.when(F.col("label").isNull(), 2).otherwise(F.col("cut").cast("int")), n, "slot")
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "shard", "slot"), "placed")
    held = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # at most `shards` rows
    quota = {s: n // shards + (s < n % shards) for s in range(shards)}
    over, lack, surplus, gaps = 0, 0, {}, []
    for s in range(shards):
        surplus[s] = over - quota[s]
        over += max(0, held.get(s, 0) - quota[s])
        if (d := quota[s] - held.get(s, 0)) > 0:
            gaps.append((lack, s, held.get(s, 0) - lack))
            lack += d
    at = F.col("slot") + _pick(F.col("shard"), surplus)
    to, shift = F.lit(0), F.lit(0)
    for begin, s, add in gaps:
        to, shift = F.when(at >= begin, F.lit(s)).otherwise(to), F.when(at >= begin, F.lit(add)).otherwise(shift)
    stays = F.col("slot") < _pick(F.col("shard"), quota)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.when(stays, F.col("shard")).otherwise(to).cast("int").alias("shard"),
        F.when(stays, F.col("slot")).otherwise(at + shift).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
