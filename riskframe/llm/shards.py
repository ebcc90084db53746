"""Sharding by balanced label propagation.

Rows that share a key are linked. Every row starts in a shard given by its number; in each round a join brings
each linked row the counts of its neighbours per shard, the row asks for the shard that holds most of them
(one of the first ``m`` shards when its group needs ``m`` shards to fit; every other round of those with room), and the requests between two
shards are granted up to a quota: as many as ask for the way back, plus the target's room. Rows without
links have no wish and fill what is left. A last pass numbers the rows of each shard by prefix sums and
moves the rows beyond a shard's capacity, unlinked ones first, to shards with room, so that counts differ by
one at most (law ``rows``).

Requests reach the driver as counts per pair of shards. Keys that hold more than a thousandth of the rows
(at most a thousand keys) are salted in the joins.

Defined results: null keys link nothing. Rows repeated in the table are rows of their own. An empty table
gives an empty result. Extra columns of the input are ignored unless named in ``keep``; one that is kept and named key,
shard or slot gives way to the result's column of that name, any other name may be kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskframe.sources.staging import stage

_SALTS = 64
_UNIT = float(1 << 30)


def _unit(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(_UNIT)


def _number(column: Column, values: Sequence[float]) -> Column:
    """values[column] for a short list."""
    return F.get(F.array(*[F.lit(v) for v in values]), column)


def capacities(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def quotas(wants: dict[tuple[int, int], int], linked: list[float], caps: list[int]) -> dict[tuple[int, int], float]:
    """The share of each pair's requests that is granted."""
    swaps = {(a, b): min(w, wants.get((b, a), 0)) for (a, b), w in wants.items()}
    more = [0] * len(caps)
    for (a, b), w in wants.items():
        more[b] += w - swaps[a, b]
    room = [max(0, c - n) for c, n in zip(caps, linked, strict=True)]
    return {(a, b): (swaps[a, b] + (w - swaps[a, b]) * min(1.0, room[b] / max(1, more[b]))) / w for (a, b), w in wants.items()}


def _salted(links: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Links with a salt, and the hot keys (each more than a thousandth of all rows, so at most a thousand)."""
    hot = links.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > max(_SALTS, n // 1000)).select("key")
    hot = stage(hot.withColumn("hot", F.lit(True)), "hot_keys")
    return links.join(F.broadcast(hot), "key", "left").select(
        "rid", "key", F.when(F.col("hot"), F.pmod(F.xxhash64("rid"), F.lit(_SALTS))).otherwise(0).cast("int").alias("salt")), hot


def propagate(links: DataFrame, n: int, shards: int, rounds: int) -> DataFrame:
    """rid and shard of every linked row; links: rid, key (rid numbers the n rows)."""
    caps = capacities(n, shards)
    most = max(1, caps[-1])
    salted, hot = _salted(links, n)
    salted = stage(salted, "links")
    state = stage(links.select("rid").distinct().withColumn("shard", F.pmod("rid", F.lit(shards)).cast("int")), "labels")
    linked: list[float] = []
    for turn in range(rounds):
        counts = (salted.join(state, "rid").groupBy("key", "shard").agg(F.count("*").alias("n"))
                  .groupBy("key").agg(F.collect_list(F.struct("shard", "n")).alias("held"))
                  .join(F.broadcast(hot), "key", "left")
                  .withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0))))))
        tally = (salted.join(counts.select("key", "salt", "held"), ["key", "salt"])
                 .select("rid", "key", F.explode("held").alias("h"))
                 .groupBy("rid", F.col("h.shard").alias("shard")).agg(F.sum("h.n").alias("n"), F.min("key").alias("key"))
                 .groupBy("rid").agg(F.sum("n").alias("total"), F.min("key").alias("key"),
                                     F.collect_list(F.struct("n", "shard")).alias("held")))
        by_weight = F.reverse(F.array_sort(F.transform("held", lambda h: F.struct(
            h["n"].alias("n"), F.xxhash64("key", h["shard"]).alias("tie"), h["shard"].alias("shard")))))
        first = lambda c: F.slice(c, 1, F.greatest(F.lit(1), F.ceil(F.col("total") / F.lit(most))).cast("int"))
        ranked = F.transform(by_weight, lambda h: h["shard"])
        # every other round full shards are left out, so that a group which finds no room goes on to its next best shard
        full = [s for s in range(shards) if turn % 2 and linked and linked[s] >= 0.98 * caps[s]]
        free = F.filter("sorted", lambda s: ~s.isin(full)) if full and len(full) < shards else F.col("sorted")
        wish = (tally.select("rid", "total", ranked.alias("sorted")).withColumn("goals", first(free)).join(state, "rid")
                .withColumn("goal", F.get("goals", F.pmod(F.xxhash64("rid", F.lit(turn)), F.greatest(F.size("goals"), F.lit(1))).cast("int")))
                .select("rid", "shard", F.when(F.array_contains(first("sorted"), F.col("shard")) | F.col("goal").isNull() | (
                    F.array_position("sorted", F.col("shard")) <= F.array_position("sorted", F.col("goal"))), F.col("shard"))
                    .otherwise(F.col("goal")).alias("goal")))
        wish = stage(wish, "wishes")
        asked = wish.groupBy("shard", "goal").agg(F.count("*").alias("n")).collect()  # at most shards * shards rows
        wants = {(r["shard"], r["goal"]): r["n"] for r in asked if r["shard"] != r["goal"]}
        if not wants and not full:
            break
        linked = [sum(r["n"] for r in asked if r["shard"] == s) for s in range(shards)]
        granted = quotas(wants, linked, caps)
        for (a, b), w in wants.items():  # as it will be after the moves
            linked[a] -= w * granted[a, b]
            linked[b] += w * granted[a, b]
        share = _number(F.col("shard") * shards + F.col("goal"), [granted.get((a, b), 0.0) for a in range(shards) for b in range(shards)])
        state = stage(wish.select("rid", F.when(_unit(F.col("rid"), F.lit(turn + 1000)) < share, F.col("goal")).otherwise(
            F.col("shard")).alias("shard")), "labels")
    return state


def even(rows: DataFrame, n: int, shards: int, order: Sequence[str]) -> DataFrame:
    """Adds slot and makes counts even; within a shard the last rows of ``order`` move first.

    Rows are range-sorted once; positions come from prefix sums over the partitions' counts.
    """
    spark = rows.sparkSession
    sorted_rows = stage(rows.repartitionByRange("shard", *order).sortWithinPartitions("shard", *order)
                        .withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_at", 33)
    pieces = sorted(sorted_rows.groupBy(part.alias("part"), "shard").agg(F.min("_at").alias("first"), F.count("*").alias("n"))
                    .collect(), key=lambda r: (r["shard"], r["part"]))  # partitions + shards rows
    caps, size, starts = capacities(n, shards), [0] * shards, []
    for r in pieces:
        starts.append((r["part"], r["shard"], r["first"], size[r["shard"]]))
        size[r["shard"]] += r["n"]
    over, moved, gaps = [], 0, []
    for s in range(shards):
        over.append(moved)
        moved += max(0, size[s] - caps[s])
    room = 0
    for s in range(shards):
        if size[s] < caps[s]:
            gaps.append((room, s, size[s]))
            room += caps[s] - size[s]
    where = spark.createDataFrame(starts, "part long, shard int, first long, base long")
    placed = sorted_rows.withColumn("part", part).join(F.broadcast(where), ["part", "shard"]).withColumn(
        "rank", F.col("_at") - F.col("first") + F.col("base"))
    cap = _number(F.col("shard"), caps)
    placed = placed.withColumn("beyond", F.when(F.col("rank") >= cap, _number(F.col("shard"), over) + F.col("rank") - cap))
    shard, slot = F.col("shard"), F.col("rank")
    for start, s, first in gaps:  # one branch per shard at most; later starts win
        hit = F.col("beyond") >= start
        shard = F.when(hit, F.lit(s)).otherwise(shard)
        slot = F.when(hit, F.col("beyond") - start + first).otherwise(slot)
    return placed.select(*[c for c in rows.columns if c != "shard"], shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def balanced_shards(docs: DataFrame, key: Column, shards: int = 24, rounds: int = 10, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, key, shard and slot; rows with equal keys are linked."""
    base = stage(docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), key.alias("key")).withColumn("rid", F.monotonically_increasing_id()), "rows")
    n = base.count()
    groups = base.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"), F.min("rid").alias("one"))
    single = groups.where("n = 1").select(F.col("one").alias("rid"))
    links = stage(base.where("key IS NOT NULL").select("rid", "key").join(single, "rid", "left_anti"), "linked")
    state = propagate(links, n, shards, rounds)
    rows = base.join(state, "rid", "left").select("row", "key", "rid", F.coalesce("shard", F.pmod("rid", F.lit(shards)).cast("int")).alias("shard"),
                                                  F.col("shard").isNull().alias("free"))
    own = [F.col("row")[c].alias(c) for c in keep if c.lower() not in ("key", "shard", "slot")]
    return even(rows, n, shards, ["free", "key", "rid"]).select(*own, "key", "shard", "slot")
