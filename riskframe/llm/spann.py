"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors get one component more, so that the largest inner product is the smallest distance. Centroids are
fitted by balanced k-means on a bounded sample; every vector is then put on the list of its nearest centroid and,
near a boundary, on further lists (up to ``COPIES`` in all, distance within ``CLOSURE`` of the nearest). Centroids are searched in memory through a neighbour graph, by tasks
that hold both (their number is bounded), for entries and queries alike. A query reads its ``NEAREST`` lists and every other one the graph leads to within a
distance ratio, counted from the last of these. The ratio is fitted through the same search: sampled queries are compared with all entries, and it is the
least that finds ``TARGET`` of their true neighbours, plus two standard errors. The ``NEAREST`` lists are read first; from the others only entries come back that are not worse
than the k + 1 best of these, so what a query brings back does not grow with the lists it reads. Lists are joined with their queries block by block, so no task holds a
whole hot list. Equal vectors are one entry with their k + 1 smallest ids, which is all a query can need.

Defined results: vectors that are null, zero, of another dimension than most, or hold null or non-finite components take no
part, nor do rows without id. Rows that repeat an id are rows of their own. A query has as many results as
there are other rows found, at most k. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.sources.staging import stage

SAMPLE = 20_000  # vectors the centroids are fitted on, expected
MAX_LISTS = 4096
LIST_SIZE = 64  # wanted entries per list
COPIES = 4  # lists an entry stands on at most
CLOSURE = 1.20
NEAREST = 8  # lists every query reads; the distance of the last one is its unit
SLACK = 1.05  # so far beyond its reach a query follows the graph
TARGET = 0.92  # recall the reach of queries is fitted to,
FITTED = 512  # on so many of them
DEGREE = 24
_EDGE = 1 + 1e-9  # a ratio at the reach is within it
BLOCK = 2000  # entries and queries of a task's block


def usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """k-means whose assignment charges for the entries a centroid has already."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    charge, want = 0.0, len(x) / len(c)
    for _ in range(rounds):
        count, total, loss = np.zeros(len(c)), np.zeros_like(c), 0.0
        for lo in range(0, len(x), 1000):
            part = x[lo:lo + 1000]
            d = np.maximum((part**2).sum(1)[:, None] + (c**2).sum(1) - 2 * part @ c.T, 0)
            to = (d + charge * count / want).argmin(1)
            loss += d[np.arange(len(part)), to].sum()
            np.add.at(count, to, 1)
            np.add.at(total, to, part)
        some = count > 0
        c[some] = total[some] / count[some, None]
        if (~some).any():  # empty lists split the fullest ones
            full = np.argsort(-count)[:(~some).sum()]
            c[~some] = c[full] + rng.normal(scale=1e-3, size=(len(full), c.shape[1]))
        charge = 0.1 * loss / len(x)
    return c


def neighbour_graph(c: np.ndarray, degree: int = DEGREE, seed: int = 5) -> np.ndarray:
    """For every centroid its nearest others, a few far ones and the next number, so that a search can reach all."""
    n = len(c)
    near, far = min(degree, n - 1), min(4, n - 1)
    rng, out = np.random.default_rng(seed), np.zeros((n, near + far), dtype=np.int64)
    for lo in range(0, n, 512):
        d = (c[lo:lo + 512]**2).sum(1)[:, None] + (c**2).sum(1) - 2 * c[lo:lo + 512] @ c.T
        d[np.arange(len(d)), lo + np.arange(len(d))] = np.inf
        out[lo:lo + 512, :near] = np.argsort(d, axis=1)[:, :near]
    out[:, near:] = rng.integers(0, n, size=(n, far))
    if far:
        out[:, near] = (np.arange(n) + 1) % n  # a ring: no centroid is without a way to it
    return out


def search(q: np.ndarray, c: np.ndarray, graph: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search over the graph for a batch of vectors: ids and distances of ``width`` centroids, nearest first."""
    n, b = len(c), len(q)
    width = min(width, n)
    norm = (c**2).sum(1)
    own = (q**2).sum(1)
    rows = np.arange(b)
    entry = np.unique(np.linspace(0, n - 1, min(n, max(width, 16))).astype(np.int64))
    seen = np.zeros((b, n), dtype=bool)
    seen[:, entry] = True
    ids = np.tile(entry, (b, 1))
    dist = own[:, None] + norm[entry] - 2 * q @ c[entry].T
    best = np.argsort(dist, axis=1, kind="stable")[:, :width]
    ids, dist = np.take_along_axis(ids, best, 1), np.take_along_axis(dist, best, 1)
    done = np.zeros(ids.shape, dtype=bool)
    while True:
        open_ = np.where(done, np.inf, dist)
        at = open_.argmin(1)
        alive = np.isfinite(open_[rows, at])
        if not alive.any():
            break
        done[rows, at] = True
        more = graph[ids[rows, at]]
        d = own[:, None] + norm[more] - 2 * np.einsum("bd,bkd->bk", q, c[more])
        d[seen[rows[:, None], more] | ~alive[:, None]] = np.inf
        seen[rows[:, None], more] = True
        ids, dist = np.concatenate([ids, more], 1), np.concatenate([dist, d], 1)
        done = np.concatenate([done, np.zeros(more.shape, dtype=bool)], 1)
        best = np.argsort(dist, axis=1, kind="stable")[:, :width]
        ids, dist, done = (np.take_along_axis(v, best, 1) for v in (ids, dist, done))
        done |= ~np.isfinite(dist)
    return ids, np.sqrt(np.maximum(dist, 0))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def ratios(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Every vector's distance to every centroid, divided by that to its NEAREST-th one."""
    return _in_units(np.sqrt(np.maximum((q**2).sum(1)[:, None] + (c**2).sum(1) - 2 * q @ c.T, 0)))


def _in_units(d: np.ndarray) -> np.ndarray:
    at = min(NEAREST, d.shape[1]) - 1
    return d / np.maximum(np.partition(d, at, axis=1)[:, at:at + 1], 1e-12)


def within(q: np.ndarray, c: np.ndarray, graph: np.ndarray, reach: float) -> np.ndarray:
    """``ratios`` of the centroids the graph leads to, infinite for all others.

    The search starts from the ``4 * NEAREST`` best found; then every centroid within ``reach``, and a little beyond
    it, of the NEAREST-th distance found so far is expanded, until none is left that was not.
    """
    norm, own = (c**2).sum(1), (q**2).sum(1)
    found = np.full((len(q), len(c)), np.inf)
    ids, dist = search(q, c, graph, 4 * NEAREST)
    np.put_along_axis(found, ids, dist, 1)
    expanded = np.zeros(found.shape, dtype=bool)
    while True:
        at, to = np.nonzero((_in_units(found) <= reach * SLACK) & ~expanded)
        if not len(at):
            return _in_units(found)
        expanded[at, to] = True
        fresh = np.zeros(found.shape, dtype=bool)
        fresh[at[:, None], graph[to]] = True
        at, to = np.nonzero(fresh & np.isinf(found))
        for lo in range(0, len(at), 16_384):
            a, t = at[lo:lo + 16_384], to[lo:lo + 16_384]
            found[a, t] = np.sqrt(np.maximum(own[a] + norm[t] - 2 * np.einsum("pd,pd->p", q[a], c[t]), 0))


def fitted_reach(entries: DataFrame, asked: DataFrame, lists: DataFrame, cent: np.ndarray, graph: np.ndarray, k: int) -> float:
    """The ratio within which sampled queries find the wanted share of their k true neighbours; 1 is the NEAREST lists alone."""
    some = asked.orderBy(F.xxhash64("v"), "c").limit(FITTED).toArrow()
    if not some.num_rows:
        return 1.0
    q = _matrix(some.column("v"))
    held = entries.sparkSession.sparkContext.broadcast((some.column("c").to_numpy(), q))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = held.value
        score, c = np.empty((len(w), 0)), np.empty((len(w), 0), dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                block = batch.slice(lo, BLOCK)
                ids = np.tile(block.column("c").to_numpy(), (len(w), 1))
                new = w @ _matrix(block.column("v")).T
                new[ids == own[:, None]] = -np.inf
                score, c = np.concatenate([score, new], 1), np.concatenate([c, ids], 1)
                if score.shape[1] > k:
                    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
                    score, c = np.take_along_axis(score, best, 1), np.take_along_axis(c, best, 1)
        at, col = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(c[at, col]), pa.array(score[at, col])], names=["q", "c", "score"])

    first = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    true = (entries.select("c", "v").mapInArrow(compare, "q int, c long, score double").withColumn("_n", F.row_number().over(first))
            .where(F.col("_n") <= k).select("q", "c"))  # at most FITTED x k rows
    on = lists.join(F.broadcast(true), "c").groupBy("q", "c").agg(F.collect_set("list").alias("on")).select("q", "on").collect()
    if not on:
        return 1.0
    q = np.column_stack([q, np.zeros(len(q))])
    far = ratios(q, cent)
    need = np.sort([far[r["q"], r["on"]].min() for r in on])
    share = min(1.0, TARGET + 2 * np.sqrt(TARGET * (1 - TARGET) / len(q)))
    reach = max(1.0, float(need[int(np.ceil(share * len(need))) - 1]))
    while reach < far.max():  # what the graph misses within this reach is made up for by a longer one
        got = within(q, cent, graph, reach) <= reach * _EDGE
        if np.mean([got[r["q"], r["on"]].any() for r in on]) >= share:
            break
        reach *= 1.01
    return reach


def _routed(rows: DataFrame, centroids, top: float, reach: float | None = None) -> DataFrame:
    """list, c, near of every row of (c, v): the lists an entry stands on, or those a query reads within its reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cent, graph = centroids.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                block = batch.slice(lo, 500)
                v = _matrix(block.column("v"))
                if reach is not None:
                    far = within(np.column_stack([v, np.zeros(len(v))]), cent, graph, reach)
                    at, to = np.nonzero(far <= reach * _EDGE)
                    near = far[at, to] <= 1
                else:
                    ids, dist = search(np.column_stack([v, np.sqrt(np.maximum(top - (v**2).sum(1), 0))]), cent, graph, 4 * COPIES)
                    at, col = np.nonzero((dist <= CLOSURE * dist[:, :1] + 1e-12) & (np.arange(dist.shape[1]) < COPIES))
                    to, near = ids[at, col], np.ones(len(at), dtype=bool)
                yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), block.column("c").take(pa.array(at)), pa.array(near)],
                                                 names=["list", "c", "near"])
    return rows.select("c", "v").mapInArrow(run, "list int, c long, near boolean")


def classes(rows: DataFrame, k: int) -> DataFrame:
    """c, v, members: equal vectors with their k + 1 smallest (vec_id, rid); rows: vec_id, rid, v."""
    first = Window.partitionBy("v").orderBy("vec_id", "rid")
    few = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    return few.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("vec_id", "rid"))).alias("members")).withColumn(
        "c", F.monotonically_increasing_id())


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows found with the largest inner product for every row where is_query holds."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), F.transform(vectors[embedding], lambda x: x.cast("double") + F.lit(0.0)).alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if usual is None:
        return empty
    rows = stage(rows.where(F.size("v") == usual["d"]).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    entries = stage(classes(rows, k), "entries")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, top = entries.agg(F.count("*"), F.max(square)).first()
    sampled = entries if n <= SAMPLE else entries.where(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int((1 << 20) * SAMPLE / n))
    x = _matrix(sampled.select("c", "v").orderBy("c").limit(2 * SAMPLE).toArrow().column("v"))
    x = np.column_stack([x, np.sqrt(np.maximum(top - (x**2).sum(1), 0))])
    cent = balanced_centroids(x, int(min(MAX_LISTS, max(1, n // LIST_SIZE), len(x))))
    graph = neighbour_graph(cent)
    centroids = spark.sparkContext.broadcast((cent, graph))

    asks = rows.where("asks").select("vec_id", "rid", "v")
    asked = stage(entries.join(asks.select("v").distinct(), "v", "left_semi").select("c", "v"), "asked")
    lists = stage(_routed(entries, centroids, top), "lists")
    reads = stage(_routed(asked, centroids, top, fitted_reach(entries, asked, lists, cent, graph, k)), "reads")
    blocks = lambda t, name: t.groupBy("list").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias(name))
    each = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    own = lambda name: F.pmod(F.xxhash64("c"), F.col(name)).cast("int")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = _matrix(left.column("v")), _matrix(right.column("w"))
        first, c, q, least = (t.column(n).to_numpy() for t, n in ((left, "first"), (left, "c"), (right, "q"), (right, "least")))
        out_q, out_c, out_s, out_f = [], [], [], []
        for i, w in enumerate(b):
            rough = a @ w
            take = np.argsort(-rough)[:k + 13] if len(a) <= k + 13 else np.argpartition(-rough, k + 12)[:k + 13]
            exact = (a[take] * w).sum(axis=1)  # the same order of additions in every task
            cut = np.sort(rough)[-(k + 13)] if len(a) > k + 13 else -np.inf
            if len(a) > k + 13 and (tie := np.flatnonzero(rough >= cut - 1e-9)).size > len(take):
                take, exact = tie, (a[tie] * w).sum(axis=1)
            pick = np.lexsort((first[take], -exact))[:k + 1]
            pick = pick[exact[pick] >= least[i]]
            out_q.append(np.full(len(pick), q[i]))
            out_c.append(c[take][pick])
            out_s.append(exact[pick])
            out_f.append(first[take][pick])
        return pa.table({"q": np.concatenate(out_q), "c": np.concatenate(out_c), "score": np.concatenate(out_s), "first": np.concatenate(out_f)}
                        if out_q and len(a) else {"q": pa.array([], pa.int64()), "c": pa.array([], pa.int64()),
                                                  "score": pa.array([], pa.float64()), "first": pa.array([], pa.int64())})

    by_entry = Window.partitionBy("q").orderBy(F.desc("score"), "first", "c")

    def compared(reads: DataFrame, asked: DataFrame, name: str) -> DataFrame:
        """q, c, score, first: from every list a query reads, its k + 1 best entries that score ``least`` or more."""
        sizes = F.broadcast(stage(blocks(lists, "parts").join(blocks(reads, "turns"), "list"), name))  # a row per list: at most MAX_LISTS
        held = (lists.join(entries.select("c", "v", F.col("members")[0]["vec_id"].alias("first")), "c").join(sizes, "list")
                .withColumn("part", own("parts")).withColumn("turn", each("turns")).select("list", "part", "turn", "c", "v", "first"))
        wanted = (reads.join(asked, "c").join(sizes, "list").withColumn("turn", own("turns")).withColumn("part", each("parts"))
                  .select(F.col("list").alias("l"), F.col("part").alias("p"), F.col("turn").alias("t"), F.col("c").alias("q"), F.col("v").alias("w"), "least"))
        return held.groupBy("list", "part", "turn").cogroup(wanted.groupBy("l", "p", "t")).applyInArrow(best, "q long, c long, score double, first long")

    def best_of(found: DataFrame) -> DataFrame:
        return found.distinct().withColumn("_n", F.row_number().over(by_entry)).where(F.col("_n") <= k + 1).drop("_n")

    none = F.lit(float("-inf"))
    near = stage(best_of(compared(reads.where("near"), asked.withColumn("least", none), "near_sizes")), "near")
    least = near.groupBy(F.col("q").alias("c")).agg(F.when(F.count("*") > k, F.min("score")).otherwise(none).alias("least"))
    bound = stage(asked.join(least, "c", "left").withColumn("least", F.coalesce("least", none)), "bounds")
    tops = best_of(near.unionByName(compared(reads.where(~F.col("near")), bound, "far_sizes")))
    by_row = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "rid")
    merged = (tops.join(entries.select("c", "members"), "c").select("q", "score", F.explode("members").alias("m")).select("q", "score", "m.*")
              .withColumn("_n", F.row_number().over(by_row)).where(F.col("_n") <= k + 1)
              .groupBy("q").agg(F.array_sort(F.collect_list(F.struct("_n", "vec_id", "rid", "score"))).alias("found")))
    answers = stage(merged.join(asked.withColumnRenamed("c", "q"), "q").select("v", "found"), "answers")
    got = asks.join(answers, "v").select(F.col("vec_id").alias("query_id"), F.slice(
        F.filter("found", lambda m: m["rid"] != F.col("rid")), 1, k).alias("found"))
    return got.select("query_id", F.posexplode("found").alias("pos", "m")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("m.vec_id").alias("vec_id"), F.col("m.score").alias("score"))
