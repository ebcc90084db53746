"""Exact Jaccard join of shingle sets in their metric space (distance 1 - J), and its link components.

1. Rows with equal sets are one class. Only classes take part from here.
2. Almost all pairs of texts are at distance 1, so regions are found from shared shingles: two sets that link
   share, among the first ``prefix`` shingles of one global order, at least a known number. A class whose
   prefix holds too few shared shingles has no link and drops out.
3. Pivots: of the classes that share a prefix shingle, the one with the least key. A pivot's region holds every class
   that shares enough shingles it leads; two classes that link meet in a region, with known distances to its pivot.
4. Inside a region, members within the threshold of the pivot are connected by it and need no comparison among
   each other. Every other member is compared with the members whose distance to the pivot differs from its own
   by no more than the threshold (triangle inequality).
5. A region too large for a task is split: new pivots make Voronoi cells, and a member whose distance to another
   pivot exceeds that to its nearest by at most twice the threshold is copied there. Cells whose members are
   all connected are done; the others are regions again. Where cells do not shrink, blocks of members are
   paired, which bounds every task and loses nothing.

The global order puts shingles that are frequent in a bounded sample last; the sample decides speed only.
A region gives a spanning forest of its links, so hot groups give as many rows as they have members.

Equality of sets and of shingles is that of 64-bit hashes. Defined results: null texts and texts without words
have an empty set and are their own component; a null doc_id counts after all others; repeated rows are
one class. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskframe.llm import shingles as sh
from riskframe.llm.components import components
from riskframe.sources.staging import stage

SAMPLE_DOCS = 20_000  # expected rows of the sample behind the global order
LATE = 100_000  # shingles at most that the order puts last
REGION = 1 << 21  # shingles of a region that one task joins
MEMBERS = 4096  # and classes
PIVOTS = 24
DEPTH = 4
_BITS = 1 << 26  # bits of the filter of classes, at most


def needs(n: int, percent: int) -> tuple[int, int]:
    """(prefix length, shared prefix shingles that a class of n shingles needs at least)."""
    least = -(-percent * n // 100)  # overlap with any partner
    prefix = min(n, n - least + 1 + n // 10)
    return prefix, 1 + min(least // 10, prefix - (n - least + 1))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            block = batch.slice(lo, 1000)
            sets = sh.texts_sets(block.column("text").to_pylist())
            yield block, sets, np.array([sh.set_key(s) for s in sets], dtype=np.int64)


def frequent_shingles(docs: DataFrame, total: int) -> np.ndarray:
    """Shingles that many sampled texts share, ascending; a bounded list."""
    sampled = docs.select("text")
    if total > SAMPLE_DOCS:
        sampled = sampled.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int((1 << 20) * SAMPLE_DOCS / total))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets, keys in _classes(batches):
            _, once = np.unique(keys, return_index=True)
            values, n = np.unique(np.concatenate([sets[i] for i in once]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["s", "n"])

    rows = (sampled.mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where("n >= 8")
            .orderBy(F.desc("n"), "s").limit(LATE).select("s").toArrow())
    return np.sort(rows.column("s").to_numpy().view(np.uint64))


def _prefixes(docs: DataFrame, late, percent: int) -> DataFrame:
    """cid, n, s: the prefix shingles of every class, once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets, keys in _classes(batches):
            cid, size, parts = [], [], []
            for s, k in zip(sets, keys.tolist(), strict=True):
                if not len(s) or k in seen:
                    continue
                seen.add(k)
                length, _ = needs(len(s), percent)
                parts.append(s[sh.order(s, late.value)[:length]])
                cid.append(np.full(length, k, dtype=np.int64))
                size.append(np.full(length, len(s), dtype=np.int32))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cid)), pa.array(np.concatenate(size)),
                                                  pa.array(np.concatenate(parts).view(np.int64))], names=["cid", "n", "s"])
    return docs.select("text").mapInArrow(run, "cid long, n int, s long")


def _filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the classes as 64-bit words; its size is bounded, and false hits only cost time."""
    n = ids.count()
    bits = min(_BITS, 1 << max(10, (16 * n).bit_length()))
    low, high = F.col("cid").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("cid", 32)  # the halves of a hash, see _hit
    at = F.explode(F.array(*[(low + i * high) % bits for i in range(3)]))
    words = (ids.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("m")).toArrow())
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[words.column("w").to_numpy()] = words.column("m").to_numpy().view(np.uint64)
    return out


def _hit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each of the keys."""
    low, high = keys.view(np.uint64) & np.uint64(0xFFFFFFFF), keys.view(np.uint64) >> np.uint64(32)
    ok = np.ones(len(keys), dtype=bool)
    for i in range(3):
        at = (low + np.uint64(i) * high) % np.uint64(len(bits) * 64)
        ok &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return ok


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """cid, n, shingles (little-endian 64-bit) of the classes in ids, and of few others.

    The filter is asked where the sets are made: a second Python step in the same task would need a second worker.
    """
    spark = docs.sparkSession
    words = spark.sparkContext.broadcast(_filter(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets, keys in _classes(batches):
            held = _hit(words.value, keys).tolist()
            fresh = {k: s for k, s, h in zip(keys.tolist(), sets, held, strict=True) if h and len(s) and k not in seen}
            seen.update(fresh)
            yield pa.RecordBatch.from_arrays([pa.array(list(fresh), pa.int64()), pa.array([len(s) for s in fresh.values()], pa.int64()),
                                              pa.array([s.tobytes() for s in fresh.values()], pa.binary())], names=["cid", "n", "shingles"])

    return docs.select("text").mapInArrow(run, "cid long, n long, shingles binary").dropDuplicates(["cid"])


def join_region(ids: np.ndarray, sets: list[np.ndarray], percent: int, tags: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets; the first is the pivot. Exact for any number of sets.

    Members with the same tag (not 0) are connected already. Those that link with the pivot are joined through
    it; every other member is compared with the members of its triangle window that are not connected with it yet.
    """
    m, width, out = len(ids), 1 - percent / 100 + 1e-9, []
    far = np.array([distance_to(sets[0], s) for s in sets])
    by = np.concatenate([[0], 1 + np.argsort(far[1:], kind="stable")])  # from here on in order of distance to the pivot
    ids, far, sets = ids[by], far[by], [sets[i] for i in by]
    size = np.array([len(s) for s in sets])
    ends = np.cumsum(size)
    starts = ends - size
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(int(code.max()) + 1, dtype=np.int64)
    label = np.arange(m)
    if tags is not None:
        tags = tags[by]
        for t in np.unique(tags[tags != 0]):
            label[tags == t] = np.flatnonzero(tags == t)[0]

    def compare(i: int, lo: int, hi: int) -> None:
        """Joins member i with what links with it among the members from lo to hi."""
        open_ = (label[lo:hi] != label[i]) & (100 * np.minimum(size[lo:hi], size[i]) >= percent * np.maximum(size[lo:hi], size[i]))
        if not open_.any():
            return
        own = code[starts[i]:ends[i]]
        mark[own] = 1
        both = np.add.reduceat(mark[code[starts[lo]:ends[hi - 1]]], starts[lo:hi] - starts[lo])
        mark[own] = 0
        for j in lo + np.flatnonzero(open_ & (both > 0) & (100 * both >= percent * (size[lo:hi] + size[i] - both))):
            if label[i] != label[j]:
                out.append((int(ids[i]), int(ids[j])))
                label[label == label[j]] = label[i]

    compare(0, 0, m)
    for i in np.flatnonzero(label != label[0]):
        compare(i, int(np.searchsorted(far, far[i] - width, "left")), int(np.searchsorted(far, far[i] + width, "right")))
    return out


def distance_to(pivot: np.ndarray, s: np.ndarray) -> float:
    return sh.distance(pivot, s)


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype=np.uint64) for b in column.to_pylist()]


def _region_edges(rows: DataFrame, percent: int) -> DataFrame:
    """Links of regions that fit a task; rows: region, cid, lead (1 for the pivot), tag, shingles."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("lead", "descending"), ("cid", "ascending")])
        edges = join_region(group.column("cid").to_numpy(), _arrays(group.column("shingles")), percent, group.column("tag").to_numpy())
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})
    return rows.select("region", "cid", "lead", "tag", "shingles").groupBy("region").applyInArrow(run, "a long, b long")


def _large(members: DataFrame) -> DataFrame:
    """region, its members and the chunks that split it, for regions that do not fit a task."""
    found = members.groupBy("region").agg(F.sum("n").alias("volume"), F.count("*").alias("members")).where(
        (F.col("volume") > REGION) | (F.col("members") > MEMBERS))
    chunks = F.greatest(F.ceil(F.col("volume") / F.lit(REGION / 2)), F.ceil(F.col("members") / F.lit(MEMBERS / 2)))
    return found.select("region", "members", chunks.cast("int").alias("chunks"))


def _pivots(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """The leading member of each large region (0) and new pivots, the first by hash (1, 2, ...).

    A hash threshold comes first, so that few rows are ranked whatever the region's size.
    """
    h = F.xxhash64("region", "cid")
    share = F.least(F.lit(1.0), F.lit(16.0 * PIVOTS) / F.col("members"))
    few = rows.select("region", "cid").join(sizes, "region").where(F.pmod(h, F.lit(1 << 20)) <= share * F.lit(float(1 << 20)))
    new = few.groupBy("region").agg(F.slice(F.array_sort(F.collect_list(F.struct(h.alias("h"), "cid"))), 1, PIVOTS).alias("c"))
    old = rows.groupBy("region").agg(F.max(F.struct("lead", "cid")).alias("c"))
    return new.select("region", F.posexplode("c").alias("k", "c")).select("region", "c.cid", (F.col("k") + 1).alias("k")).union(
        old.select("region", "c.cid", F.lit(0)))


def _cells(rows: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Members of large regions against the pivots: region, cid, cell, lead, tag; or a link to the leading pivot (cell null).

    Chunks of a region meet its pivots in tasks of bounded size. A member goes to the cell of its nearest new pivot
    and is copied to those farther by at most twice the threshold: if x and y link, the cell nearest to x holds y.
    """
    cid_sets = rows.select("region", "cid", "tag", "shingles")
    chunked = cid_sets.join(sizes, "region").withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    centres = (_pivots(rows, sizes).join(cid_sets, ["region", "cid"]).join(sizes, "region")
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    near = 1 - percent / 100 + 1e-9

    def run(own: pa.Table, pivots: pa.Table) -> pa.Table:
        pivots = pivots.sort_by([("k", "ascending")])
        first, first_tag, new = pivots.column("cid")[0].as_py(), pivots.column("tag")[0].as_py(), pivots.column("cid").to_pylist()[1:]
        sets, region, out = _arrays(pivots.column("shingles")), pivots.column("at")[0].as_py(), []
        names = sh.mix(np.array(new, dtype=np.int64).view(np.uint64) ^ sh.mix(np.array([region], dtype=np.int64).view(np.uint64))).view(np.int64)
        for k, tag, x in zip(own.column("cid").to_pylist(), own.column("tag").to_pylist(), _arrays(own.column("shingles")), strict=True):
            d = np.array([sh.distance(x, s) for s in sets])
            if sh.linked(x, sets[0], percent):
                out.append((region, k, None, 0, first))
                tag = first
            elif tag and tag == first_tag:
                tag = first
            out += [(region, k, int(names[j]), int(k == new[j]), tag) for j in np.flatnonzero(d[1:] <= d[1:].min() + 2 * near)]
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.table({c: pa.array(v, t) for (c, t), v in zip(
            {"region": pa.int64(), "cid": pa.int64(), "cell": pa.int64(), "lead": pa.int32(), "tag": pa.int64()}.items(), columns, strict=True)})

    return chunked.select("region", "chunk", "cid", "tag", "shingles").groupBy("region", "chunk").cogroup(
        centres.select(F.col("region").alias("at"), F.col("chunk").alias("part"), "cid", "k", "tag", "shingles").groupBy("at", "part")).applyInArrow(
        run, "region long, cid long, cell long, lead int, tag long")


def _split(rows: DataFrame, sizes: DataFrame, percent: int, recurse: bool) -> tuple[DataFrame, DataFrame]:
    """Links to the pivots of large regions, and smaller regions that cover every pair not connected yet."""
    marks = stage(_cells(rows, sizes, percent), "cells")
    found = marks.where("cell IS NULL").select(F.col("tag").alias("a"), F.col("cid").alias("b"))
    cells = marks.where("cell IS NOT NULL")
    undone = cells.groupBy("region", "cell").agg(F.count("*").alias("n"), F.min("tag").alias("lo"), F.max("tag").alias("hi")).where(
        "n > 1 AND (lo != hi OR lo = 0)")
    copies = undone.groupBy("region").agg(F.sum("n").alias("copies"), F.max("n").alias("most")).join(sizes, "region").select(
        "region", "chunks", (F.lit(recurse) & (F.col("copies") <= 4 * F.col("members")) & (2 * F.col("most") <= F.col("members"))).alias("shrinks"))
    copies = stage(copies, "copies")
    in_cells = cells.join(undone.select("region", "cell"), ["region", "cell"], "left_semi").join(
        copies.where("shrinks").select("region"), "region", "left_semi")
    parts = in_cells.join(rows.select("region", "cid", "n", "shingles"), ["region", "cid"]).select(
        F.col("cell").alias("region"), "cid", "lead", "tag", "n", "shingles")
    # where cells do not shrink: every pair of blocks of members
    tagged = cells.groupBy("region", "cid").agg(F.max("tag").alias("tag")).join(copies.where("NOT shrinks"), "region")
    k = 2 * F.col("chunks")
    mine = tagged.withColumn("i", F.pmod(F.xxhash64("cid", F.lit(3)), k).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), k - 1)))
    blocks = mine.join(rows.select("region", "cid", "n", "shingles"), ["region", "cid"]).select(
        F.xxhash64("region", F.least("i", "j"), F.greatest("i", "j")).alias("region"), "cid", F.lit(0).alias("lead"), "tag", "n", "shingles")
    return found, stage(parts.withColumn("final", F.lit(False)).union(blocks.withColumn("final", F.lit(True))), "regions")


def region_members(docs: DataFrame, percent: int) -> DataFrame:
    """region, cid, n: classes that may link, in the regions of the pivots that lead their shared prefix shingles.

    A pivot is the least class key among those that share a shingle. Keys are hashes, so this is a choice by hash.
    Copies of a class in several tasks only raise its count of shared shingles, so none is missed. The least and the greatest
    key of a shingle are combined inside the tasks, and the join back splits a shingle that many classes hold (AQE), so no
    shingle's classes meet in one task.
    """
    late = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, docs.count()))
    prefixes = _prefixes(docs, late, percent)  # made twice, which costs less than keeping them
    leads = stage(prefixes.groupBy("s").agg(F.min("cid").alias("region"), F.max("cid").alias("last")).where("region != last").select("s", "region"), "leads")
    shared = stage(prefixes.join(leads, "s").groupBy("region", "cid", "n").agg(F.count("*").alias("shared")), "shared")
    least, prefix = f"ceil({percent} * n / 100)", f"least(n, n - ceil({percent} * n / 100) + 1 + floor(n / 10))"
    need = f"(1 + least(floor({least} / 10), {prefix} - (n - {least} + 1)))"
    able = shared.groupBy("cid", "n").agg(F.sum("shared").alias("all")).where(f"all >= {need}").select("cid")
    # a class leaves the regions where it shares least, while they hold less than half of what it needs: two classes that
    # link share what either needs, so the regions that one or the other leaves cannot hold all of it
    weak = Window.partitionBy("cid").orderBy("shared", "region").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    members = shared.join(able, "cid", "left_semi").withColumn("so_far", F.sum("shared").over(weak)).where(
        f"so_far > floor(({need} - 1) / 2)").select("region", "cid", "n")
    several = members.groupBy("region").agg(F.count("*").alias("m")).where("m > 1").select("region")
    return stage(members.join(several, "region", "left_semi"), "members")


def links(docs: DataFrame, percent: int = 75) -> DataFrame:
    """a, b: links between classes of equal sets that connect every component; docs: text. Ids are set keys."""
    members = region_members(docs, percent)
    sets = _sets(docs, members.select("cid").distinct())
    rows = members.select("region", "cid").join(sets, "cid").select(
        "region", "cid", (F.col("region") == F.col("cid")).cast("int").alias("lead"), F.lit(0).cast("long").alias("tag"), "n", "shingles",
        F.lit(False).alias("final"))
    sizes = stage(_large(members), "large")
    if sizes.isEmpty():
        return stage(_region_edges(rows, percent), "links")
    rows, out = stage(rows, "regions"), None
    for depth in range(DEPTH):
        fits = rows.join(sizes.select("region"), "region", "left_anti")
        edges = stage(_region_edges(fits, percent), "links")
        out = edges if out is None else out.union(edges)
        if sizes.isEmpty():
            break
        found, rows = _split(rows.join(sizes.select("region"), "region", "left_semi"), sizes, percent, depth < DEPTH - 2)
        out = out.union(found)
        sizes = stage(_large(rows.where("NOT final")), "large")
    return out


def _tagged(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """row (all columns of docs), doc_id, n_shingles, cid."""
    def run(texts: pd.Series) -> pd.DataFrame:
        n, keys = [], []
        for t in texts:
            s = sh.shingle_set(t)
            n.append(len(s))
            keys.append(sh.set_key(s))
        return pd.DataFrame({"n": np.array(n, dtype=np.int64), "cid": np.array(keys, dtype=np.int64)})

    keyed = F.pandas_udf(run, "n long, cid long")
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc_id].alias("doc_id"),
                       keyed(docs[text]).alias("k")).select("row", "doc_id", F.col("k.n").alias("n_shingles"), F.col("k.cid").alias("cid"))


def _named(meta: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """cid, root and the first doc_id of every class that has shingles."""
    roots = stage(components(links(docs, percent)), "roots")
    firsts = meta.where("n_shingles > 0").groupBy("cid").agg(F.min("doc_id").alias("first"))
    return firsts.join(roots, firsts["cid"] == roots["node"], "left").select("cid", "first", F.coalesce("root", "cid").alias("root"))


def with_components(docs: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    texts = docs.select(docs[text].alias("text"))
    meta = stage(_tagged(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), "text", "doc_id")
                 .select("doc_id", "n_shingles", "cid"), "classes")
    named = stage(_named(meta, texts, percent), "named")
    best = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = named.join(best, "root").select("cid", "component_id")
    return meta.join(of_class, "cid", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs without all but the first (by doc_id) of each component; rows without shingles all stay."""
    tagged = _tagged(docs, text, doc_id)
    meta = stage(tagged.select("doc_id", "n_shingles", "cid"), "classes")
    named = _named(meta, docs.select(docs[text].alias("text")), percent)
    winners = named.groupBy("root").agg(F.min(F.struct(F.col("first").isNull().alias("no"), "first", "cid")).alias("w")).select(
        F.col("w.first").alias("id"), F.col("w.cid").alias("key"))
    kept = tagged.where("n_shingles > 0").join(winners, (F.col("cid") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    return kept.dropDuplicates(["doc_id", "cid"]).select("row.*").unionByName(tagged.where("n_shingles = 0").select("row.*"))
