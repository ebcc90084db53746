"""Removal of repeated passages: Burrows-Wheeler orders of shards, merged by iterative interleave refinement.

Every byte goes that is covered by a string of ``length`` bytes which also starts anywhere else, in the same text or another.

1. Anchors. The smallest hash of the grams of ``length`` bytes is the same in equal strings, so strings whose smallest hash occurs
   at one place of the corpus alone cannot repeat. What is left, cut to segments, is usually a small part. No repeat is lost.
2. Shards. Segments that share anchors are laid near each other and cut to shards of about ``SHARD_BYTES``, so that most copies
   meet in one shard. Each is sorted once, by doubling, to the depth of ``length``: its Burrows-Wheeler order. Neighbours
   in that order that agree to a depth (common prefixes) form one interval of that depth. An interval of the full depth
   with two places is a repeat already.
3. Merge. Only strings go on whose anchor, and the anchors of whose parts, lie in several shards. The interleave of all shards is first known to the smallest depth:
   intervals are put in the order of their first bytes, and equal ones share a place. An interval of the next depth is
   the row of the places of the intervals that start 0, 1, 2 and 3 depths further on in its shard (what as many LF steps lead to),
   so sorting these rows refines the interleave to four times the depth. Suffixes are not sorted again, and intervals alone
   at their place go no further. Those that share a place at the full depth repeat.

Equal texts are one class; with two or more rows all of it is repeated, if it has ``length`` bytes. A shard's intervals
are one row each per depth, so a passage that is in very many texts is counted per shard, not per text.

Defined results: null and empty texts have no bytes, and nothing is removed (the digest is that of the empty string). Rows with a
null or repeated doc_id are rows of their own. An empty table gives an empty result. Extra columns are ignored. Texts beyond
the size of a shard are cut with an overlap, so each string of ``length`` bytes starts in exactly one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskframe.sources.staging import lookup_side, stage

LENGTH = 400
SHARD_BYTES = 1 << 20
BASE = 32  # the smallest depth is at most this
FAN = 4  # depths grow by this factor
_MULTIPLIER = 0x9E3779B97F4A7C15
_SLICE = 1 << 22  # bytes hashed at a time


def depths(length: int) -> list[int]:
    """The depths of the interleave, smallest first."""
    out = [length]
    while out[0] > BASE:
        out.insert(0, -(-out[0] // FAN))
    return out


def shifts(small: int, large: int) -> list[int]:
    """Where strings of the small depth start that cover one of the large depth."""
    return [min(j * small, large - small) for j in range(-(-large // small))]


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the gram at every place; equal grams have equal hashes."""
    n = len(b)
    with np.errstate(over="ignore"):
        up = np.full(n, _MULTIPLIER, dtype=np.uint64)
        up[0] = 1
        down = np.full(n, pow(_MULTIPLIER, -1, 1 << 64), dtype=np.uint64)
        down[0] = 1
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(up), out=sums[1:])
        h = (sums[gram:] - sums[:-gram]) * np.multiply.accumulate(down)[:n - gram + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def sliding_min(h: np.ndarray, k: int) -> np.ndarray:
    """The smallest of every k values in a row."""
    n = len(h)
    x = np.full(-(-n // k) * k, np.iinfo(h.dtype).max, dtype=h.dtype)
    x[:n] = h
    x = x.reshape(-1, k)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - k + 1], ahead[k - 1:n])


def anchors(body: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """value, start, n, many: runs of n strings in a row with one smallest hash; many says that it has several places in the text."""
    gram = max(1, length * 4 // 25)
    k = length - gram + 1
    parts = []
    for lo in range(0, len(body) - length + 1, _SLICE):
        h = gram_hashes(np.frombuffer(body, dtype=np.uint8, count=min(len(body) - lo, _SLICE + length - 1), offset=lo), gram)
        least = sliding_min(h, k)
        top = np.full(len(least) + 2 * (k - 1), np.uint64(0), dtype=np.uint64)
        top[k - 1:k - 1 + len(least)] = least
        places = h[~sliding_min(~top, k) == h]  # grams that are smallest in some string
        at = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        value, inverse, count = np.unique(places, return_inverse=True, return_counts=True)
        parts.append((least[at], lo + at, np.diff(np.append(at, len(least))), count[np.searchsorted(value, least[at])] > 1))
    value, start, n, many = (np.concatenate(p) for p in zip(*parts, strict=True))
    _, inverse, count = np.unique(value, return_inverse=True, return_counts=True)
    return value.view(np.int64), start, n, many | (count[inverse] > 1)


def _runs(length: int):
    """Arrow function: the anchors of each text of a partition, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            h1, h2 = batch.column("h1").to_pylist(), batch.column("h2").to_pylist()
            for i, body in enumerate(batch.column("body")):
                if (h1[i], h2[i]) in seen:
                    continue
                if len(seen) < 100_000:  # copies beyond are only found again later
                    seen.add((h1[i], h2[i]))
                value, start, n, many = anchors(body.as_py(), length)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), h1[i])), pa.array(np.full(len(value), h2[i])), pa.array(value),
                                                  pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(many)],
                                                 names=["h1", "h2", "value", "start", "n", "many"])
    return run


_RUNS = "array<struct<start:int,n:int,value:long>>"
_SPAN = f"h1 long, h2 long, at int, n int, key long, runs {_RUNS}"
_BODY = "shard long, sid long, at int, body binary, opened array<struct<start:int,n:int>>"
_RUNS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("value", pa.int64())]))


def _spans(length: int, shard_bytes: int):
    """Arrow function: the strings of a text that may repeat, as segments of at most a shard; n is the number of strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h1, h2, held in zip(batch.column("h1").to_pylist(), batch.column("h2").to_pylist(), batch.column("runs"), strict=True):
                start, n, value = (held.values.field(f).to_numpy() for f in ("start", "n", "value"))
                order = np.argsort(start)
                start, n, value = start[order].astype(np.int64), n[order].astype(np.int64), value[order]
                joined = np.append(np.flatnonzero(np.concatenate([[True], start[1:] > start[:-1] + n[:-1] + length])), len(start))
                for a, z in zip(joined[:-1], joined[1:], strict=True):
                    first, last = int(start[a]), int(start[z - 1] + n[z - 1])  # strings start in [first, last)
                    for lo in range(first, last, shard_bytes):
                        hi = min(last, lo + shard_bytes)
                        here = [{"start": max(int(s), lo), "n": min(int(s + m), hi) - max(int(s), lo), "value": int(v)}
                                for s, m, v in zip(start[a:z], n[a:z], value[a:z], strict=True) if s < hi and s + m > lo]
                        if here:
                            out.append((h1, h2, lo, hi - lo, min(r["value"] for r in here), here))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), _RUNS_TYPE], strict=True)],
                    names=["h1", "h2", "at", "n", "key", "runs"])
    return run


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds part, the partition, and before, the bytes of the rows of the partition before a row."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        size = batch.column("size").to_numpy()
        ends = before + np.cumsum(size)
        yield pa.RecordBatch.from_arrays([batch.column("sid"), batch.column("size"), pa.array(np.full(len(size), part, dtype=np.int32)), pa.array(ends - size)],
                                         names=["sid", "size", "part", "before"])
        before = int(ends[-1]) if len(ends) else before


def sharded(spans: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """sid, shard of every segment: segments are put in order so that those that share anchors are near, and cut by prefix sums of bytes.

    The order is that of the smallest anchor of all segments that share one with a segment, then of its own smallest anchor."""
    held = spans.select("sid", "key", F.explode("runs.value").alias("value"))
    least = held.groupBy("value").agg(F.min("key").alias("near"))
    near = held.select("sid", "value").join(lookup_side(least, "least"), "value").groupBy("sid").agg(F.min("near").alias("near"))
    rows = spans.select("sid", "key", (F.col("n") + (length - 1)).cast("long").alias("size")).join(near, "sid")
    order = ["near", "key", "sid"]
    at = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("sid", "size").mapInArrow(
        _running, "sid long, size long, part int, before long"), "order")
    totals = at.groupBy("part").agg(F.max(F.col("before") + F.col("size")).alias("n")).orderBy("part").collect()  # a row per partition
    first = np.cumsum([0, *(r["n"] for r in totals)])
    bases = at.sparkSession.createDataFrame([(r["part"], int(b)) for r, b in zip(totals, first, strict=False)], "part int, base long")
    return at.join(F.broadcast(bases), "part").select("sid", F.floor((F.col("base") + F.col("before")) / F.lit(shard_bytes)).cast("long").alias("shard"))


def _bodies(length: int):
    """Arrow function: the bytes of a text's segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                body, held = batch.column("body")[row].as_buffer(), batch.column("segments")[row].values
                at, n = (held.field(c).to_numpy() for c in ("at", "n"))
                cut = [body.slice(int(a), int(m) + length - 1).to_pybytes() for a, m in zip(at, n, strict=True)]
                yield pa.RecordBatch.from_arrays([held.field("shard"), held.field("sid"), held.field("at"), pa.array(cut, pa.binary()), held.field("opened")],
                                                 names=["shard", "sid", "at", "body", "opened"])
    return run


def part_anchors(b: np.ndarray, length: int) -> np.ndarray:
    """For every place the smallest hash in the part (a string of the depth before the last) that starts there."""
    part = depths(length)[-2]
    gram = max(1, part * 16 // 25)
    return sliding_min(gram_hashes(b, gram), part - gram + 1).view(np.int64)


def _parts(length: int):
    """Arrow function: shard and value of the anchors of the parts of strings whose own anchor several shards hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                body, segments = np.frombuffer(batch.column("body")[row].as_buffer(), dtype=np.uint8), batch.column("segments")[row].as_py()
                for one in segments:
                    values = [part_anchors(body[r["start"]:r["start"] + r["n"] + length - 1], length) for r in one["opened"]]
                    if values:
                        got = np.unique(np.concatenate(values))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), one["shard"])), pa.array(got)], names=["shard", "value"])
    return run


def _ranks(key: np.ndarray) -> np.ndarray:
    """For every key the number of smaller ones: the start of its interval."""
    order = np.argsort(key)
    starts = np.flatnonzero(np.concatenate([[True], key[order[1:]] != key[order[:-1]]]))
    out = np.empty(len(key), dtype=np.int32)
    out[order] = np.repeat(starts.astype(np.int32), np.diff(np.append(starts, len(key))))
    return out


def suffix_intervals(b: np.ndarray, wanted: list[int]) -> dict[int, np.ndarray]:
    """Depth -> for every place the start, in the shard's Burrows-Wheeler order, of the interval of suffixes that agree to that depth."""
    n, deep = len(b), min(8, wanted[0])
    padded = np.concatenate([b, np.zeros(8, dtype=np.uint8)])
    key = np.zeros(n, dtype=np.uint64)
    for j in range(deep):
        key = (key << np.uint64(8)) | padded[j:n + j]
    rank, out = _ranks(key), {}
    for target in wanted:
        while deep < target:
            by = min(deep, target - deep)
            key = rank.astype(np.uint64) << np.uint64(32)
            key[:n - by] |= rank[by:].astype(np.uint64) + np.uint64(1)
            rank, deep = _ranks(key), deep + by
        out[target] = rank
    return out


_BUILT = "level int, shard long, cls int, label binary, parts array<int>, sid long, at int, until int"
_LOCAL = -1  # level of repeats that one shard shows


def _built(length: int):
    """Arrow function on a shard and those anchors of parts that other shards hold too: repeats inside it, and the intervals of every depth that the merge needs."""
    levels = depths(length)
    fields = [("level", pa.int32()), ("shard", pa.int64()), ("cls", pa.int32()), ("label", pa.binary()), ("parts", pa.list_(pa.int32())),
              ("sid", pa.int64()), ("at", pa.int32()), ("until", pa.int32())]

    def rows(n: int, **given) -> pa.Table:
        return pa.table([given[name] if name in given else pa.nulls(n, kind) for name, kind in fields], schema=pa.schema(fields))

    def build(segments: pa.Table, opened: pa.Table) -> pa.Table:
        segments = segments.combine_chunks()
        bodies = [x.as_buffer() for x in segments.column("body")]
        size = np.array([x.size for x in bodies])
        first = np.cumsum(size) - size
        b = np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in bodies])
        n, shard = len(b), segments.column("shard")[0].as_py()
        of = np.repeat(np.arange(len(size)), size)
        rest = (first + size)[of] - np.arange(n)
        cls = suffix_intervals(b, levels)
        whole = np.flatnonzero(rest >= length)
        local = np.bincount(cls[length][whole], minlength=n)[cls[length]] > 1
        local &= rest >= length
        at = segments.column("at").to_numpy().astype(np.int64)
        text_place = at[of] + np.arange(n) - first[of]
        sid = segments.column("sid").to_numpy()

        begins = np.flatnonzero(local & ~np.concatenate([[False], local[:-1] & (of[1:] == of[:-1])]))
        ends = np.flatnonzero(local & ~np.concatenate([local[1:] & (of[1:] == of[:-1]), [False]]))
        out = [rows(len(begins), level=pa.array(np.full(len(begins), _LOCAL, dtype=np.int32)), sid=pa.array(sid[of[begins]]),
                    at=pa.array(text_place[begins].astype(np.int32)), until=pa.array((text_place[ends] + 1).astype(np.int32)))]
        if not opened.num_rows and len(levels) > 1:
            return out[0]
        runs = segments.column("opened").combine_chunks()
        owner = np.repeat(np.arange(len(size)), runs.value_lengths().to_numpy())
        start, count = (runs.flatten().field(f).to_numpy() for f in ("start", "n"))
        begin, edge = first[owner] + start - at[owner], np.zeros(n + 1, dtype=np.int32)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + count, -1)
        mask = np.cumsum(edge[:n]) > 0  # strings of the full depth that other shards may hold
        if len(levels) > 1:  # all their parts must be there too
            fine = part_anchors(b, length)
            held = np.zeros(n, dtype=bool)
            held[:len(fine)] = np.isin(fine, opened.column("value").to_numpy())
            for step in shifts(levels[-2], length):
                mask[:n - step] &= held[step:]
        for level in range(len(levels) - 1, -1, -1):
            depth = levels[level]
            places = np.flatnonzero(mask)
            got, one = np.unique(cls[depth][places], return_index=True)
            one = places[one]
            given = {"level": pa.array(np.full(len(got), level, dtype=np.int32)), "shard": pa.array(np.full(len(got), shard)), "cls": pa.array(got)}
            if level == 0:
                text = np.lib.stride_tricks.sliding_window_view(b, depth)[one]
                given["label"] = pa.FixedSizeBinaryArray.from_buffers(pa.binary(depth), len(one), [None, pa.py_buffer(text.tobytes())]).cast(pa.binary())
            else:
                steps = shifts(levels[level - 1], depth)
                parts = cls[levels[level - 1]][one[:, None] + np.array(steps)]
                given["parts"] = pa.ListArray.from_arrays(np.arange(0, parts.size + 1, len(steps), dtype=np.int32), parts.ravel())
                wider = np.zeros(n, dtype=bool)
                for s in steps:
                    wider[s:] |= mask[:n - s]
                mask = wider
            if level == len(levels) - 1:
                single = ~local[one]  # the places of others are repeats already
                given |= {"sid": pa.array(sid[of[one]], mask=~single), "at": pa.array(text_place[one].astype(np.int32), mask=~single)}
            out.append(rows(len(got), **given))
        return pa.concat_tables(out)
    return build


def _places(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """The intervals that several shards hold, with their place in the merged order, in place of the columns ``by``.

    A shard has one row per interval, so a group has at most as many rows as there are shards."""
    same = Window.partitionBy(*by)
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    shared = ordered.withColumn("_n", F.count("*").over(same)).withColumn("place", F.min("_at").over(same)).where("_n > 1")
    return stage(shared.drop("_at", "_n", *by), name)


def _refined(rows: DataFrame, known: DataFrame, width: int) -> DataFrame:
    """shard, cls, p0 .. and, at the full depth, sid and at: intervals by the places of their parts, where all have one."""
    names = [f"p{j}" for j in range(width)]

    def look_up(mine: pa.Table, places: pa.Table) -> pa.Table:
        cls, place = places.column("cls").to_numpy(), places.column("place").to_numpy()
        order = np.argsort(cls)
        cls, place = cls[order], place[order]
        parts = mine.column("parts").combine_chunks().flatten().to_numpy().reshape(-1, width) if mine.num_rows else np.empty((0, width), dtype=np.int32)
        at = np.minimum(np.searchsorted(cls, parts), max(len(cls) - 1, 0))
        held = (cls[at] == parts).all(axis=1) if len(cls) else np.zeros(len(parts), dtype=bool)
        kept = mine.filter(pa.array(held))
        got = place[at[held]] if len(cls) else np.empty((0, width), dtype=np.int64)
        return pa.table({**{c: kept.column(c) for c in ("shard", "cls", "sid", "at")}, **{c: got[:, j] for j, c in enumerate(names)}})

    return rows.select("shard", "cls", "parts", "sid", "at").groupBy("shard").cogroup(
        known.select(F.col("shard").alias("on"), "cls", "place").groupBy("on")).applyInArrow(
        look_up, "shard long, cls int, sid long, at int, " + ", ".join(f"{c} long" for c in names))


def merge_shards(built: DataFrame, length: int) -> DataFrame:
    """sid, at, until: strings of the full depth that stand once in their shard and in another one too."""
    levels = depths(length)
    known = _places(built.where("level = 0").select("shard", "cls", "label", *(["sid", "at"] if len(levels) == 1 else [])), ["label"], "places")
    for level in range(1, len(levels)):
        width = len(shifts(levels[level - 1], levels[level]))
        rows = stage(_refined(built.where(F.col("level") == level), known, width), "refined")
        known = _places(rows, [f"p{j}" for j in range(width)], "places")
    return known.where("at IS NOT NULL").select("sid", "at", (F.col("at") + 1).alias("until"))


_KEPT = "h1 long, h2 long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def _cut(length: int, with_text: bool):
    """Arrow function: takes the covered bytes out of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                body, found = batch.column("body")[row].as_py(), batch.column("found")[row].values
                at, until = (found.field(c).to_numpy().astype(np.int64) for c in ("at", "until"))
                order = np.argsort(at)
                at, end = at[order], np.maximum.accumulate(until[order] + length - 1)
                new = np.flatnonzero(np.concatenate([[True], at[1:] > end[:-1]]))
                start, end = at[new], end[np.append(new[1:] - 1, len(at) - 1)]
                kept = b"".join(body[a:z] for a, z in zip([0, *end], [*start, len(body)], strict=True))
                out.append((batch.column("h1")[row].as_py(), batch.column("h2")[row].as_py(), int((end - start).sum()), len(start), hashlib.sha256(kept).hexdigest(),
                            [{"start": int(a), "end": int(z)} for a, z in zip(start, end, strict=True)], *([kept] if with_text else [])))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=False)],
                                                 names=["h1", "h2", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][:len(out[0])])
    return run


def cut_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES,
                with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed bytes, end exclusive) and, if wanted, kept (the other bytes)."""
    body = F.coalesce(docs[text].cast("binary"), F.lit(b""))
    rows = docs.select(docs[doc_id].alias("doc_id"), body.alias("body")).withColumn("digest", F.sha2("body", 256)).withColumn(
        "h1", F.xxhash64("digest")).withColumn("h2", F.xxhash64(F.lit(length), "digest")).withColumn("n_bytes", F.octet_length("body").cast("long"))
    long = rows.where(F.col("n_bytes") >= length)

    runs = stage(long.select("h1", "h2", "body").mapInArrow(_runs(length), "h1 long, h2 long, value long, start int, n int, many boolean"), "anchors")
    shared = runs.groupBy("value").agg(F.min("h1").alias("a"), F.max("h1").alias("z"), F.max("many").alias("many")).where("many OR a <> z").select("value")
    marked = runs.join(lookup_side(shared, "shared"), "value").groupBy("h1", "h2").agg(F.collect_set(F.struct("start", "n", "value")).alias("runs"))
    spans = stage(marked.mapInArrow(_spans(length, shard_bytes), _SPAN).withColumn("sid", F.monotonically_increasing_id()), "spans")
    placed = stage(spans.drop("key").join(sharded(spans, length, shard_bytes), "sid"), "placed")
    held = placed.select("sid", "shard", F.explode("runs").alias("r")).select("sid", "shard", "r.start", "r.n", "r.value")
    several = held.groupBy("value").agg(F.min("shard").alias("a"), F.max("shard").alias("z")).where("a < z").select("value")
    opened = held.join(lookup_side(several, "several"), "value").groupBy("sid").agg(F.collect_list(F.struct("start", "n")).alias("opened"))
    segments = placed.drop("runs", "key").join(opened, "sid", "left").groupBy("h1", "h2").agg(F.collect_list(F.struct(
        "shard", "sid", "at", "n", F.coalesce("opened", F.array().cast("array<struct<start:int,n:int>>")).alias("opened"))).alias("segments"))
    texts = stage(long.groupBy("h1", "h2").agg(F.first("body").alias("body")).join(segments, ["h1", "h2"]), "texts")

    parts = texts.select("body", F.filter("segments", lambda x: F.size(x["opened"]) > 0).alias("segments")).where(F.size("segments") > 0)
    if len(depths(length)) > 1:
        parts = stage(parts.mapInArrow(_parts(length), "shard long, value long").distinct(), "parts")
        several = parts.groupBy("value").agg(F.count("*").alias("shards")).where("shards > 1").select("value")
        parts = parts.join(lookup_side(several, "several"), "value").select(F.col("shard").alias("on"), "value")
    else:
        parts = parts.select(F.lit(0).cast("long").alias("on"), F.lit(0).cast("long").alias("value")).limit(0)
    built = stage(texts.select("body", "segments").mapInArrow(_bodies(length), _BODY).groupBy("shard").cogroup(parts.groupBy("on")).applyInArrow(
        _built(length), _BUILT), "intervals")

    found = built.where(F.col("level") == _LOCAL).select("sid", "at", "until").unionByName(merge_shards(built, length))
    found = found.join(lookup_side(placed.select("sid", "h1", "h2"), "owners"), "sid")
    spans = found.groupBy("h1", "h2").agg(F.collect_list(F.struct("at", "until")).alias("found"))
    single = texts.select("h1", "h2", "body").join(spans, ["h1", "h2"]).mapInArrow(_cut(length, with_text), _KEPT + (", kept binary" if with_text else ""))
    copied = long.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("n_bytes").alias("n_bytes")).where("n > 1")
    nothing = [F.lit(b"").alias("kept")] if with_text else []
    whole = copied.select("h1", "h2", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(b""), 256).alias("kept_sha256"),
                          F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))).alias("spans"), *nothing)
    changed = single.join(copied, ["h1", "h2"], "left_anti").unionByName(whole)
    out = rows.join(lookup_side(changed, "changed"), ["h1", "h2"], "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
                      F.coalesce("kept_sha256", "digest").alias("kept_sha256"),
                      F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
                      *([F.coalesce("kept", "body").alias("kept")] if with_text else []))
