"""Source divergence audit: how far the term shares of the sources of a language lie apart, pair by pair.

Terms are counted per (lang, source) inside the tasks before anything moves. Kept terms of a language are numbered in order, and a
group's counts become sorted (term id, count) arrays, one per block of ``BLOCK`` ids. For every unordered pair of groups one task per
block co-groups both arrays: a galloping intersection finds the shared ids, and each of overlap, one-sided and
absent terms is priced once for both directions. Blocks bound what a task holds however many terms there are; a group without
terms in a block takes part with an empty array.

Shares are whole numbers: p = 1 + floor(``UNIT`` (count + ``SMOOTH``) / (N + ``SMOOTH`` V)), N being the group's occurrences of its
language's V kept terms. Everything is exact.

Defined results: null text, lang and source are ''. A text is as many rows as it occurs. A group without terms has the smoothed
share alone; in a language without kept terms all values are 0. Only A-Z are lower-cased. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.sources.staging import lookup_side, stage

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")  # on UTF-8 bytes; all bytes of other letters are above
LEAST_DOCS = 30
UNIT = 1_000_000_000
SMOOTH = 5
TOP = 50
BLOCK = 1 << 16
_HELD = 300_000  # terms a task holds before it hands them on


def counted(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, n, docs: partial counts of the tasks; every group has one row without term."""
    names = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}  # group -> occurrences and documents of its terms
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (in_lang, in_source), (uses, texts) in held.items():
                terms = [None, *(t.decode("utf-8", "replace") for t in uses)]
                columns = [[in_lang] * len(terms), [in_source] * len(terms), terms, [0, *uses.values()], [0, *(texts[t] for t in uses)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, names.types, strict=True)], schema=names)
            held.clear()

        for batch in batches:
            for group, body in zip(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True),
                                   batch.column("body"), strict=True):
                if group not in held:
                    held[group] = Counter(), Counter()
                uses, texts = held[group]
                terms, before = TERM.findall(body.as_py().lower()), len(uses)
                uses.update(terms)
                texts.update(set(terms))
                size += len(uses) - before
                if size >= _HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    none = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    return docs.select(none(lang).alias("lang"), none(source).alias("source"), none(text).cast("binary").alias("body")).mapInArrow(
        run, "lang string, source string, term string, n long, docs long")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT (n + SMOOTH) / (total + SMOOTH terms)), exactly."""
    wide = lambda c: c.cast("decimal(28,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide(n + F.lit(SMOOTH)) * F.lit(UNIT).cast("decimal(10,0)"), wide(total + F.lit(SMOOTH) * terms))


def shares(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same for an array; the quotient is taken in steps of three digits, which stay inside 64 bits."""
    by = total + SMOOTH * terms
    rest, out = n + SMOOTH, np.zeros(len(n), dtype=np.int64)
    for _ in range(3):
        whole, rest = np.divmod(rest * 1000, by)
        out = out * 1000 + whole
    return out + 1


def galloping(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the shared values of two sorted arrays: each value of the shorter one is looked up in the longer one, doubling
    the step from the place of the value before it and then halving; all values advance together."""
    if len(a) > len(b):
        at_b, at_a = galloping(b, a)
        return at_a, at_b
    if not len(a):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    stride = max(1, len(b) // len(a))  # where the values stand if they are spread evenly
    low = np.minimum(np.arange(len(a)) * stride, len(b))
    step = np.full(len(a), 1)
    while (far := (low > 0) & (b[np.minimum(low, len(b) - 1)] > a)).any():  # gallop back to a place not above the value
        low = np.where(far, np.maximum(low - step, 0), low)
        step = np.where(far, step * 2, step)
    high, step = low.copy(), np.full(len(a), 1)
    while (far := (high < len(b)) & (b[np.minimum(high, len(b) - 1)] < a)).any():  # and on to one not below
        low = np.where(far, high, low)
        high = np.where(far, np.minimum(high + step, len(b)), high)
        step = np.where(far, step * 2, step)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        small = b[np.minimum(mid, len(b) - 1)] < a
        low, high = np.where(open_ & small, mid + 1, low), np.where(open_ & ~small, mid, high)
    hit = np.flatnonzero((low < len(b)) & (b[np.minimum(low, len(b) - 1)] == a))
    return hit, low[hit]


def price(ids_a: np.ndarray, n_a: np.ndarray, total_a: int, ids_b: np.ndarray, n_b: np.ndarray, total_b: int, terms: int, of_lang: int) -> int:
    """The sum of |p - q| over the ``terms`` terms of a block, of which the arrays name those that occur."""
    p, q = shares(n_a, total_a, of_lang), shares(n_b, total_b, of_lang)
    none = np.zeros(1, dtype=np.int64)
    p0, q0 = int(shares(none, total_a, of_lang)[0]), int(shares(none, total_b, of_lang)[0])
    at_a, at_b = galloping(ids_a, ids_b)
    both = int(np.abs(p[at_a] - q[at_b]).sum())
    only_a = int(np.abs(p - q0).sum() - np.abs(p[at_a] - q0).sum())
    only_b = int(np.abs(q - p0).sum() - np.abs(q[at_b] - p0).sum())
    return both + only_a + only_b + abs(p0 - q0) * (terms - len(p) - len(q) + len(at_a))


_KEY = ["lang", "a", "b", "block"]


def pair_values(groups: DataFrame, arrays: DataFrame, blocks: DataFrame) -> DataFrame:
    """lang, a, b, value of every unordered pair of groups of a language, a before b.

    groups: lang, source, total, terms; arrays: lang, source, block, ids, counts; blocks: lang, block, size."""
    one, other = (groups.select("lang", F.col("source").alias(c), F.col("total").alias(f"total_{c}"), "terms") for c in "ab")
    pairs = one.join(other.drop("terms"), "lang").where("a < b")  # the result has a row for each
    tasks = stage(pairs.join(blocks, "lang"), "pair_tasks")
    side = lambda c: arrays.select("lang", F.col("source").alias(c), "block", F.col("ids").alias(f"ids_{c}"), F.col("counts").alias(f"counts_{c}"))
    left = tasks.join(side("a"), ["lang", "a", "block"], "left").select(*_KEY, "total_a", "total_b", "terms", "size", "ids_a", "counts_a")
    right = tasks.join(side("b"), ["lang", "b", "block"]).select(*[F.col(c).alias(f"_{c}") for c in _KEY], "ids_b", "counts_b")

    def merge(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        row = {c: mine.column(c)[0].as_py() for c in (*_KEY, "total_a", "total_b", "terms", "size")}
        held = []
        for t, side in ((mine, "a"), (theirs, "b")):
            for c in (f"ids_{side}", f"counts_{side}"):
                found = t.num_rows and t.column(c)[0].is_valid
                held.append(t.column(c)[0].values.to_numpy() if found else np.zeros(0, dtype=np.int64))
        value = price(held[0], held[1], row["total_a"], held[2], held[3], row["total_b"], row["size"], row["terms"])
        return pa.table({**{c: [row[c]] for c in ("lang", "a", "b")}, "value": pa.array([value], pa.int64())})

    merged = left.groupBy(*_KEY).cogroup(right.groupBy(*[f"_{c}" for c in _KEY])).applyInArrow(merge, "lang string, a string, b string, value long")
    priced = merged.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return pairs.select("lang", "a", "b").join(priced, ["lang", "a", "b"], "left").select("lang", "a", "b", F.coalesce("value", F.lit(0).cast("long")).alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, block: int = BLOCK, lang: str = "lang", source: str = "source",
          text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: per group its distance to every other source of the language (part ``pair``), and the
    terms it uses most beyond the language's share (part ``term``, ranks up to ``top``)."""
    counts = stage(counted(docs, lang, source, text).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term_counts")
    words = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")).where(F.col("docs") >= least_docs)
    order = ["lang", "term"]
    numbered = stage(words.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "terms")
    # ids are blocks of a partition's rows: sorted, and dense inside a block
    part, inside = F.shiftright("at", 33), F.expr("at & 8589934591")
    kept = numbered.select("lang", "term", F.col("n").alias("lang_n"), (part * F.lit(1 << 33) + F.floor(inside / F.lit(block))).cast("long").alias("block"),
                           F.pmod(inside, F.lit(block)).alias("id"))
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    found = stage(counts.drop("docs").where("term IS NOT NULL").join(lookup_side(kept, "kept"), ["lang", "term"]), "found")
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = stage(counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms"), F.coalesce("lang_total", zero).alias("lang_total")), "groups")

    sorted_pairs = F.array_sort(F.collect_list(F.struct("id", "n")))  # at most ``block``
    arrays = stage(found.groupBy("lang", "source", "block").agg(sorted_pairs.alias("held")).select(
        "lang", "source", "block", F.col("held.id").alias("ids"), F.col("held.n").alias("counts")), "arrays")
    blocks = kept.groupBy("lang", "block").agg(F.count("*").alias("size"))
    pairs = stage(pair_values(groups.select("lang", "source", "total", "terms"), arrays, blocks), "pairs")
    both_ways = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                       F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = both_ways.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", F.row_number().over(by_value))

    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    more = found.where("n > 0").join(lookup_side(groups, "group_totals"), ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value"))
    tops = more.where("value > 0").withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    return ranked.unionByName(tops.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
