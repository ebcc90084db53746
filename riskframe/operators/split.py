"""Reproducible splits, samples and folds.

Rows are ordered by a portable 60-bit hash of (seed, id). A split needs only
the hash value below which the wanted number of rows lies, per stratum. That value
is found by radix selection on a table of (stratum, prefix, rows still wanted): each pass counts the next
``_STEP`` bits of the rows under an open prefix and keeps the child that holds the wanted row, so there are at most four passes
and the number of strata is not bounded by the driver. With few strata the split itself is a predicate: no sort, no window, no
shuffle; with many, the hash values are joined by stratum.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.hashing import HASH_BITS, hash60
from riskframe.functions.order import numbered
from riskframe.functions.scalars import col
from riskframe.sources.staging import lookup_side, stage

_FULL = 1 << HASH_BITS
_STEP = 15  # bits per pass
FEW = 256  # hash values that become literals of the predicate; more are joined


def largest_remainder(counts: Mapping, total: int) -> dict:
    """Shares of ``total`` proportional to the counts; ties go to the first class."""
    n = sum(counts.values())
    if n == 0:
        return {k: 0 for k in counts}
    exact = {k: c * total / n for k, c in counts.items()}
    out = {k: math.floor(v) for k, v in exact.items()}
    rest = total - sum(out.values())
    order = sorted(counts, key=lambda k: (-(exact[k] - out[k]), str(k)))
    for k in order[:rest]:
        out[k] += 1
    return out


def _few(rows: DataFrame) -> list | None:
    """The rows, where they are at most FEW."""
    some = rows.limit(FEW + 1).collect()
    return some if len(some) <= FEW else None


def _local(rows: DataFrame, some: list) -> DataFrame:
    """The collected rows as a table that costs no job."""
    return rows.sparkSession.createDataFrame([tuple(r) for r in some], rows.schema)


def strata(df: DataFrame, stratum: Column) -> DataFrame:
    """``s, n``: rows per stratum (as text; null is one), stored where they are many."""
    counts = df.groupBy(stratum.cast("string").alias("s")).agg(F.count("*").alias("n"))
    some = _few(counts)
    return stage(counts, "strata") if some is None else _local(counts, some)


def _total(counts: DataFrame) -> tuple[int, int, int]:
    """Rows, strata and the rows of the smallest one."""
    r = counts.agg(F.sum("n"), F.count("*"), F.min("n")).first()
    return r[0] or 0, r[1], r[2] or 0


def quotas(counts: DataFrame, total: int) -> DataFrame:
    """``s, n, quota``: ``largest_remainder`` on a table of any number of strata."""
    some = _few(counts)
    if some is not None:
        share = largest_remainder({r["s"]: r["n"] for r in some}, total)
        return counts.sparkSession.createDataFrame([(*r, share[r["s"]]) for r in some], "s string, n long, quota long")
    exact = (F.col("n") * F.lit(total)).cast("double") / F.lit(float(max(1, _total(counts)[0])))
    base = counts.withColumn("_exact", exact).withColumn("quota", F.floor("_exact"))
    rest = total - (base.agg(F.sum("quota")).first()[0] or 0)
    if rest <= 0:
        return base.select("s", "n", "quota")
    placed = numbered(base.withColumn("_gap", F.col("quota") - F.col("_exact")).withColumn("_name", F.coalesce("s", F.lit("None"))), ["_gap", "_name"], "_at")
    return placed.select("s", "n", (F.col("quota") + F.when(F.col("_at") < rest, 1).otherwise(0)).alias("quota"))


def hash_cuts(df: DataFrame, key: Column, stratum: Column, bounds: DataFrame, seed: int) -> DataFrame:
    """``s, i, cut, extra``, stored; bounds: ``s, i, wanted, n``.

    Exactly ``wanted`` rows of the stratum have a hash below ``cut`` or are among the first ``extra`` rows (by key) at it."""
    src = df.select(stratum.cast("string").alias("s"), hash60(key, seed).alias("h"))
    some = _few(bounds.select("s", "i", "wanted", "n"))
    if some is not None:  # the open rows stay on the driver, which saves jobs and changes nothing else
        cuts = [(r["s"], r["i"], 0 if r["wanted"] <= 0 else _FULL, 0) for r in some if r["wanted"] <= 0 or r["wanted"] >= r["n"]]
        open_ = [(r["s"], r["i"], 0, r["wanted"]) for r in some if 0 < r["wanted"] < r["n"]]
        for shift in range(HASH_BITS - _STEP, -1, -_STEP):
            if not open_:
                break
            found = _children(src, df.sparkSession.createDataFrame(open_, "s string, i int, prefix long, left long"), shift, stored=False).collect()
            for r in found:
                if r["left"] == r["n"] or shift == 0:
                    whole = r["left"] == r["n"]  # all rows under the prefix
                    cuts.append((r["s"], r["i"], (r["prefix"] + 1) << shift if whole else r["prefix"], 0 if whole else r["left"]))
            open_ = [tuple(r)[:4] for r in found if r["left"] != r["n"] and shift]
        return df.sparkSession.createDataFrame(cuts, "s string, i int, cut long, extra long")
    edge = F.when(F.col("wanted") <= 0, F.lit(0)).when(F.col("wanted") >= F.col("n"), F.lit(_FULL)).cast("long")
    none = F.lit(0).cast("long")
    rows = stage(bounds.select("s", "i", edge.alias("cut"), none.alias("extra"), none.alias("prefix"), F.col("wanted").cast("long").alias("left")), "bounds")
    done = [rows.where("cut IS NOT NULL").select("s", "i", "cut", "extra")]
    rows = rows.where("cut IS NULL").select("s", "i", "prefix", "left")
    for shift in range(HASH_BITS - _STEP, -1, -_STEP):
        if rows.isEmpty():
            break
        found = stage(_children(src, rows, shift), "found")
        whole = F.col("left") == F.col("n")
        done.append(found.where(whole).select("s", "i", F.shiftleft(F.col("prefix") + 1, shift).alias("cut"), none.alias("extra")))
        if shift == 0:
            done.append(found.where(~whole).select("s", "i", F.col("prefix").alias("cut"), F.col("left").alias("extra")))
        rows = found.where(~whole).select("s", "i", "prefix", "left")
    return stage(functools.reduce(DataFrame.unionByName, done), "cuts")


def _children(src: DataFrame, rows: DataFrame, shift: int, stored: bool = True) -> DataFrame:
    """``s, i, prefix, left, n``: the child prefixes, down to bit ``shift``, that hold the wanted rows; n is their number of rows."""
    if shift + _STEP < HASH_BITS:
        under = rows.select(F.col("s").alias("_s"), F.col("prefix").alias("_p")).distinct()
        probe = src.withColumn("prefix", F.shiftright("h", shift + _STEP)).join(
            lookup_side(under, "prefixes") if stored else under, F.col("s").eqNullSafe(F.col("_s")) & (F.col("prefix") == F.col("_p")))
    else:
        probe = src.withColumn("prefix", F.lit(0).cast("long"))
    counts = probe.groupBy("s", "prefix", F.shiftright("h", shift).alias("child")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("s", "prefix").orderBy("child").rowsBetween(Window.unboundedPreceding, 0)  # at most 2 ** _STEP rows
    counts = counts.withColumn("upto", F.sum("n").over(upto)).select(F.col("s").alias("_s"), F.col("prefix").alias("_p"), "child", "n", "upto")
    here = F.col("s").eqNullSafe(F.col("_s")) & (F.col("prefix") == F.col("_p")) & (F.col("left") <= F.col("upto")) & (F.col("left") > F.col("upto") - F.col("n"))
    return rows.join(counts, here).select("s", "i", F.col("child").alias("prefix"), (F.col("left") - F.col("upto") + F.col("n")).alias("left"), "n")


def _ties_numbered(out: DataFrame, tied: Column, s: Column, h: Column, key: str) -> DataFrame:
    """Adds ``__tie``: from 1, the place of a row among those with its stratum and hash, 0 where that decides nothing.

    Repeated keys share one hash. Places come from a range sort and prefix sums, so a key that holds many rows is not one task."""
    rows = out.where(tied).withColumn("__s", s).withColumn("__h", h)
    placed = numbered(rows, ["__s", "__h", key], "__at")
    first = placed.groupBy(F.col("__s").alias("__fs"), F.col("__h").alias("__fh")).agg(F.min("__at").alias("__first"))
    placed = placed.join(lookup_side(first, "first"), F.col("__s").eqNullSafe(F.col("__fs")) & (F.col("__h") == F.col("__fh")))
    placed = placed.select(*[col(c) for c in out.columns], (F.col("__at") - F.col("__first") + 1).alias("__tie"))
    return out.where(~tied).withColumn("__tie", F.lit(0).cast("long")).unionByName(placed)


def _band(df: DataFrame, key: str, stratum: Column, bounds: DataFrame, seed: int, name: str = "__band",
          source: DataFrame | None = None) -> DataFrame:
    """Adds ``name``: the number of cumulative bounds (per stratum) at or below the row's hash rank.

    ``source`` has the same rows with fewer columns made on the way; the cuts are looked for there."""
    cuts = hash_cuts(df if source is None else source, col(key), stratum, bounds, seed)
    few = cuts.limit(FEW + 1).collect()
    h, s = hash60(col(key), seed), stratum.cast("string")
    below = lambda cut, extra: (h < cut) | ((h == cut) & (F.col("__tie") > 0) & (F.col("__tie") <= extra))
    if len(few) <= FEW:
        per: dict = {}
        for r in sorted(few, key=lambda r: r["i"]):
            per.setdefault(r["s"], []).append((r["cut"], r["extra"]))
        out = df
        tied, band = F.lit(False), None
        for st, pairs in per.items():
            at = sorted({cut for cut, extra in pairs if extra})
            tied = tied | (s.eqNullSafe(F.lit(st)) & h.isin(at)) if at else tied
            n = F.lit(0)
            for cut, extra in pairs:
                n = n + F.when(below(F.lit(cut), F.lit(extra)), 0).otherwise(1)
            band = F.when(s.eqNullSafe(F.lit(st)), n) if band is None else band.when(s.eqNullSafe(F.lit(st)), n)
        some = any(r["extra"] for r in few)
    else:
        lists = cuts.groupBy(F.col("s").alias("__cs")).agg(F.array_sort(F.collect_list(F.struct("i", "cut", "extra"))).alias("__cuts"))
        out = df.withColumn("__hash", h).join(lookup_side(lists, "cut_lists"), s.eqNullSafe(F.col("__cs")), "left")
        h = F.col("__hash")  # computed once per row, before the cuts are looked at
        tied = F.exists("__cuts", lambda x: (x["extra"] > 0) & (x["cut"] == h))
        band = F.size(F.filter("__cuts", lambda x: ~below(x["cut"], x["extra"])))
        some = not cuts.where("extra > 0").isEmpty()
    tied = F.coalesce(tied, F.lit(False))
    out = _ties_numbered(out, tied, s, h, key) if some else out.withColumn("__tie", F.lit(0).cast("long"))
    return out.select(*[col(c) for c in df.columns], (band if band is not None else F.lit(0)).cast("int").alias(name))


def _one(counts: DataFrame, wanted: Column) -> DataFrame:
    return counts.select("s", F.lit(0).alias("i"), wanted.alias("wanted"), "n")


def stratified_split(df: DataFrame, key: str, label: str | None, test_size: float, seed: int = 42,
                     names: tuple[str, str] = ("train", "validation"), column: str = "split") -> DataFrame:
    """Label-proportional split; ``label=None`` gives a plain random split."""
    stratum = col(label) if label else F.lit("all")
    counts = strata(df, stratum)
    quota = quotas(counts, math.ceil(test_size * _total(counts)[0]))
    banded = _band(df, key, stratum, _one(quota, F.col("quota")), seed)
    return banded.withColumn(
        column, F.when(F.col("__band") == 0, F.lit(names[1])).otherwise(F.lit(names[0]))).drop("__band")


def three_way_split(df: DataFrame, key: str, label: str, val_size: float, test_size: float,
                    seed: int = 42, column: str = "split") -> DataFrame:
    """Test, validation and train as three bands of one hash order."""
    counts = strata(df, col(label))
    n = _total(counts)[0]
    test = quotas(counts, math.ceil(test_size * n)).withColumnRenamed("quota", "test")
    both = quotas(counts, math.ceil((test_size + val_size) * n)).select(F.col("s").alias("_s"), "quota")
    pairs = test.join(both, F.col("s").eqNullSafe(F.col("_s")))
    wanted = F.array(F.struct(F.lit(0).alias("i"), F.col("test").alias("wanted")), F.struct(F.lit(1).alias("i"), F.greatest("test", "quota").alias("wanted")))
    bounds = pairs.select("s", "n", F.explode(wanted).alias("w")).select("s", "w.i", "w.wanted", "n")
    banded = _band(df, key, col(label), bounds, seed)
    return banded.withColumn(
        column, F.element_at(F.array(F.lit("test"), F.lit("validation"), F.lit("train")),
                             F.col("__band") + 1)).drop("__band")


def split_balance(df: DataFrame, label: str, column: str = "split") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n_rows"), F.avg(col(label)).alias("positive_rate"))


def sample_exact(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A simple random sample of exactly n rows (all rows when there are fewer)."""
    bounds = _one(strata(df, F.lit("all")), F.lit(n))
    return _band(df, key, F.lit("all"), bounds, seed).where("__band = 0").drop("__band")


def sample_stratified_cap(df: DataFrame, key: str, label: str, max_rows: int, seed: int = 42) -> DataFrame:
    """At most max_rows rows, label-proportional when every class has two rows or more."""
    counts = strata(df, col(label))
    rows, _, smallest = _total(counts)
    if rows <= max_rows:
        return df
    if smallest < 2:
        return sample_exact(df, key, max_rows, seed)
    return _band(df, key, col(label), _one(quotas(counts, max_rows), F.col("quota")), seed).where("__band = 0").drop("__band")


def hash_folds(df: DataFrame, key: str, k: int, seed: int = 42, column: str = "fold") -> DataFrame:
    """Folds of nearly equal size straight from the hash; no extra pass."""
    return df.withColumn(column, F.pmod(hash60(col(key), seed), F.lit(k)).cast("int"))


def _fold_bounds(counts: DataFrame, k: int) -> DataFrame:
    each = counts.select("s", "n", F.explode(F.sequence(F.lit(1), F.lit(max(1, k - 1)))).alias("i"))
    return each.select("s", "i", F.ceil(F.col("i") * F.col("n") / F.lit(k)).alias("wanted"), "n").where(F.col("i") < k)


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int = 42,
                     column: str = "fold") -> DataFrame:
    """Folds that split every class into k parts whose sizes differ by at most one."""
    return _band(df, key, col(label), _fold_bounds(strata(df, col(label)), k), seed, column)


def fold_columns(df: DataFrame, key: str, label: str, k: int, seeds: Sequence[int], column: str = "folds") -> DataFrame:
    """Adds an array with the row's stratified fold under every seed: rows are counted once and written by one projection."""
    if not seeds:
        raise ValueError("at least one seed is needed")
    bounds = stage(_fold_bounds(strata(df, col(label)), k), "fold_bounds")
    out, names = df, [f"__fold_{i}" for i in range(len(seeds))]
    for name, seed in zip(names, seeds):
        out = _band(out, key, col(label), bounds, seed, name, df)
    return out.select(*[col(c) for c in df.columns], F.array(*names).alias(column))


def repeated_folds(df: DataFrame, key: str, label: str, k: int, repeats: int, seed: int = 42) -> DataFrame:
    """``repeats`` independent stratified foldings, one row per (row, repeat)."""
    folded = fold_columns(df, key, label, k, [seed + r for r in range(1, repeats + 1)], "__folds")
    return folded.select(*[col(c) for c in df.columns], F.posexplode("__folds").alias("__r", "fold")).select(
        *[col(c) for c in df.columns], (F.col("__r") + 1).alias("repeat"), "fold")


def holdout_split(df: DataFrame, key: str, label: str, fraction: float, seed: int = 42,
                  min_rows: int = 20, column: str = "part") -> DataFrame:
    """Splits off a stratified holdout when the data allows one; otherwise every row is 'fit'."""
    rows, classes, smallest = _total(strata(df, col(label)))
    if not (0.0 < fraction < 0.5 and classes > 1 and smallest >= 2 and rows >= min_rows):
        return df.withColumn(column, F.lit("fit"))
    return stratified_split(df, key, label, fraction, seed, ("fit", "holdout"), column)
