"""Aggregating child tables and joining one-row-per-key tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskframe.functions.frames import long_form, value_of
from riskframe.functions.scalars import at_least, col
from riskframe.sources.staging import lookup_side


@dataclass(frozen=True)
class Measure:
    """``out = fn(column)``; ``arg`` is the value set of ``count_in`` or the bound of ``count_above``."""

    out: str
    fn: str
    column: str
    arg: tuple | float | None = None

    def expr(self, df: DataFrame) -> Column:
        c = value_of(df, self.column)
        if self.fn == "count":
            return F.count(c)
        if self.fn == "nunique":
            return F.count_distinct(c)
        if self.fn == "count_in":
            return F.count_if(c.isin(list(self.arg)))
        if self.fn == "count_above":
            return F.count_if(c > F.lit(self.arg))
        if self.fn == "count_true":
            return F.count_if(c)
        if self.fn == "sum":
            return F.coalesce(F.sum(c), F.lit(0))
        return {"mean": F.avg, "min": F.min, "max": F.max}[self.fn](c)


def aggregate_children(df: DataFrame, key: str, measures: Sequence[Measure],
                       ratios: Sequence[tuple] = ()) -> DataFrame:
    """One row per key. ``ratios``: ``(out, numerator, denominator)`` over measures, denominator
    floored at 1; a fourth item ``"abs"`` takes the absolute denominator first.

    All measures share one partial + final aggregation, so a hot key is combined before it moves;
    at most one ``nunique`` column keeps the plan free of row expansion.
    """
    out = df.groupBy(col(key)).agg(*[m.expr(df).alias(m.out) for m in measures])
    for name, num, den, *how in ratios:
        d = F.col(den).cast("double")
        out = out.withColumn(name, F.col(num).cast("double") / at_least(F.abs(d) if how else d, 1.0))
    return out


def status_history(df: DataFrame, key: str, step: str, status: str, late: Sequence[str], severe: Sequence[str],
                   prefix: str = "bb") -> DataFrame:
    """Months, earliest month, and late / severe counts and shares of a status history."""
    p = prefix
    return aggregate_children(df, key, [
        Measure(f"{p}_months_count", "count", step), Measure(f"{p}_months_min", "min", step),
        Measure(f"{p}_n_dpd", "count_in", status, tuple(late)),
        Measure(f"{p}_n_dpd_def", "count_in", status, tuple(severe)),
    ], [(f"{p}_dpd_ratio", f"{p}_n_dpd", f"{p}_months_count"),
        (f"{p}_dpd_def_ratio", f"{p}_n_dpd_def", f"{p}_months_count")])


def join_feature_tables(base: DataFrame, key: str, *tables: DataFrame) -> DataFrame:
    """Left joins of one-row-per-key tables. Base rows are never lost; AQE broadcasts a side that
    turns out small and splits a skewed one."""
    out = base
    for t in tables:
        out = out.join(t, key, "left")
    return out


def fill_history(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """No history means zero: only the joined columns are filled."""
    use = [c for c in columns if c in joined.columns]
    return joined.fillna(0, subset=use) if use else joined


def keep_known_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_semi")


def lookup(df: DataFrame, mapping: DataFrame, key: str, value: str, out: str, default=None) -> DataFrame:
    """Attaches ``mapping.value`` by key, with a default for unknown or null keys."""
    m = lookup_side(mapping.select(col(key), col(value).alias("__v")))
    joined = df.join(m, key, "left")
    v = F.col("__v") if default is None else F.coalesce(F.col("__v"), F.lit(default))
    return joined.withColumn(out, v).drop("__v").select(*[col(c) for c in df.columns if c != out], out)


def union_splits(tables: Mapping[str, DataFrame], column: str = "split") -> DataFrame:
    """Union by name with the split as a literal; columns missing in a split become null."""
    out = None
    for name, t in tables.items():
        t = t.withColumn(column, F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def column_difference(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str]]:
    """(columns only in a, columns only in b)."""
    return ([c for c in a.columns if c not in set(b.columns)], [c for c in b.columns if c not in set(a.columns)])


def children_per_parent(child: DataFrame, key: str) -> DataFrame:
    per = child.groupBy(col(key)).count()
    return per.agg(F.count("*").alias("n_parents"), F.avg("count").alias("mean_children"))


def auto_aggregate(child: DataFrame, key: str, prefix: str, skip: Sequence[str] = ()) -> DataFrame:
    """Default primitives over every child column by type, one row per key.

    Numbers: sum, mean, min, max, std, skew. Strings: number of distinct values and mode.
    Booleans: share of true. Plus the row count. Distinct values and modes come from one
    (key, column, value) count, so no per-key value set is built in memory.
    """
    num, text, bools = [], [], []
    for f in child.schema.fields:
        if f.name == key or f.name in skip:
            continue
        if isinstance(f.dataType, T.BooleanType):
            bools.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            text.append(f.name)
    aggs = [F.count(F.lit(1)).alias(f"{prefix}_count")]
    for c in num:
        v = value_of(child, c).cast("double")
        n = F.count(v).cast("double")
        g1 = F.skewness(v)
        fixed = F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
        aggs += [F.coalesce(F.sum(v), F.lit(0.0)).alias(f"{prefix}_sum_{c}"), F.avg(v).alias(f"{prefix}_mean_{c}"),
                 F.min(v).alias(f"{prefix}_min_{c}"), F.max(v).alias(f"{prefix}_max_{c}"),
                 F.stddev_samp(v).alias(f"{prefix}_std_{c}"), fixed.alias(f"{prefix}_skew_{c}")]
    for c in bools:
        aggs.append(F.avg(F.when(col(c), 1.0).otherwise(0.0)).alias(f"{prefix}_percent_true_{c}"))
    out = child.groupBy(col(key)).agg(*aggs)
    if text:
        counts = (long_form(child, {c: col(c) for c in text}, keep=[col(key)])
                  .where("value is not null").groupBy(key, "feature", "value").agg(F.count("*").alias("n")))
        best = F.struct(-F.col("n"), F.col("value"))
        cat = counts.groupBy(key).agg(*[
            e for c in text for e in (
                F.count_if(F.col("feature") == c).alias(f"{prefix}_num_unique_{c}"),
                F.min_by("value", F.when(F.col("feature") == c, best)).alias(f"{prefix}_mode_{c}"))])
        out = out.join(cat, key, "left").fillna(0, [f"{prefix}_num_unique_{c}" for c in text])
    return out


def sort_nulls_last(df: DataFrame, column: str) -> DataFrame:
    return df.orderBy(col(column).desc_nulls_last())


def top_k(df: DataFrame, column: str, k: int, absolute: bool = False, tie: Sequence[str] = ()) -> DataFrame:
    """The k largest rows; planned as a per-task top-k, not a sort."""
    v = F.abs(col(column)) if absolute else col(column)
    return df.orderBy(v.desc_nulls_last(), *[col(t) for t in tie]).limit(k)


def cumulative_best(trials: DataFrame, order: str, score: str, group: str | None = None,
                    out: str = "best_so_far") -> DataFrame:
    """Running maximum over the trial order; a trial table has one row per trial."""
    part = [col(group)] if group else [F.lit(0)]
    w = Window.partitionBy(*part).orderBy(col(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return trials.withColumn(out, F.max(col(score)).over(w))
