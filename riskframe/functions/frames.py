"""Schema helpers and the long (unpivoted) form used by one-job statistics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .scalars import col

WIDE_LIMIT = 150  # aggregate expressions per plan before they are split


def numeric_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    drop = set(skip)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def string_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    drop = set(skip)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in drop]


def dtype_of(df: DataFrame, name: str) -> str:
    return dict(df.dtypes)[name]


def value_of(df: DataFrame, name: str) -> Column:
    """The column with NaN as null."""
    c = col(name)
    return F.when(~F.isnan(c), c) if dtype_of(df, name) in ("double", "float") else c


def wide_agg(df: DataFrame, exprs: Mapping[str, Column]) -> dict:
    """All scalar aggregates as one dict. The result is one row per chunk of
    WIDE_LIMIT expressions, so the driver holds one number per expression."""
    names = list(exprs)
    out: dict = {}
    for i in range(0, len(names), WIDE_LIMIT):
        part = names[i:i + WIDE_LIMIT]
        row = df.agg(*[exprs[n].alias(f"a{j}") for j, n in enumerate(part)]).first()
        out.update({n: row[j] for j, n in enumerate(part)})
    return out


def long_form(df: DataFrame, values: Mapping[str, Column], keep: Sequence[Column] = (),
              name: str = "feature", value: str = "value") -> DataFrame:
    """One row per (row, feature). All values must share one type."""
    items = [F.struct(F.lit(n).alias(name), v.alias(value)) for n, v in values.items()]
    return (df.select(*keep, F.explode(F.array(*items)).alias("__kv"))
              .select("*", f"__kv.{name}", f"__kv.{value}").drop("__kv"))


def spread(df: DataFrame, features: Sequence[str], stats: Mapping[str, callable],
           name: str = "feature") -> DataFrame:
    """One row per feature from wide aggregates, still lazy.

    ``stats`` maps an output column to ``f(feature) -> aggregate Column``; the
    aggregates run in one pass per chunk and are turned into rows by a stack
    over the single aggregated row.
    """
    per = max(1, WIDE_LIMIT // max(1, len(stats)))
    parts = []
    for i in range(0, len(features), per):
        chunk = features[i:i + per]
        aggs = [fn(f).alias(f"s{a}_{b}") for a, f in enumerate(chunk) for b, fn in enumerate(stats.values())]
        rows = [F.struct(F.lit(f).alias(name),
                         *[F.col(f"s{a}_{b}").alias(s) for b, s in enumerate(stats)])
                for a, f in enumerate(chunk)]
        parts.append(df.agg(*aggs).select(F.inline(F.array(*rows))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of fitted values (one row per feature, bin or class)."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)
