"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskframe.sources.staging import stage

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Registers ``f(spark, sf_dir)`` under ``key`` with its SQL twin, if there is one."""
    def wrap(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def need(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns; a missing one is an error that names it."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df.select(*columns)


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds ``name``, the position from 0 of each row in its group, without holding a group in one task.

    One range sort spreads even a group that holds most rows; positions in the whole table come from prefix sums
    over the partitions' counts, and a group's first position is subtracted by a join on the group.
    """
    spark = rows.sparkSession
    at = stage(rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
               .withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    counts = sorted(at.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # a row per partition
    bases, total = [], 0
    for r in counts:
        bases.append((r["part"], total - (r["part"] << 33)))
        total += r["n"]
    base = spark.createDataFrame(bases, "_part long, _base long")
    placed = at.join(F.broadcast(base), part == F.col("_part")).withColumn("_at", F.col("_at") + F.col("_base")).drop("_part", "_base")
    first = placed.groupBy(*group).agg(F.min("_at").alias("_first"))
    renamed = first.select(*[F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(group)], "_first")
    same = F.lit(True)
    for i, g in enumerate(group):
        same &= placed[g].eqNullSafe(F.col(f"_g{i}"))
    return placed.join(renamed, same).select(*[placed[c] for c in rows.columns], (F.col("_at") - F.col("_first")).alias(name))
