"""Positions in a sorted table without holding it, or a group of it, in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskframe.functions.scalars import col
from riskframe.sources.staging import stage


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Adds ``name``, the position from 0 in the order of the columns.

    A range sort spreads the rows; a row's place in its partition plus the rows of the partitions before it is its position. The sorted
    rows are stored, so positions of equal rows do not change when a task runs again.
    """
    spark = rows.sparkSession
    keys = [col(c) for c in order]
    at = stage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__n_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__n_at", 33)
    counts = sorted(at.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # a row per partition
    bases, total = [], 0
    for r in counts:
        bases.append((r["part"], total - (r["part"] << 33)))
        total += r["n"]
    base = stage(spark.createDataFrame(bases, "__n_part long, __n_base long"), "bases")
    return at.join(base, part == F.col("__n_part")).withColumn(name, F.col("__n_at") + F.col("__n_base")).drop("__n_at", "__n_part", "__n_base")
