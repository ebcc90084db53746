"""Staged tables: cut lineage by writing Parquet to the shared checkpoint folder.

A written table survives lost executors and keeps column pruning, which a
row-wise RDD checkpoint does not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get(_KEY, None) or sc.getConf().get(_KEY, None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError(f"set {_KEY} to a shared folder before staging tables")
    fallback = tempfile.mkdtemp(prefix="riskframe-")
    sc.setCheckpointDir(fallback)
    return fallback


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/riskframe/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write once, read back; use it for an input that several passes scan."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lookup_side(df: DataFrame, name: str = "lookup") -> DataFrame:
    """A narrow look-up table (key, one value) ready to be joined to a large table.

    It is written first, so Spark knows its size in bytes: up to spark.sql.autoBroadcastJoinThreshold it is
    broadcast and the large side does not move; beyond that the join shuffles, with AQE splitting skewed keys.
    """
    return stage(df, name)
