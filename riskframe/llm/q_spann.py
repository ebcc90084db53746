"""Query of the nearest-neighbour search; tests measure its recall against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm import spann
from riskframe.llm.common import query, table


@query("op4_balanced_lists")
def op4_balanced_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
