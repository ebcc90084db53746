"""Query of the quality classifier; SQL cannot express it, so tests use brute force and held-out accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskframe.llm import line_crf
from riskframe.llm.common import query, table


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def model_of(spark: SparkSession, sf_dir: str) -> line_crf.LineCrf:
    """The classifier fitted on the labels that are not held out."""
    return line_crf.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out()))


@query("op1_line_crf")
def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = line_crf.score(table(spark, sf_dir, "documents"), model_of(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
