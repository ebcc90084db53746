"""Query of the sharding. The propagation is iterative; tests check its law and its cut against a plain version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm import shards
from riskframe.llm.common import query, table

SHARDS = 24


@query("op3_label_propagation")
def op3_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.struct(F.xxhash64(text), F.hash(text), F.octet_length(text)).alias("same"))
    placed = shards.balanced_shards(docs, F.xxhash64("same", "text_crc32"), SHARDS, keep=("doc_id", "size", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
