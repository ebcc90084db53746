"""Query of the secret scan. SQL has no match offsets, so tests compare it with a plain scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm import secrets
from riskframe.llm.common import query, table


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return secrets.scan(docs, secrets.train(docs)).select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
