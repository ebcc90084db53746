"""Query of the N-best segmentation. SQL has no tokenizer; tests use brute force and exact round trips."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import nbest
from riskframe.llm.common import query, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@query("op5_nbest_segmentation")
def op5_nbest_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.n_best(table(spark, sf_dir, "documents"), MODEL, with_ids=False)
