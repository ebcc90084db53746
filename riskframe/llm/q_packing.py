"""Query of the packing. SQL has no tokenizer, so tests compare it with a plain concatenation."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import packing
from riskframe.llm.common import query, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the vocabulary of byte_bpe_50k.json as ranks


@query("op8_concat_and_cut")
def op8_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, with_ids=False)
