"""From raw documents to packed training sequences; each stage reads what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import jaccard, line_crf, packing, quality_rules, secrets
from riskframe.llm.common import table
from riskframe.llm.q_line_crf import model_of
from riskframe.llm.q_packing import RANKS
from riskframe.sources.staging import stage


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the threshold table rejects go."""
    return quality_rules.apply_rules(docs)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that score below one half go."""
    return line_crf.keep_good(docs, model_of(spark, sf_dir))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the document with the smallest doc_id of each group stays."""
    return jaccard.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: every secret is replaced by its kind; n_chars follows."""
    return secrets.mask(docs, secrets.train(docs), length="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: pieces of sequences of 2048 tokens."""
    return packing.pack(docs, RANKS, public_tokenizers.PATTERN, with_ids=False)


STAGES = [
    ("quality rules", keep_by_rules),
    ("quality classifier", keep_by_classifier),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("secret scans", mask_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # SQL has neither the classifier nor the tokenizer; tests compare with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
