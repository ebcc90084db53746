"""All queries of this package; importing it fills the registry."""

from __future__ import annotations

from riskframe.llm import common, q_bwt_merge, q_divergence, q_jaccard, q_line_crf, q_nbest, q_packing, q_quality_rules, q_secrets, q_shards, q_simplex, q_spann, q_tool_calls, q_warc  # noqa: F401

QUERIES = common.QUERIES
ORACLES = common.ORACLES
