"""Query of the tool-call linking and its SQL twin.

The table has no tool calls, so they are derived from its turns: a user or system turn is a call whose arguments hold
its whole text, an assistant turn is the result of the call one turn earlier. Some calls break their schema by rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm import tool_calls
from riskframe.llm.common import query, table

SCHEMAS = {"answer": {"query": ("string", True), "limit": ("integer", False)},
           "configure": {"prompt": ("string", True), "strict": ("boolean", True)}}

SQL = """
WITH m AS (SELECT *, 'c' || conv_id || '-' || turn AS own, 'c' || conv_id || '-' || (turn - 1) AS asked FROM conversations),
calls AS (SELECT *, CASE WHEN role = 'user' THEN 'answer' ELSE 'configure' END AS name FROM m WHERE role IN ('user', 'system')),
results AS (SELECT * FROM m WHERE role = 'assistant'),
events AS (
  SELECT c.conv_id, c.turn, 'call' AS kind, c.own AS call_id, CASE WHEN r.own IS NULL THEN 'pending' ELSE 'answered' END AS status,
    concat_ws(',', CASE WHEN name = 'configure' AND c.conv_id % 5 = 0 THEN 'unknown:extra' END,
      CASE WHEN name = 'answer' AND c.conv_id % 7 = 3 THEN 'type:limit' END,
      CASE WHEN name = 'answer' AND c.conv_id % 13 = 5 THEN 'missing:query' END) AS problems,
    '{"arguments":{' || CASE WHEN name = 'answer'
      THEN '"limit":' || CASE WHEN c.conv_id % 7 = 3 THEN '"' || c.turn || '"' ELSE '' || c.turn END
        || CASE WHEN c.conv_id % 13 = 5 THEN '' ELSE ',"query":' || CAST(to_json(c.text) AS VARCHAR) END
      ELSE CASE WHEN c.conv_id % 5 = 0 THEN '"extra":1,' ELSE '' END || '"prompt":' || CAST(to_json(c.text) AS VARCHAR) || ',"strict":true' END
      || '},"id":"' || c.own || '","name":"' || name || '"}' AS json
  FROM calls c LEFT JOIN results r ON r.asked = c.own AND r.conv_id = c.conv_id
  UNION ALL
  SELECT r.conv_id, r.turn, 'result', r.asked, CASE WHEN c.own IS NULL THEN 'orphan' ELSE 'linked' END, '',
    '{"content":' || CAST(to_json(r.text) AS VARCHAR) || ',"id":"' || r.asked || '"}'
  FROM results r LEFT JOIN calls c ON r.asked = c.own AND r.conv_id = c.conv_id)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position, kind, call_id, status, problems, json FROM events
"""


def derived(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of the conversations."""
    own = lambda t: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), t.cast("string"))
    limit = F.to_json(F.struct(F.when(F.col("conv_id") % 13 != 5, F.col("text")).alias("query"),
                               F.when(F.col("conv_id") % 7 != 3, F.col("turn")).alias("limit")))
    as_text = F.to_json(F.struct(F.col("turn").cast("string").alias("limit"), F.when(F.col("conv_id") % 13 != 5, F.col("text")).alias("query")))
    setup = F.to_json(F.struct(F.lit(True).alias("strict"), F.col("text").alias("prompt"), F.when(F.col("conv_id") % 5 == 0, F.lit(1)).alias("extra")))
    user = F.when(F.col("conv_id") % 7 == 3, as_text).otherwise(limit)
    calls = messages.where(F.col("role").isin("user", "system")).select(
        "conv_id", "turn", F.lit(0).alias("pos"), own(F.col("turn")).alias("call_id"),
        F.when(F.col("role") == "user", "answer").otherwise("configure").alias("name"),
        F.when(F.col("role") == "user", user).otherwise(setup).alias("arguments"))
    results = messages.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.lit(0).alias("pos"), own(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


@query("op7_tool_calls", SQL)
def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tool_calls.link(*derived(table(spark, sf_dir, "conversations")), SCHEMAS)
    return events.select("conv_id", "position", "kind", "call_id", "status", F.array_join("problems", ",").alias("problems"), "json")
