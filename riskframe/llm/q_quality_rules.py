"""Query of the quality rules and its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import quality_rules as qr
from riskframe.llm.common import query, table

_WORDS = ", ".join(f"'{w}'" for w in qr.stop_forms())
_VERDICT = " AND ".join([f"NOT {qr.BASE_FAILED}", *(r.holds() for r in qr.RULES)])
SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, i, x[i] AS word FROM (SELECT r, x, unnest(range(1, len(x) + 1)) AS i FROM
  (SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS x FROM d))),
g AS (SELECT *, CASE WHEN lead(i, 4) OVER p IS NOT NULL THEN concat_ws(' ', word, lead(word) OVER p, lead(word, 2) OVER p,
  lead(word, 3) OVER p, lead(word, 4) OVER p) END AS win FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
t AS (SELECT *, CASE WHEN win IS NOT NULL AND count(*) OVER (PARTITION BY r, win) > 1 THEN 1 ELSE 0 END AS twice FROM g),
c AS (SELECT r, word, max(twice) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM t),
ws AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, sum(hit) AS n_repeat_words,
  sum(CASE WHEN word IN ({_WORDS}) THEN 1 ELSE 0 END) AS n_stop_words
  FROM c GROUP BY r),
ls AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
  coalesce(n_stop_words, 0) AS n_stop_words, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals
  FROM d LEFT JOIN ws USING (r) LEFT JOIN ls USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, {qr.BASE_FAILED} AS base_failed, ({_VERDICT}) AS kept FROM m
"""


@query("op6_quality_rules", SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qr.judge(qr.measure(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
