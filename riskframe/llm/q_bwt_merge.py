"""Query of the repeated passages and its SQL twin, which groups every string of 400 bytes (as hexadecimal digits)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import bwt_merge
from riskframe.llm.common import query, table

SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
q AS (SELECT r, j, substr(h, 2 * j + 1, 1598) AS h FROM d, unnest(range(0, greatest(0, strlen(h) // 2 - 399), 400)) AS t(j)),
w AS (SELECT r, j + i AS i, md5_number(substr(h, 2 * i + 1, 800)) AS m FROM q, unnest(range(0, strlen(h) // 2 - 399)) AS t(i)),
s AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
p AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS gap FROM w JOIN s USING (m)),
g AS (SELECT r, i, sum(CASE WHEN gap <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g FROM p),
c AS (SELECT r, min(i) AS a, max(i) + 400 AS z FROM g GROUP BY r, g),
k AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS b FROM c),
o AS (SELECT d.r, count(*) AS n_spans, sum(z - a) AS n_removed,
        string_agg(substr(h, 2 * b + 1, 2 * (a - b)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS kept
      FROM k JOIN d ON d.r = k.r GROUP BY d.r)
SELECT d.doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN o ON o.r = d.r
"""


@query("op12_bwt_merge", SQL)
def op12_bwt_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_merge.cut_repeats(table(spark, sf_dir, "documents")).drop("spans")
