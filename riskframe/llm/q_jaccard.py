"""Query of the Jaccard join and its SQL twin, which compares every pair that shares a shingle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import jaccard
from riskframe.llm.common import query, table

SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
    ELSE [] END) AS g FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen)
SELECT r.doc_id, any_value(coalesce(n.n, 0)) AS n_shingles, min(seen) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query("op9_jaccard_join", SQL)
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.with_components(table(spark, sf_dir, "documents"))
