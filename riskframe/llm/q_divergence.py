"""Query of the source divergence audit and its SQL twin, which prices every kept term of every pair of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import divergence
from riskframe.llm.common import query, table

SQL = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
s AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source),
a AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.total, 0) + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM a JOIN a b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
u AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(x.value, 0)::BIGINT AS value FROM g JOIN g h ON h.lang = g.lang AND h.source <> g.source
    LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM a WHERE n > 0 AND p > q),
o AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM u)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 50
"""


@query("op11_source_divergence", SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))
