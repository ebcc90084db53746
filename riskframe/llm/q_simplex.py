"""Query of the clustering and its SQL twin, which computes every distance of every round."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import simplex
from riskframe.llm.common import query, table

_ASSIGNED = ("SELECT v.vec_id, v.r, v.x, c.cluster, d.distance FROM (SELECT v.r, min(struct_pack(d := list_sum(list_transform(list_zip(v.x, c.x), "
             "lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, c := c.cluster)) AS best FROM v, {c} c GROUP BY v.r) AS b JOIN v USING (r), "
             "LATERAL (SELECT best.d AS distance, best.c AS cluster) AS d, LATERAL (SELECT best.c AS cluster) AS c")


def _sql() -> str:
    parts = ["""WITH e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda a: a::DOUBLE) AS x FROM embeddings WHERE embedding IS NOT NULL),
v AS MATERIALIZED (SELECT r, vec_id, list_transform(x, lambda a: floor(256 * a)::BIGINT) AS x FROM e
  WHERE len(x) = 64 AND len(list_filter(x, lambda a: a IS NULL OR isnan(a) OR isinf(a))) = 0),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INT AS cluster, x FROM v QUALIFY cluster < 40)"""]
    for i in range(simplex.ROUNDS + 1):
        parts.append(f"a{i} AS MATERIALIZED ({_ASSIGNED.format(c=f'c{i}')})")
        if i < simplex.ROUNDS:
            parts.append(f"""m{i} AS (SELECT cluster, i, sum(x[i])::HUGEINT AS s, count(*) AS n
  FROM a{i}, unnest(range(1, 65)) AS t(i) GROUP BY cluster, i),
c{i + 1} AS MATERIALIZED (SELECT cluster, list(CASE WHEN s < 0 AND s % n <> 0 THEN s // n - 1 ELSE s // n END::BIGINT ORDER BY i) AS x FROM m{i} GROUP BY cluster
  UNION ALL SELECT cluster, x FROM c{i} WHERE cluster NOT IN (SELECT cluster FROM m{i}))""")
    last = simplex.ROUNDS
    return ",\n".join(parts) + f"""
SELECT a.vec_id, a.cluster, a.distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(a.distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a{last} a JOIN c{last} c ON c.cluster = a.cluster"""


@query("op13_simplex_clustering", _sql())
def op13_simplex_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex.cluster(table(spark, sf_dir, "embeddings"))
