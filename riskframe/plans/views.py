"""Views that give the test tables the shape of the credit tables.

The text runs unchanged on Spark (table names become DataFrame parameters) and as
CTEs of the SQL twins.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from riskframe.sources.staging import stage
from riskframe.sources.tables import scan_table

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations")

VIEW_SQL = {
    # one row per applicant: 8 % positives, categories, a placeholder, missing values, a near-duplicate column
    "v_app": """
SELECT c.c_custkey AS id, CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS target,
 c.c_mktsegment AS segment, CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE n.n_name END AS nation, r.r_name AS region,
 CASE WHEN c.c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS flag_yn,
 CASE WHEN c.c_custkey % 5 = 0 THEN 365243 ELSE -(c.c_custkey % 9000) END AS days_emp,
 CASE WHEN c.c_custkey % 2 = 0 THEN NULL ELSE o.avg_price END AS half_missing,
 o.n_orders AS cnt_a, o.sum_price AS amt_a, o.sum_price * 1.01 + o.n_orders AS amt_a_dup, o.avg_price AS amt_b,
 CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE o.max_price END AS amt_c,
 CASE WHEN c.c_custkey % 40 = 0 THEN 1 ELSE 0 END AS near_const
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS sum_price,
  round(sum(o_totalprice), 2) / count(*) AS avg_price, max(o_totalprice) AS max_price
  FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""",
    # one-to-many child
    "v_child": """
SELECT o_orderkey AS child_id, o_custkey AS id, o_orderstatus AS status, o_orderpriority AS kind,
 o_totalprice AS amt, datediff('day', TIMESTAMP '2002-01-01 00:00:00', o_orderdate) AS days FROM orders""",
    # child-of-child history
    "v_hist": """
SELECT l_orderkey AS child_id, l_linenumber AS step, CASE l_returnflag WHEN 'R' THEN '4' WHEN 'A' THEN '1' ELSE 'C' END AS status,
 l_extendedprice AS due, l_extendedprice * (1 - l_discount) AS paid, l_quantity AS qty,
 CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS disc FROM lineitem""",
    # label and score with many ties
    "v_scored": """
SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
 CASE WHEN value >= 499.0 THEN 0.998 ELSE round(value / 500.0, 3) END AS p FROM events""",
    # two periods: unshifted, shifted, 0/1 and id-like features
    "v_ref_cur": """
SELECT event_id AS id, CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'reference' ELSE 'current' END AS split,
 value AS f_num, CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN value ELSE value * 1.5 + 10 END AS f_shift,
 CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS f_flag, user_id AS f_user FROM events""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a lazy DataFrame."""
    sql = VIEW_SQL[name]
    used = {t: table(spark, sf_dir, t) for t in BASE_TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", sql)}
    for t in used:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    sql = sql.replace("datediff('day',", "datediff(DAY,")
    return spark.sql(sql, **used)


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view written once, for operators that scan their input several times."""
    return stage(view(spark, sf_dir, name), name)
