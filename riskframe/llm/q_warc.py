"""Query of the fixity audit and its SQL twin.

The pages, written as WARC records, are the first replica. The second is derived from it with damage by rule: records lost,
bodies cut short, one character changed, and records written twice under a new offset past the file's end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm import warc
from riskframe.llm.common import query, table
from riskframe.sources.staging import stage

FILE_BYTES = 1 << 24

SQL = f"""
WITH r AS (SELECT page_id, concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: ', page_id, chr(13), chr(10),
    'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10), 'Content-Length: ', octet_length(encode(coalesce(html, ''))), chr(13), chr(10),
    chr(13), chr(10), coalesce(html, ''), chr(13), chr(10), chr(13), chr(10)) AS rec FROM pages),
l AS (SELECT page_id, octet_length(encode(rec)) AS length FROM r),
o AS (SELECT page_id, length, coalesce(sum(length) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM l),
p AS (SELECT page_id, length, CAST(floor(place / {FILE_BYTES}) AS BIGINT) AS file, CAST(place % {FILE_BYTES} AS BIGINT) AS "offset" FROM o)
SELECT file, "offset", CASE page_id % 53 WHEN 7 THEN 'missing' ELSE 'changed' END AS status FROM p WHERE page_id % 53 IN (7, 19, 31)
UNION ALL
SELECT file, {FILE_BYTES} + "offset" AS "offset", 'extra' AS status FROM p WHERE page_id % 53 = 43
"""


def replicas(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both replicas' records: file, offset, length, digest."""
    body = F.coalesce("html", F.lit(""))
    text = lambda html: warc.record(F.lit("response"), F.col("page_id"), F.col("url"), html)
    whole, cut = text(body), text(F.substring(body, F.lit(1), F.char_length(body) - 1))
    turned = text(F.concat(F.lit("#"), F.substring(body, F.lit(2), F.char_length(body))))
    rows = pages.select("page_id", F.octet_length(whole).cast("long").alias("length"), F.sha2(whole, 256).alias("digest"),
                        F.pmod("page_id", F.lit(53)).alias("fate"), F.octet_length(cut).cast("long").alias("cut_length"), F.sha2(cut, 256).alias("cut"),
                        F.octet_length(turned).cast("long").alias("turned_length"), F.sha2(turned, 256).alias("turned"))
    placed = stage(warc.laid_out(rows, ["page_id", "digest"], FILE_BYTES), "archive")
    first = placed.select("file", "offset", "length", "digest")
    pick = lambda plain, cut, turned: F.when(F.col("fate") == 19, F.col(cut)).when(F.col("fate") == 31, F.col(turned)).otherwise(F.col(plain))
    kept = placed.where("fate IS NULL OR fate != 7").select(
        "file", "offset", pick("length", "cut_length", "turned_length").alias("length"), pick("digest", "cut", "turned").alias("digest"))
    return first, kept.unionByName(placed.where("fate = 43").select("file", (F.col("offset") + FILE_BYTES).alias("offset"), "length", "digest"))


@query("op2_merkle_audit", SQL)
def op2_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.audit(*replicas(table(spark, sf_dir, "pages"))).select("file", "offset", "status")
