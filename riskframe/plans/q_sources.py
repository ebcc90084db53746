"""Scans, sinks and the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import clean, correlate, profile, split
from riskframe.plans.registry import query
from riskframe.plans.settings import SEED
from riskframe.plans.views import staged, table, view
from riskframe.sources import tables as t
from riskframe.sources.staging import fresh_path

H = "concat('0x', substr(md5(concat('{s}:', {c})), 1, 15))::BIGINT"


def h(c: str = "id", s: int = SEED) -> str:
    return H.format(s=s, c=c)


@query("scan_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer", doubles="c_acctbal")
def scan_table(spark, sf):
    src = table(spark, sf, "customer")
    path = fresh_path(spark, "customer-csv")
    src.write.option("header", "true").csv(path)
    return t.scan_table(spark, path, src.schema, fmt="csv")


@query("scan_projected", """
SELECT l_returnflag, count(*) AS n, min(l_quantity) AS min_qty, max(l_quantity) AS max_qty, avg(l_quantity) AS avg_qty
FROM lineitem GROUP BY l_returnflag""", doubles="min_qty max_qty avg_qty")
def scan_projected(spark, sf):
    df = t.scan_table(spark, f"{sf}/lineitem.parquet", columns=["l_returnflag", "l_quantity"])
    return df.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty"),
        F.avg("l_quantity").alias("avg_qty"))


@query("scan_sampled", f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE {h('o_orderkey')}::DOUBLE / 1152921504606846976::DOUBLE < 0.2""", doubles="o_totalprice")
def scan_sampled(spark, sf):
    return t.scan_sampled(table(spark, sf, "orders"), "o_orderkey", share=0.2, seed=SEED).select(
        "o_orderkey", "o_custkey", "o_totalprice")


@query("sink_layered_table", "SELECT child_id, id, status, kind, amt, days FROM v_child", ["v_child"], doubles="amt")
def sink_layered_table(spark, sf):
    return t.write_layer(view(spark, sf, "v_child"), fresh_path(spark, "layers"), "02_intermediate", "child")


@query("sink_json_record", """
SELECT 0.5::DOUBLE AS threshold, 'fixed' AS strategy, count(*) AS n_rows, avg(label) AS positive_rate,
 avg(power(p - label, 2)) AS brier FROM v_scored""", ["v_scored"], doubles="threshold positive_rate brier")
def sink_json_record(spark, sf):
    rec = view(spark, sf, "v_scored").agg(
        F.lit(0.5).alias("threshold"), F.lit("fixed").alias("strategy"), F.count("*").alias("n_rows"),
        F.avg("label").alias("positive_rate"), F.avg(F.pow(F.col("p") - F.col("label"), 2)).alias("brier"))
    return t.write_record(rec, fresh_path(spark, "record"))


@query("sink_fit_artifact", """
WITH f AS (SELECT median(amt_b) AS mb, median(amt_c) AS mc FROM v_app WHERE id % 4 <> 0),
m AS (SELECT arg_min(nation, struct_pack(n := -n, v := nation)) AS mode FROM
 (SELECT nation, count(*) AS n FROM v_app WHERE id % 4 <> 0 AND nation IS NOT NULL GROUP BY nation))
SELECT id, coalesce(amt_b, f.mb) AS amt_b, coalesce(amt_c, f.mc) AS amt_c, coalesce(nation, m.mode) AS nation
FROM v_app, f, m""", ["v_app"], doubles="amt_b amt_c")
def sink_fit_artifact(spark, sf):
    app = staged(spark, sf, "v_app").select("id", "amt_b", "amt_c", "nation")
    train = app.where("id % 4 <> 0")
    cfg = clean.CleaningConfig(id_columns=("id",), target="target", missing_threshold=1.0, corr_threshold=1.0,
                               near_constant_threshold=1.01)
    fitted = clean.fit_cleaning(train, cfg)
    stored = t.write_artifact(fitted.table(spark), fresh_path(spark, "artifact"))
    return clean.apply_cleaning(app, clean.CleaningArtifact.from_table(stored), cfg)


def _three_splits(spark, sf):
    app = view(spark, sf, "v_app").select("id", "target", "amt_a", "cnt_a")
    return {"train": app.where("id % 4 > 1"), "validation": app.where("id % 4 = 1"),
            "test": app.where("id % 4 = 0").drop("target")}


FEATURE_ROWS = """
SELECT id, CASE WHEN id % 4 = 0 THEN -1 ELSE target END::BIGINT AS target, amt_a, cnt_a,
 CASE WHEN id % 4 > 1 THEN 'train' WHEN id % 4 = 1 THEN 'validation' ELSE 'test' END AS split, 1::INTEGER AS version
FROM v_app"""


@query("feature_table_append", f"""
SELECT split, count(*) AS n_rows, sum(target)::BIGINT AS label_sum, sum(cnt_a)::BIGINT AS cnt_sum
FROM ({FEATURE_ROWS}) GROUP BY split""", ["v_app"])
def feature_table_append(spark, sf):
    root = fresh_path(spark, "store")
    counts = t.append_features(t.feature_rows(_three_splits(spark, sf), "target"), root, "risk", 1)
    stored = t.feature_view(spark, root, "risk", 1)
    sums = stored.groupBy("split").agg(F.sum("target").alias("label_sum"), F.sum("cnt_a").alias("cnt_sum"))
    return counts.join(sums, "split")


@query("sanitize_column_names", """
SELECT id, amt_a AS amt_total_eur, cnt_a AS n_orders, nation AS nation_name FROM v_app""", ["v_app"], doubles="amt_total_eur")
def sanitize_column_names(spark, sf):
    app = view(spark, sf, "v_app").select("id", "amt_a", "cnt_a", "nation")
    return t.sanitize_names(app.toDF("ID", "Amt Total (EUR)", "_N-Orders_", "nation/name"))


@query("feature_view", FEATURE_ROWS + " WHERE id % 4 = 1", ["v_app"], doubles="amt_a")
def feature_view(spark, sf):
    root = fresh_path(spark, "store")
    t.append_features(t.feature_rows(_three_splits(spark, sf), "target"), root, "risk", 1)
    return t.feature_view(spark, root, "risk", 1, "validation").drop("event_time")


@query("feature_group_stats", """
WITH g AS (SELECT amt_a, cnt_a::DOUBLE AS cnt_a FROM v_app),
r AS (SELECT min(amt_a) AS lo, max(amt_a) AS hi FROM g),
b AS (SELECT least(9, floor((amt_a - lo) / ((hi - lo) / 10)))::BIGINT AS bin FROM g, r WHERE amt_a IS NOT NULL)
SELECT 'histogram:amt_a' AS stat, bin, count(*)::DOUBLE AS value FROM b GROUP BY bin
UNION ALL SELECT 'corr:amt_a:cnt_a', 0, corr(amt_a, cnt_a) FROM g""", ["v_app"], doubles="value")
def feature_group_stats(spark, sf):
    root = fresh_path(spark, "store")
    t.append_features(t.feature_rows(_three_splits(spark, sf), "target"), root, "risk", 1)
    stored = t.feature_view(spark, root, "risk", 1)
    hist = profile.histogram_by_class(stored.withColumn("all", F.lit("all")), "amt_a", "all", 10, clip=None)
    corr = correlate.corr_pairs(stored, ["amt_a", "cnt_a"])
    return hist.select(F.lit("histogram:amt_a").alias("stat"), F.col("bin").cast("long").alias("bin"),
                       F.col("n").cast("double").alias("value")).unionByName(
        corr.select(F.concat_ws(":", F.lit("corr"), "left_feature", "right_feature").alias("stat"),
                    F.lit(0).cast("long").alias("bin"), F.col("r").alias("value")))
