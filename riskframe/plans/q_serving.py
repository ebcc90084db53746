"""Raw-record scoring as batch and stream, streaming drift and quarantine."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from riskframe.operators import clean, drift, encode, features as f, quality as q, score as sc
from riskframe.plans.q_clean import CLEANED, TRAIN
from riskframe.plans.q_drift import FEATURES as DRIFT_FEATURES
from riskframe.plans.q_evaluate import WEIGHTS
from riskframe.plans.registry import query
from riskframe.plans.settings import BINARY, CLEANING, REGION_RULES
from riskframe.plans.views import VIEW_SQL, staged, table, view
from riskframe.sources.staging import fresh_path, stage
from riskframe.streaming import jobs

MODEL_COLUMNS = ["cnt_a", "amt_a", "amt_b", "size_ratio", "employed_years", "flag_yn", "region_ASIA", "region_EUROPE", "segment_BUILDING", "other_X",
                 "nation_TE", "region_TE", "never_built"]


def stateless(df):
    out = f.floored_ratios(df, [("size_ratio", "amt_b", "amt_a", 1.0)])
    return f.day_offsets(out, {"employed_years": "days_emp"})


def serving(spark, sf):
    """Fitted artefacts and the raw-to-features projection built from them."""
    app = staged(spark, sf, "v_app")
    train = app.where(TRAIN)
    art = clean.fit_cleaning(train, CLEANING)
    prior = encode.target_mean(train, "target")
    cleaned = clean.apply_cleaning(train, art, CLEANING)  # maps are fitted on the column that the model sees
    nation = stage(encode.target_map(cleaned, "nation", "target", prior=prior), "te")
    project = functools.partial(sc.raw_to_features, art=art, cfg=CLEANING, build=stateless, binary=BINARY, onehot=REGION_RULES,
                                target_encoded={"nation_TE": nation, "region_TE": None}, model_columns=MODEL_COLUMNS, keep=["id"], priors={"nation_TE": prior})
    return app, project


FEATS = CLEANED + f""", g AS (SELECT avg(target) AS g FROM v_app WHERE {TRAIN}),
te AS (SELECT nation AS c, (sum(target) + 10 * any_value(g.g)) / (count(*) + 10) AS enc FROM clean, g WHERE ({TRAIN}) AND nation IS NOT NULL GROUP BY nation),
feats AS (SELECT clean.id, clean.cnt_a, clean.amt_a, clean.amt_b, clean.amt_b / CASE WHEN clean.amt_a < 1 THEN 1 ELSE clean.amt_a END AS size_ratio, -clean.days_emp / 365.25::DOUBLE AS employed_years,
 CASE clean.flag_yn WHEN 'N' THEN 0 WHEN 'Y' THEN 1 END AS flag_yn, coalesce(raw.region = 'ASIA', FALSE)::INT AS "region_ASIA", coalesce(raw.region = 'EUROPE', FALSE)::INT AS "region_EUROPE",
 coalesce(raw.segment = 'BUILDING', FALSE)::INT AS "segment_BUILDING", 0 AS "other_X", coalesce(te.enc, (SELECT g FROM g)) AS "nation_TE", 0.0807 AS "region_TE", 0.0 AS never_built
 FROM clean JOIN v_app raw ON raw.id = clean.id LEFT JOIN te ON te.c = clean.nation)"""
SCORE = "1 / (1 + exp(-(-1 + 0.05::DOUBLE * cnt_a - 0.000004::DOUBLE * amt_b + 2::DOUBLE * \"nation_TE\")))"
SERVE_WEIGHTS = {"cnt_a": 0.05, "amt_b": -0.000004, "nation_TE": 2.0}
FALLBACK = "'region_TE,never_built'"


@query("raw_to_features", FEATS + f" SELECT *, {FALLBACK} AS fallback_features FROM feats", ["v_app"],
       doubles='cnt_a amt_a amt_b size_ratio employed_years nation_TE region_TE never_built')
def raw_to_features(spark, sf):
    app, project = serving(spark, sf)
    out = project(app.drop("target"))
    return out.withColumns({"fallback_features": F.array_join("fallback_features", ","), "cnt_a": F.col("cnt_a").cast("double")})


SCORED_RAW = FEATS + f" SELECT id, {SCORE} AS probability, ({SCORE} >= 0.3)::INT AS predicted_class, 0.3 AS threshold, {FALLBACK} AS fallback_features FROM feats"


def scorer(project):
    run = sc.linear_score(SERVE_WEIGHTS, -1.0)
    return lambda df: sc.score_raw(project(df), lambda d: d, list(SERVE_WEIGHTS), run, 0.3, "id").withColumn(
        "fallback_features", F.array_join("fallback_features", ","))


@query("score_raw_batch", SCORED_RAW, ["v_app"], doubles="probability threshold", digits=8)
def score_raw_batch(spark, sf):
    app, project = serving(spark, sf)
    return scorer(project)(app.drop("target"))


@query("stream_score", SCORED_RAW, ["v_app"], doubles="probability threshold", digits=8)
def stream_score(spark, sf):
    """The applicants arrive as a stream of files; the same projection scores them."""
    app, project = serving(spark, sf)
    inbox = fresh_path(spark, "inbox")
    app.drop("target").write.parquet(inbox)
    stream = jobs.file_stream(spark, inbox, app.drop("target").schema)
    return jobs.stream_score(stream, scorer(project), fresh_path(spark, "scores"), fresh_path(spark, "offsets"))


def q_edges(x):
    qs = ", ".join(f"{i}/10.0::DOUBLE" for i in range(11))
    return f"SELECT (list_sort(list_distinct(quantile_cont({x}, [{qs}]))))[2:-2] AS e FROM v_ref_cur WHERE split = 'reference'"


def window_sql(x, expr):
    return f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS start, '{x}' AS feature, sum((c - r) * ln(c / r)) AS psi FROM (SELECT w.ts, CASE WHEN coalesce(n, 0) = 0 THEN 1e-4::DOUBLE ELSE n / tot END AS c, CASE WHEN coalesce(nr, 0) = 0 THEN 1e-4::DOUBLE ELSE nr / rt END AS r
 FROM (SELECT ts, count(*) AS tot FROM ev GROUP BY ts) w, (SELECT count(*) AS rt FROM v_ref_cur WHERE split = 'reference'),
 (SELECT unnest(range(0, len(e) + 1)) AS bin FROM ({q_edges(x)})) b
 LEFT JOIN (SELECT ts, len(list_filter(e, lambda q: q <= {expr})) AS bin, count(*) AS n FROM ev, ({q_edges(x)}) GROUP BY 1, 2) k ON k.ts = w.ts AND k.bin = b.bin
 LEFT JOIN (SELECT len(list_filter(e, lambda q: q <= {x})) AS bin, count(*) AS nr FROM v_ref_cur, ({q_edges(x)}) WHERE split = 'reference' GROUP BY 1) m ON m.bin = b.bin) GROUP BY ts"""


WINDOWS = {"f_num": "value", "f_user": "user_id"}


def _drift_stream(spark, sf):
    """Edges and reference bins of the first half of the month, and the arriving events of the second."""
    both = staged(spark, sf, "v_ref_cur")
    reference = both.where("split = 'reference'")
    edges = {x: (e or [])[1:-1] for x, e in drift.quantile_edges(reference, list(WINDOWS)).items()}
    ref = drift.bin_counts(reference, reference.limit(0), {x: (drift.edge_code(F.col(x).cast("double"), e),) * 2 for x, e in edges.items()})
    events = table(spark, sf, "events")
    stream = jobs.file_stream(spark, sf, events.schema, "events.parquet")
    # a watermark needs an instant: wall-clock times are read in the session zone
    recent = stream.select(F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("f_num"), F.col("user_id").alias("f_user")).where(
        F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp"))
    return edges, ref, recent


WINDOW_PSI = ("WITH ev AS (SELECT date_trunc('day', ts) AS ts, value, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-16') "
              "SELECT *, CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.25 THEN 'small' ELSE 'major' END AS drift_level FROM ("
              + " UNION ALL ".join(window_sql(x, e) for x, e in WINDOWS.items()) + ")")


@query("stream_drift_window", WINDOW_PSI, ["v_ref_cur"], doubles="psi")
def stream_drift_window(spark, sf):
    """Daily PSI of the arriving events against the first half of the month."""
    edges, ref, recent = _drift_stream(spark, sf)
    counts = jobs.windowed_bin_counts(recent, "ts", edges, "1 day")
    # complete mode keeps every window: a bounded replay has no later data to close the last one
    out = jobs.run_latest(counts, fresh_path(spark, "windows"), fresh_path(spark, "offsets"))
    res = jobs.window_psi(out.withColumn("bin", F.col("bin").cast("string")), ref)
    return res.withColumn("start", F.date_format("start", "yyyy-MM-dd"))


@query("stream_drift_closed", f"SELECT * FROM ({WINDOW_PSI}) WHERE CAST(start AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)",
       ["v_ref_cur"], doubles="psi")
def stream_drift_closed(spark, sf):
    """As above for the days that are over: each is appended once, when events an hour past its end have come."""
    edges, ref, recent = _drift_stream(spark, sf)
    out, _ = jobs.run_closed(jobs.closed_window_psi(recent, "ts", edges, ref, "1 day"), fresh_path(spark, "closed"), fresh_path(spark, "offsets"))
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("start"), "feature", "psi", "drift_level")


@query("stream_quarantine", """SELECT c_custkey AS id, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'between:c_acctbal' END, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'distinct_in_set:c_mktsegment' END) AS broken,
 c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE' AS valid FROM customer""")
def stream_quarantine(spark, sf):
    customers = table(spark, sf, "customer")
    stream = jobs.file_stream(spark, sf, customers.schema, "customer.parquet")
    rules = [q.between("c_acctbal", 0), q.distinct_in_set("c_mktsegment", ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"])]
    good, bad = jobs.stream_quarantine(stream, rules, fresh_path(spark, "good"), fresh_path(spark, "bad"), fresh_path(spark, "offsets"))
    return good.select(F.col("c_custkey").alias("id"), F.lit("").alias("broken"), F.lit(True).alias("valid")).unionByName(
        bad.select(F.col("c_custkey").alias("id"), F.array_join("broken_rules", ",").alias("broken"), F.lit(False).alias("valid")))


@query("stream_quarantine_unique", """WITH n AS (SELECT c_custkey AS id, c_nationkey * 1000 + CAST(floor(abs(c_acctbal)) AS BIGINT) AS code, c_acctbal AS bal FROM customer)
SELECT id, concat_ws(',', CASE WHEN bal < 0 THEN 'between:bal' END, CASE WHEN count(*) OVER (PARTITION BY code) > 1 THEN 'unique:code' END) AS broken FROM n""")
def stream_quarantine_unique(spark, sf):
    """Three files, the last one after a restart on the same checkpoint; a code may repeat in any of them."""
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") * 1000 + F.floor(F.abs("c_acctbal"))).cast("long").alias("code"),
                                               F.col("c_acctbal").alias("bal"))
    folder, paths = fresh_path(spark, "arriving"), [fresh_path(spark, x) for x in ("good", "bad", "offsets")]
    rules = [q.between("bal", 0), q.unique("code")]
    for part in range(3):
        rows.where(F.pmod("id", F.lit(3)) == part).coalesce(1).write.mode("append").parquet(folder)
        if part > 0:
            stream = jobs.file_stream(spark, folder, rows.schema, files_per_batch=1)
            good, bad = jobs.stream_quarantine(stream, rules, *paths)
    return good.select("id", F.lit("").alias("broken")).unionByName(bad.select("id", F.array_join("broken_rules", ",").alias("broken")))
