"""Row-wise features on the views (each one projection)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import features as f
from riskframe.plans.registry import query
from riskframe.plans.views import table, view

G = lambda c: f"(CASE WHEN {c} < 1 THEN 1 ELSE {c} END)"


@query("feat_ratios", f"""
SELECT id, amt_a / {G('amt_b')} AS "CREDIT_INCOME_RATIO", amt_c / {G('amt_b')} AS "ANNUITY_INCOME_RATIO", amt_a / {G('amt_c')} AS "CREDIT_ANNUITY_RATIO",
 {G('amt_b')} / {G('cnt_a')} AS "INCOME_PER_PERSON", {G('amt_c')} / {G('amt_a')} AS "PAYMENT_RATE", near_const / {G('cnt_a')} AS "CHILDREN_RATIO" FROM v_app""",
       ["v_app"], doubles="CREDIT_INCOME_RATIO ANNUITY_INCOME_RATIO CREDIT_ANNUITY_RATIO INCOME_PER_PERSON PAYMENT_RATE CHILDREN_RATIO")
def feat_ratios(spark, sf):
    out = f.financial_ratios(view(spark, sf, "v_app"), "amt_b", "amt_a", "amt_c", "cnt_a", "near_const")
    return out.select("id", "CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO", "CREDIT_ANNUITY_RATIO", "INCOME_PER_PERSON", "PAYMENT_RATE", "CHILDREN_RATIO")


@query("feat_ratios_ext", f"""
SELECT id, g / {G('amt_b')} AS "GOODS_PRICE_CREDIT_RATIO", CASE WHEN {G('amt_b')} - g < 0 THEN 0 ELSE {G('amt_b')} - g END AS "CREDIT_OVER_GOODS",
 {G('amt_b')} / {G('amt_c')} AS "CREDIT_DURATION_MONTHS" FROM (SELECT *, {G('coalesce(half_missing * 0.9, amt_b)')} AS g FROM v_app)""",
       ["v_app"], doubles="GOODS_PRICE_CREDIT_RATIO CREDIT_OVER_GOODS CREDIT_DURATION_MONTHS")
def feat_ratios_ext(spark, sf):
    app = view(spark, sf, "v_app").withColumn("goods", F.col("half_missing") * 0.9)
    return f.goods_ratios(app, "amt_b", "goods", "amt_c").select("id", "GOODS_PRICE_CREDIT_RATIO", "CREDIT_OVER_GOODS", "CREDIT_DURATION_MONTHS")


DAYS = "(SELECT o_orderkey AS id, -datediff('day', o_orderdate, TIMESTAMP '2002-01-01') AS d_birth, -(o_orderkey % 900) AS d_emp FROM orders)"


def _days(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), (-F.datediff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate"))).alias("d_birth"),
        (-(F.col("o_orderkey") % 900)).alias("d_emp"))


@query("feat_day_offsets", f"""
SELECT id, -d_birth / 365.25::DOUBLE AS age_years, -d_emp / 365.25::DOUBLE AS employed_years,
 (-d_emp / 365.25::DOUBLE) / (-d_birth / 365.25::DOUBLE + 1e-8) AS employed_to_age FROM {DAYS}""", doubles="age_years employed_years employed_to_age")
def feat_day_offsets(spark, sf):
    out = f.day_offsets(_days(spark, sf), {"age_years": "d_birth", "employed_years": "d_emp", "phone_years": "not_there"},
                        ("employed_to_age", "employed_years", "age_years"))
    return out.select("id", "age_years", "employed_years", "employed_to_age")


@query("feat_day_offsets_ext", f"""
SELECT id, e / CASE WHEN a < 1 THEN 1 ELSE a END AS employed_to_age, a / CASE WHEN e < 0.1 THEN 0.1 ELSE e END AS age_to_employed
FROM (SELECT id, -d_birth / 365.25::DOUBLE AS a, -d_emp / 365.25::DOUBLE AS e FROM {DAYS})""", doubles="employed_to_age age_to_employed")
def feat_day_offsets_ext(spark, sf):
    y = f.day_offsets(_days(spark, sf), {"a": "d_birth", "e": "d_emp"})
    return f.floored_ratios(y, [("employed_to_age", "e", "a", 1.0), ("age_to_employed", "a", "e", 0.1)]).select("id", "employed_to_age", "age_to_employed")


X = "[amt_b / 500000, half_missing / 500000, amt_c / 500000]"


def _ext(spark, sf):
    return view(spark, sf, "v_app").select("id", "cnt_a", *[(F.col(c) / 500000).alias(f"e{i}") for i, c in enumerate(("amt_b", "half_missing", "amt_c"))])


@query("feat_row_stats", f"""
SELECT id, list_avg(x) AS "E_MEAN", list_min(x) AS "E_MIN", list_max(x) AS "E_MAX", coalesce(list_stddev_samp(x), 0) AS "E_STD"
FROM (SELECT id, list_filter({X}, lambda v: v IS NOT NULL) AS x FROM v_app)""", ["v_app"], doubles="E_MEAN E_MIN E_MAX E_STD")
def feat_row_stats(spark, sf):
    return f.row_stats(_ext(spark, sf), ["e0", "e1", "e2", "not_there"], "E").select("id", "E_MEAN", "E_MIN", "E_MAX", "E_STD")


@query("feat_row_stats_ext", f"""
SELECT id, coalesce(amt_b / 500000, 1) * coalesce(half_missing / 500000, 1) * coalesce(amt_c / 500000, 1) AS "E_PROD",
 ((amt_b IS NULL)::INT + (half_missing IS NULL)::INT + (amt_c IS NULL)::INT)::INTEGER AS "E_N_MISS",
 list_avg(list_filter({X}, lambda v: v IS NOT NULL)) / CASE WHEN cnt_a < 0.01 THEN 0.01 ELSE cnt_a END AS "E_PER" FROM v_app""", ["v_app"], doubles="E_PROD E_PER")
def feat_row_stats_ext(spark, sf):
    return f.row_stats_ext(_ext(spark, sf), ["e0", "e1", "e2"], "E", "cnt_a").select("id", "E_PROD", "E_N_MISS", "E_PER")


def _flags(spark, sf):
    return view(spark, sf, "v_hist").select(
        "child_id", "step", *[F.when(F.col("status") == s, 1).otherwise(0).alias(f"DOC_{s}") for s in ("1", "4", "C")],
        F.col("qty").alias("REQ_Q"), F.col("disc").alias("REQ_D"))


@query("feat_prefix_sums", """SELECT child_id, step, 1::INTEGER AS docs, qty + coalesce(disc, 0) AS requests FROM v_hist""", ["v_hist"], doubles="requests")
def feat_prefix_sums(spark, sf):
    return f.prefix_sums(_flags(spark, sf), {"docs": "DOC_", "requests": "REQ_", "nothing": "ZZZ_"}).select("child_id", "step", "docs", "requests")


@query("feat_prefix_counts", """
SELECT child_id, step, 2::INTEGER AS docs_missing, ((status = '1')::INT + (status = '4')::INT)::INTEGER AS docs_late FROM v_hist""", ["v_hist"])
def feat_prefix_counts(spark, sf):
    return f.prefix_zero_counts(_flags(spark, sf), {"docs_missing": "DOC_"}, {"docs_late": ["DOC_1", "DOC_4", "DOC_9"]}).select(
        "child_id", "step", "docs_missing", "docs_late")


@query("feat_safe_rate", """
SELECT id, near_const / CASE WHEN cnt_a < 1 THEN 1 ELSE cnt_a END AS rate, near_const::DOUBLE AS rate_no_exposure, 0::DOUBLE AS rate_no_events FROM v_app""",
       ["v_app"], doubles="rate rate_no_exposure rate_no_events")
def feat_safe_rate(spark, sf):
    out = f.safe_rate(view(spark, sf, "v_app"), "rate", "near_const", "cnt_a")
    out = f.safe_rate(f.safe_rate(out, "rate_no_exposure", "near_const", "gone"), "rate_no_events", "gone", "near_const")
    return out.select("id", "rate", "rate_no_exposure", "rate_no_events")


@query("feat_cross_table", f"""
WITH c AS (SELECT id, coalesce(sum(amt), 0) AS debt, count_if(status = 'F') / count(*) AS refusal, count_if(kind LIKE '1%') / count(*) AS late FROM v_child GROUP BY id)
SELECT v_app.id, (coalesce(debt, 0) + amt_c) / {G('amt_b')} AS "TOTAL_DEBT_TO_INCOME", coalesce(debt, 0) / {G('amt_c')} AS "BUREAU_DEBT_TO_NEW_CREDIT",
 coalesce(refusal, 0) * (amt_c / {G('amt_b')}) AS "COMPOUND_RISK_SCORE", coalesce(refusal, 0) * (1 - coalesce(late, 0)) AS "PAYMENT_RELIABILITY"
FROM v_app LEFT JOIN c ON c.id = v_app.id""", ["v_app", "v_child"],
       doubles="TOTAL_DEBT_TO_INCOME BUREAU_DEBT_TO_NEW_CREDIT COMPOUND_RISK_SCORE PAYMENT_RELIABILITY")
def feat_cross_table(spark, sf):
    from riskframe.operators import relate as r
    child = r.aggregate_children(view(spark, sf, "v_child"), "id", [
        r.Measure("debt", "sum", "amt"), r.Measure("n", "count", "child_id"), r.Measure("n_f", "count_in", "status", ("F",)),
        r.Measure("n_late", "count_in", "kind", ("1-URGENT",))], [("refusal", "n_f", "n"), ("late", "n_late", "n")])
    j = r.fill_history(r.join_feature_tables(view(spark, sf, "v_app"), "id", child), ["debt", "refusal", "late"])
    j = f.floored_ratios(j, [("ci", "amt_c", "amt_b", 1.0)])
    out = f.cross_table_features(j, "amt_b", "amt_c", "debt", "no_total", "refusal", "ci", "refusal", "late")
    return out.select("id", "TOTAL_DEBT_TO_INCOME", "BUREAU_DEBT_TO_NEW_CREDIT", "COMPOUND_RISK_SCORE", "PAYMENT_RELIABILITY")


PAID = f"""(SELECT child_id, step, paid / {G('due')} AS payment_ratio, early AS days_early_late,
 CASE WHEN -early < 0 THEN 0 ELSE -early END AS days_late, coalesce(early >= 0, FALSE) AS paid_on_time
 FROM (SELECT *, (10 - CASE WHEN disc IS NULL THEN NULL ELSE qty END)::DOUBLE AS early FROM v_hist))"""


def payments(spark, sf):
    hist = view(spark, sf, "v_hist").withColumns({"due_day": F.lit(10.0), "paid_day": F.when(F.col("disc").isNotNull(), F.col("qty"))})
    return f.payment_features(hist, "due", "paid", "due_day", "paid_day")


@query("feat_installment_derived", f"SELECT * FROM {PAID}", ["v_hist"], doubles="payment_ratio days_early_late days_late")
def feat_installment_derived(spark, sf):
    return payments(spark, sf).select("child_id", "step", "payment_ratio", "days_early_late", "days_late", "paid_on_time")
